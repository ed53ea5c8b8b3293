"""Data-quality checks: evaluate many rules in one pass, split good/bad rows.

``evaluate(df, checks)`` returns one row per check:
``(check, failed, total, passed)``.  All row-level checks (not null, type
valid, business rules) are folded into a *single* aggregation of
``count_if`` expressions, so the table is scanned once for all of them.
Table-level checks (row count, freshness) ride in the same aggregation;
key checks (duplicate keys, referential integrity) need their own shuffle
and are added as separate small aggregates.

A rule whose predicate is NULL counts as failed (a missing value does not
prove a rule holds).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    kind: str  # row | rows_total | freshness | row_count | duplicate_keys | foreign_key
    predicate: Column | None = None  # row kinds: True = the row passes
    columns: Sequence[str] = field(default_factory=tuple)
    parent: DataFrame | None = None
    parent_columns: Sequence[str] = field(default_factory=tuple)
    max_age_hours: float = 24.0
    as_of: object = None


def _expr(p) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def not_null(column: str, name: str | None = None) -> Check:
    return Check(name or f"not_null:{column}", "row", F.col(column).isNotNull())


def type_valid(column: str, type_name: str, name: str | None = None) -> Check:
    """Text that is present must convert to ``type_name``."""
    c = F.col(column)
    ok = c.isNull() | c.try_cast(type_name).isNotNull()
    return Check(name or f"type_valid:{column}:{type_name}", "row", ok)


def rule(name: str, predicate) -> Check:
    """A business rule; SQL text or a Column.  NULL = failed."""
    return Check(name, "row", _expr(predicate))


def row_count(name: str = "row_count_positive") -> Check:
    return Check(name, "row_count")


def freshness(column: str, as_of, max_age_hours: float = 24.0, name: str | None = None) -> Check:
    return Check(name or f"freshness:{column}", "freshness", columns=(column,),
                 max_age_hours=max_age_hours, as_of=as_of)


def unique_key(columns: Sequence[str], name: str | None = None) -> Check:
    return Check(name or "unique_key:" + ",".join(columns), "duplicate_keys", columns=tuple(columns))


def foreign_key(columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str],
                name: str | None = None) -> Check:
    return Check(name or "foreign_key:" + ",".join(columns), "foreign_key", columns=tuple(columns),
                 parent=parent, parent_columns=tuple(parent_columns))


def _passes(c: Check) -> Column:
    return F.coalesce(c.predicate, F.lit(False))


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v).cast("timestamp")


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, failed, total, passed (in the given order)."""
    single, keyed = [], []
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, c in enumerate(checks):
        if c.kind == "row":
            aggs.append(F.count_if(~_passes(c)).alias(f"_f{i}"))
            single.append((i, c))
        elif c.kind == "row_count":
            single.append((i, c))
        elif c.kind == "freshness":
            col = c.columns[0]
            limit = _ts(c.as_of) - F.expr(f"INTERVAL {int(c.max_age_hours * 3600)} SECONDS")
            aggs.append(F.max(F.col(col).cast("timestamp")).alias(f"_m{i}"))
            single.append((i, c, limit))
        else:
            keyed.append((i, c))
    base = df.agg(*aggs)
    entries = []
    for item in single:
        i, c = item[0], item[1]
        if c.kind == "row":
            failed = F.col(f"_f{i}")
            total = F.col("_total")
        elif c.kind == "row_count":
            failed = F.when(F.col("_total") > 0, F.lit(0)).otherwise(F.lit(1))
            total = F.lit(1)
        else:
            fresh = F.coalesce(F.col(f"_m{i}") >= item[2], F.lit(False))
            failed = F.when(fresh, F.lit(0)).otherwise(F.lit(1))
            total = F.lit(1)
        entries.append(F.struct(F.lit(i).alias("_i"), F.lit(c.name).alias("check"),
                                failed.cast("bigint").alias("failed"),
                                total.cast("bigint").alias("total")))
    rows = []
    if entries:
        # one aggregation row, unpivoted: the table is scanned once
        rows.append((min(t[0] for t in single),
                     base.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")))
    for i, c in keyed:
        rows.append((i, _keyed_check(df, i, c)))
    out = rows[0][1]
    for _, r in rows[1:]:
        out = out.unionByName(r)
    return out.select("check", "failed", "total",
                      (F.col("failed") == 0).alias("passed"))


def _keyed_check(df: DataFrame, i: int, c: Check) -> DataFrame:
    cols = list(c.columns)
    if c.kind == "duplicate_keys":
        # failed = number of key values that occur more than once
        per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        agg = per_key.agg(F.count_if(F.col("_n") > 1).alias("failed"),
                          F.count(F.lit(1)).alias("total"))
    elif c.kind == "foreign_key":
        # the child's keys are counted first (combined map-side), so the join
        # sees one row per key value however often a key occurs
        parent = c.parent.select(*[F.col(p).alias(f"_pk{j}") for j, p in enumerate(c.parent_columns)]) \
            .distinct().withColumn("_hit", F.lit(True))
        present = None
        for x in cols:  # a key with a NULL part references nothing
            e = F.col(x).isNotNull()
            present = e if present is None else present & e
        child = df.where(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        cond = None
        for j, x in enumerate(cols):
            e = child[x] == parent[f"_pk{j}"]
            cond = e if cond is None else cond & e
        agg = child.join(parent, cond, "left").agg(
            F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias("failed"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"))
    else:
        raise ValueError(f"unknown check kind {c.kind}")
    return agg.select(F.lit(i).alias("_i"), F.lit(c.name).alias("check"),
                      F.col("failed").cast("bigint").alias("failed"),
                      F.col("total").cast("bigint").alias("total"))


def quarantine(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows passing every row rule, and the others with a
    ``_dq_failures`` column naming the failed rules (comma separated)."""
    flagged = flag_rows(df, checks)
    good = flagged.where(F.col("_dq_failures") == "").drop("_dq_failures")
    bad = flagged.where(F.col("_dq_failures") != "")
    return good, bad


def flag_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Every row with ``_dq_failures`` ('' when it passes all row rules)."""
    names = [F.when(~_passes(c), F.lit(c.name)) for c in checks if c.kind == "row"]
    return df.withColumn("_dq_failures", F.concat_ws(",", *names) if names else F.lit(""))


def observe(df: DataFrame, checks: Sequence[Check], name: str = "dq"):
    """Attach row-level checks to ``df`` as observed metrics.

    Returns ``(observed_df, observation)``; the metrics are computed by
    whatever action runs ``observed_df`` (typically the table write), so the
    checks cost no extra scan.  Only ``row`` and ``row_count`` checks can be
    observed; keyed checks need their own shuffle (use ``evaluate``).
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("_total")]
    for i, c in enumerate(checks):
        if c.kind == "row":
            metrics.append(F.count_if(~_passes(c)).alias(f"_f{i}"))
        elif c.kind != "row_count":
            raise ValueError(f"check {c.name!r} ({c.kind}) cannot be observed")
    return df.observe(obs, *metrics), obs


def observed_results(obs, checks: Sequence[Check]) -> list[tuple]:
    """(check, failed, total, passed) rows from a completed observation."""
    m = obs.get
    total = int(m["_total"])
    out = []
    for i, c in enumerate(checks):
        if c.kind == "row":
            failed, n = int(m[f"_f{i}"]), total
        else:
            failed, n = (0 if total > 0 else 1), 1
        out.append((c.name, failed, n, failed == 0))
    return out


RESULT_SCHEMA = "check string, failed bigint, total bigint, passed boolean"
