"""Change-data-capture operators: apply a feed, diff snapshots, upsert, delete.

Merges are expressed as joins on the key plus ``when`` logic and produce the
*new* table (write it to a new version folder; see ``plans.storage``), which
is what a MERGE does on formats that support it.  All of them shuffle once on
the key; the "latest per key" pick is an aggregate with a map-side combine,
so a key with very many changes does not pile up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import Derived


def _cond(c) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be NULL (a NULL key is a key like any other);
    the keys of the result are those of whichever side has the row."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    j = left.join(r, cond, how)
    return j.withColumns({k: F.coalesce(F.col(k), F.col(f"_r_{k}")) for k in keys}) \
        .drop(*[f"_r_{k}" for k in keys])


def by_key(rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key the other table has (``left_semi``) or lacks
    (``left_anti``); a NULL key is a key like any other."""
    r = others.select(*[F.col(k).alias(f"_x_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_x_{k}"))
    return rows.join(r, cond, how)


def apply_changes(feed: DataFrame, keys: Sequence[str], seq: str, tiebreak: str | None = None,
                  delete_when: Column | str | None = None) -> DataFrame:
    """Type-1 state after an ordered change feed: per key the change with the
    largest (seq, tiebreak) wins, late (older) events lose; a winning delete
    removes the key."""
    keys = list(keys)
    payload = [c for c in feed.columns if c not in keys]
    # total order: seq, tiebreak, then every other column (deterministic ties)
    first = [seq] + ([tiebreak] if tiebreak else [])
    fields = first + [c for c in payload if c not in first]
    latest = feed.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_w"))
    state = latest.select(*keys, *[F.col("_w")[c].alias(c) for c in payload])
    if delete_when is not None:
        state = state.where(~F.coalesce(_cond(delete_when), F.lit(False)))
    return state


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  hash_col: str = "_change_hash") -> DataFrame:
    """key + ``change`` in insert / update / delete / unchanged."""
    keys = list(keys)
    o = old.select(*keys, F.struct(F.col(hash_col).alias("h")).alias("_o"))
    n = new.select(*keys, F.struct(F.col(hash_col).alias("h")).alias("_n"))
    j = _null_safe_join(o, n, keys, "full_outer")
    # presence is told by the struct, so a NULL hash is a value like any other
    change = (F.when(F.col("_o").isNull(), "insert")
              .when(F.col("_n").isNull(), "delete")
              .when(F.col("_o.h").eqNullSafe(F.col("_n.h")), "unchanged")
              .otherwise("update"))
    return j.select(*keys, change.alias("change"))


def cdc_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
               hash_col: str = "_change_hash", action_col: str | None = None,
               flag: str = "_is_deleted", derived: Mapping[str, Derived] | None = None) -> DataFrame:
    """New target: source rows for new keys, for keys whose hash differs
    (null-safe) and for keys that are flagged deleted on one side only (a
    deleted key that is sent again is back), target rows otherwise.
    ``action_col`` adds the action (insert / update / keep).  Hashes in
    ``derived`` follow from the other columns in both tables: they are worked
    out after the join instead of being shuffled with it."""
    keys, derived = list(keys), dict(derived or {})
    cols = target.columns
    carried = [c for c in cols if c not in keys and c not in derived]
    t = target.select(*keys, F.struct(*carried).alias("_t"))
    s = source.select(*keys, F.struct(*carried).alias("_s"))
    j = _null_safe_join(t, s, keys, "full_outer")

    def value(c: str, side: str) -> Column:
        if c in derived:
            return derived[c].of(lambda x: value(x, side))
        return F.col(c) if c in keys else F.col(f"{side}.{c}")

    differs = ~value(hash_col, "_t").eqNullSafe(value(hash_col, "_s"))
    if flag in cols:
        differs = differs | (F.coalesce(F.col(f"_t.{flag}"), F.lit(False)) != F.coalesce(F.col(f"_s.{flag}"), F.lit(False)))
    take_source = F.col("_s").isNotNull() & (F.col("_t").isNull() | differs)
    picked = j.select(*keys, F.when(take_source, F.col("_s")).otherwise(F.col("_t")).alias("_r"),
                      F.when(F.col("_t").isNull(), "insert")
                      .when(take_source, "update").otherwise("keep").alias("_a"))
    out = picked.select(*[value(c, "_r").alias(c) for c in cols], "_a")
    return out.withColumnRenamed("_a", action_col) if action_col else out.drop("_a")


def soft_delete(target: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                flag: str = "_is_deleted", was: str | None = None) -> DataFrame:
    """Flag target rows whose key is absent from a full source snapshot;
    values are kept.  A key that the snapshot holds is there (again): its flag
    is cleared.  ``was`` adds the flag as it was before."""
    keys = list(keys)
    present = snapshot.select(*keys).distinct().withColumn("_present", F.lit(True))
    before = F.coalesce(F.col(flag), F.lit(False)) if flag in target.columns else F.lit(False)
    j = _null_safe_join(target.withColumn("_before", before), present, keys, "left")
    return j.withColumn(flag, F.col("_present").isNull()).select(
        *target.columns, *([] if flag in target.columns else [flag]),
        *([F.col("_before").alias(was)] if was else []))


def apply_delete_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str], op_col: str = "op",
                      delete_op: str = "D", flag: str = "_is_deleted") -> DataFrame:
    """Flag target rows whose key has a delete operation in the feed."""
    keys = list(keys)
    dels = feed.where(F.col(op_col) == delete_op).select(*keys).distinct() \
        .withColumn("_del", F.lit(True))
    j = _null_safe_join(target, dels, keys, "left")
    was = F.coalesce(F.col(flag), F.lit(False)) if flag in target.columns else F.lit(False)
    return j.withColumn(flag, was | F.col("_del").isNotNull()).drop("_del").select(*target.columns, *(
        [] if flag in target.columns else [flag]))
