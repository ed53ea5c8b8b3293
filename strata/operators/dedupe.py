"""Deterministic deduplication on a key.

The winner of each key is the first row under a *total* order: the caller's
order columns, then every remaining column ascending (nulls first).  It is
computed as a grouped ``min`` over a struct (``max`` for ``keep="last"``):
an aggregate, so Spark combines map-side before the shuffle and a key holding
a large share of the rows never has to be sorted in one task.  Input order
and partitioning do not change the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, NumericType, TimestampNTZType,
                               TimestampType)


def _order_item(df: DataFrame, spec) -> tuple[str, bool]:
    if isinstance(spec, str):
        name, desc = spec, False
        if spec.startswith("-"):
            name, desc = spec[1:], True
        return name, desc
    name, direction = spec
    return name, direction.lower().startswith("desc")


def _ascending_proxies(df: DataFrame, name: str, desc: bool) -> list[Column] | None:
    """Expressions whose ascending order is the wanted order, or None.

    Ascending has NULL first and descending NULL last, as in the window path
    (and in SQL), whatever the column's type."""
    col = F.col(f"`{name}`")
    if not desc:
        return [col]
    dt = df.schema[name].dataType
    if isinstance(dt, NumericType):
        down = -col
    elif isinstance(dt, TimestampType):
        down = -F.unix_micros(col)
    elif isinstance(dt, TimestampNTZType):
        down = -F.unix_micros(col.cast("timestamp"))
    elif isinstance(dt, DateType):
        down = -F.unix_date(col)
    elif isinstance(dt, BooleanType):
        down = ~col
    else:
        return None
    return [col.isNull(), down]


def rank(df: DataFrame, columns: Sequence[str], order_by: Sequence = (), prefix: str = "") -> Column:
    """The total order of ``remove_duplicates`` as a value: of two rows of a
    key the one with the smaller rank is kept first.  ``prefix`` stands before
    the names of the columns in ``df``."""
    order = [_order_item(df, s) for s in order_by]
    parts = []
    for name, desc in order:
        found = _ascending_proxies(df, f"{prefix}{name}", desc)
        if found is None:
            raise ValueError(f"{name}: descending text has no rank value")
        parts += found
    parts += [F.col(f"`{prefix}{c}`") for c in columns if c not in [n for n, _ in order]]
    return F.struct(*[p.alias(f"_{i}") for i, p in enumerate(parts)])


def remove_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                      keep: str = "first", order_by: Sequence | None = None) -> DataFrame:
    """Keep one row per ``subset`` key.

    * ``subset=None``: full-row distinct.
    * ``order_by``: items ``"col"`` / ``"-col"`` / ``("col", "desc")`` that
      rank rows inside a key before the remaining columns break ties.
    * ``keep="first"`` keeps the smallest row in that order, ``"last"`` the
      largest.
    """
    if subset is None:
        return df.dropDuplicates()
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    subset = list(subset)
    order = [_order_item(df, s) for s in (order_by or [])]
    ordered_names = [n for n, _ in order]
    rest = [c for c in df.columns if c not in subset and c not in ordered_names]

    proxies = []
    for i, (name, desc) in enumerate(order):
        found = _ascending_proxies(df, name, desc)
        if found is None:  # descending text order has no ascending proxy
            return _dedupe_by_window(df, subset, keep, order, rest)
        proxies += [p.alias(f"_o{i}_{j}") for j, p in enumerate(found)]

    payload = [c for c in df.columns if c not in subset]
    if not payload:
        return df.dropDuplicates(subset)
    fields = proxies + [F.col(f"`{c}`").alias(c) for c in payload if c not in ordered_names]
    # the ordered columns themselves ride along after their proxies
    fields += [F.col(f"`{n}`").alias(n) for n in ordered_names]
    pick = F.min if keep == "first" else F.max
    agg = df.groupBy(*[F.col(f"`{k}`") for k in subset]).agg(pick(F.struct(*fields)).alias("_w"))
    return agg.select(*[F.col(f"`{c}`") if c in subset else F.col("_w")[c].alias(c)
                        for c in df.columns])


def _dedupe_by_window(df, subset, keep, order, rest):
    cols = []
    for name, desc in order:
        c = F.col(f"`{name}`")
        flip = desc != (keep == "last")
        cols.append(c.desc_nulls_last() if flip else c.asc_nulls_first())
    for name in rest:
        c = F.col(f"`{name}`")
        cols.append(c.desc_nulls_last() if keep == "last" else c.asc_nulls_first())
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in subset]).orderBy(*cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
