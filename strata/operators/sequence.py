"""Ordered neighbours inside a key, safe when one key holds a large share.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task.  These helpers split the ordered data into *range slices* first:

1. ``repartitionByRange(keys..., order...)`` samples the data and cuts it
   into balanced, contiguous ranges, so a hot key spans many slices; each
   row is tagged with its slice and the result is checkpointed to the
   shared folder (slices must be identical for every later use, also when
   a task is retried);
2. the window runs per ``(keys, slice)`` -- bounded by the slice size;
3. a per ``(keys, slice)`` summary (one row each, an aggregate with a
   map-side combine) carries the value across slice borders through a
   second, tiny window over slices.

A key's rows occupy a contiguous run of slices, so the previous slice of a
key in slice order is the one just before it.  AQE may merge adjacent range
partitions up to the advisory partition size; merged slices are still
contiguous ranges, and their size stays bounded by that advisory size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

SLICE = "_slice"


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Range-sliced copy of ``df`` with a ``_slice`` column, checkpointed."""
    ranged = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return materialize(ranged.withColumn(SLICE, F.spark_partition_id()))


def _within(keys, order):
    return Window.partitionBy(*keys, SLICE).orderBy(*order)


def _across(keys):
    return Window.partitionBy(*keys).orderBy(SLICE)


def _carry_join(local: DataFrame, carry: DataFrame, keys, first_col: str, pairs) -> DataFrame:
    """Take each local value, or the carried one on a slice's edge row."""
    named = carry.select(*[F.col(k).alias(f"_c_{k}") for k in (*keys, SLICE)], "_carry")
    # a NULL key is a key like any other
    cond = reduce(and_, [local[k].eqNullSafe(named[f"_c_{k}"]) for k in (*keys, SLICE)])
    joined = local.join(named, cond, "left").drop(*[f"_c_{k}" for k in (*keys, SLICE)])
    return joined.withColumns({
        out: F.when(F.col(first_col), F.col(f"_carry.{src}")).otherwise(F.col(out))
        for out, src in pairs
    }).drop("_carry", first_col)


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    cols: Sequence[str], prefix: str = "_prev_", presliced: bool = False,
                    keep_slice: bool = False) -> DataFrame:
    """``lag(c, 1)`` of each ``c`` in ``cols`` within ``keys`` by ``order``
    (a total order inside the key), as ``prefix + c``.

    ``keep_slice`` keeps the ``_slice`` column so a following neighbour
    step over a filtered subset can reuse the slices (``presliced=True``):
    filtering keeps every key's rows in a contiguous run of slices."""
    s = df if presliced else sliced(df, keys, order)
    w = _within(keys, order)
    local = s.withColumns({
        **{prefix + c: F.lag(c).over(w) for c in cols},
        "_edge": F.lag(F.lit(1)).over(w).isNull(),
    })
    last = s.groupBy(*keys, SLICE).agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    carry = last.select(*keys, SLICE, F.lag("_last").over(_across(keys)).alias("_carry"))
    out = _carry_join(local, carry, keys, "_edge", [(prefix + c, c) for c in cols])
    return out if keep_slice else out.drop(SLICE)


def next_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                cols: Sequence[str], prefix: str = "_next_", presliced: bool = False) -> DataFrame:
    """``lead(c, 1)`` of each ``c`` within ``keys`` by ``order``."""
    s = df if presliced else sliced(df, keys, order)
    w = _within(keys, order)
    local = s.withColumns({
        **{prefix + c: F.lead(c).over(w) for c in cols},
        "_edge": F.lead(F.lit(1)).over(w).isNull(),
    })
    first = s.groupBy(*keys, SLICE).agg(
        F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
    carry = first.select(*keys, SLICE, F.lead("_first").over(_across(keys)).alias("_carry"))
    return _carry_join(local, carry, keys, "_edge", [(prefix + c, c) for c in cols]).drop(SLICE)


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
                 out: str, presliced: bool = False) -> DataFrame:
    """``out`` = the last non-null ``col`` at or before each row in the key
    (``last(col, ignorenulls)`` over an unbounded-preceding frame)."""
    s = df if presliced else sliced(df, keys, order)
    w = _within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = s.withColumns({out: F.last(col, ignorenulls=True).over(w)})
    local = local.withColumn("_edge", F.col(out).isNull())
    # last non-null value inside each slice, then carried over earlier slices
    lastnn = s.where(F.col(col).isNotNull()).groupBy(*keys, SLICE).agg(
        F.max_by(F.col(col), F.struct(*order)).alias("_v"))
    slices = s.select(*keys, SLICE).distinct()
    per_slice = slices.join(
        lastnn.select(*[F.col(k).alias(f"_l_{k}") for k in (*keys, SLICE)], "_v"),
        reduce(and_, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in (*keys, SLICE)]), "left")
    carry = per_slice.select(
        *keys, SLICE,
        F.struct(F.last("_v", ignorenulls=True).over(
            _across(keys).rowsBetween(Window.unboundedPreceding, -1)).alias("v")).alias("_carry"))
    return _carry_join(local, carry, keys, "_edge", [(out, "v")]).drop(SLICE)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """``out`` = 1, 2, ... within ``keys`` by ``order`` (a total order inside the key)."""
    s = sliced(df, keys, order)
    local = s.withColumn("_local", F.row_number().over(_within(keys, order)))
    counts = s.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        *[F.col(k).alias(f"_c_{k}") for k in (*keys, SLICE)],
        F.coalesce(F.sum("_n").over(_across(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    cond = reduce(and_, [s[k].eqNullSafe(F.col(f"_c_{k}")) for k in (*keys, SLICE)])
    return (local.join(before, cond, "left").withColumn(out, F.col("_local") + F.col("_before"))
            .drop("_local", "_before", SLICE, *[f"_c_{k}" for k in (*keys, SLICE)]))
