"""Ranks and shares over whole tables without a one-partition sort.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into a single
task.  ``global_rank`` instead works on the histogram of distinct values:

1. ``groupBy(value).count()``  (partial aggregation, skew-safe)
2. range-partition the histogram by value, tag each row with its slice
   (the partition id) and checkpoint it to the shared folder, so both uses
   below see the same slices even when a task is retried
3. per-slice row totals (one row per slice) -> running offsets
4. inside each slice: running count of rows with a better value
5. rank = offset + rows before + 1; joined back on the value (null-safe)

Equal values share one histogram row, so ties get the same rank exactly as
SQL ``rank()``.  The only one-partition step sorts one row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize


def _ordered(c: Column, descending: bool) -> Column:
    # SQL default: ascending puts NULL first, descending puts NULL last
    return c.desc_nulls_last() if descending else c.asc_nulls_first()


def value_ranks(df: DataFrame, value: str, out: str, descending: bool = True) -> DataFrame:
    """(value, rank) for every distinct value of ``df[value]``."""
    v = F.col(value)
    hist = df.groupBy(v).agg(F.count(F.lit(1)).alias("_n"))
    sliced = materialize(hist.repartitionByRange(_ordered(v, descending))
                         .withColumn("_slice", F.spark_partition_id()))
    totals = sliced.groupBy("_slice").agg(F.sum("_n").alias("_slice_n"))
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_slice_n").over(
            Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_slice").orderBy(_ordered(v, descending)).rowsBetween(
        Window.unboundedPreceding, -1)
    local = sliced.select("_slice", v, F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_before"))
    return local.join(offsets, "_slice").select(
        v, (F.col("_offset") + F.col("_before") + 1).cast("int").alias(out))


def with_global_rank(df: DataFrame, value: str, out: str, descending: bool = True) -> DataFrame:
    """``df`` plus ``out`` = SQL ``rank() OVER (ORDER BY value [DESC])``."""
    ranks = value_ranks(df, value, "_rank_tmp", descending).withColumnRenamed(value, "_rank_v")
    joined = df.join(ranks, df[value].eqNullSafe(ranks["_rank_v"]), "left")
    return joined.drop("_rank_v").withColumnRenamed("_rank_tmp", out)


def top_by(df: DataFrame, value: str, k: int, out: str = "rank", descending: bool = True) -> DataFrame:
    """Rows with ``rank() <= k`` by ``value``, with that rank.

    A plain ``rank`` window followed by the filter, which Spark plans as a
    per-partition ``WindowGroupLimit`` before the single-partition exchange:
    only k rows (plus ties) per input partition ever leave their task.
    """
    w = Window.orderBy(_ordered(F.col(value), descending))
    return df.withColumn(out, F.rank().over(w)).where(F.col(out) <= k)


def with_rank_among(rows: DataFrame, population: DataFrame, value: str, out: str) -> DataFrame:
    """``rows`` plus ``out`` = SQL ``rank()`` of ``rows[value]`` among all of
    ``population`` (descending): its ranks by value, joined null-safe."""
    ranks = value_ranks(population, value, "_rank_tmp").withColumnRenamed(value, "_rank_v")
    joined = rows.join(ranks, rows[value].eqNullSafe(ranks["_rank_v"]), "left")
    return joined.drop("_rank_v").withColumnRenamed("_rank_tmp", out)
