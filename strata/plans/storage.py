"""Stored layout of the fact table: partitioned, clustered, with statistics.

* partitioned by order year and month, so a date filter reads only the
  matching folders (static and dynamic partition pruning are Catalyst's);
* optionally range-clustered by (customer_id, order_date) inside each
  partition, so parquet min/max statistics let scans skip row groups;
* the write uses the REBALANCE hint: AQE splits a month that holds a large
  share of the rows into several tasks instead of one; hashes travel packed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import hashing
from strata.session import CODEC

PARTITION_COLUMNS = ["order_year", "order_month"]


def with_partition_columns(fact: DataFrame, date_col: str = "order_date") -> DataFrame:
    return fact.withColumns({"order_year": F.year(date_col), "order_month": F.month(date_col)})


def write_fact(fact: DataFrame, path: str, cluster_by: Sequence[str] | None = None,
               mode: str = "overwrite", derived: Mapping[str, Column] | None = None) -> None:
    """``derived`` columns are worked out from the others after the shuffle, in
    which (and in the joins before it) they would be the larger part."""
    columns = [*dict.fromkeys([*fact.columns, *PARTITION_COLUMNS])]
    derived = dict(derived or {})
    fact = fact.drop(*derived)

    def dealt(df: DataFrame) -> DataFrame:
        if cluster_by:
            return df.repartitionByRange(*PARTITION_COLUMNS, *cluster_by) \
                .sortWithinPartitions(*PARTITION_COLUMNS, *cluster_by)
        return df.hint("rebalance", *PARTITION_COLUMNS)

    df = hashing.packed_during(with_partition_columns(fact), dealt)
    df = df.withColumns(derived).select(*columns) if derived else df
    df.write.mode(mode).partitionBy(*PARTITION_COLUMNS).parquet(path, compression=CODEC)


def read_fact(spark: SparkSession, path: str, years: Sequence[int] | None = None,
              months: Sequence[int] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if years:
        df = df.where(F.col("order_year").isin(list(years)))
    if months:
        df = df.where(F.col("order_month").isin(list(months)))
    return df


def save_table(spark: SparkSession, df: DataFrame, name: str, path: str,
               partition_by: Sequence[str] = (), analyze_columns: Sequence[str] = ()) -> None:
    """Save as an external catalog table and compute statistics for the
    optimizer (``ANALYZE TABLE ... FOR COLUMNS``)."""
    w = df.write.mode("overwrite").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if analyze_columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS "
                  + ", ".join(analyze_columns))
