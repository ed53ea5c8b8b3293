"""Table scans (the catalog-table read of every layer).

The layers talk to each other through stored tables; here a "table" is either
a parquet path or a name in the session catalog.  Scans are lazy, so column
pruning and filter pushdown reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """``spark.read.table`` for catalog names, parquet for paths."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


class Tables:
    """Lazy access to the driver's parquet tables under one directory."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.base_dir}/{name}.parquet")
        return self._cache[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)
