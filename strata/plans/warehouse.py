"""Stored layers: clean tables, dimensions and fact written once.

Layers talk through stored tables: dimensions and fact are built from the
stored clean tables, and the marts and quality checks read stored tables
instead of recomputing cleaning, deduplication and the fact join for every
report.  The fact is partitioned by order year/month.  The store lives in
the session's shared checkpoint folder, under a key of the input files (path,
size, modification time) and of the code that builds the tables, so a change
of either builds a fresh store.  A table is a versioned folder: new files
first, then a manifest that names them (``plans.versioned``), with no renames;
a build that stopped half-way is never read.

Asking for a stored table that is not there builds it, which runs jobs while
the caller's DataFrame is being made; ``build_all`` does that ahead of time.
"""

from __future__ import annotations

import hashlib
import inspect
import sys
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.functions import hashing
from strata.operators import columns, dedupe, quality
from strata.plans import clean, dims, layers, storage
from strata.plans.layers import Layers
from strata.plans.versioned import VersionedTable
from strata.session import CODEC, release, shared_dir
from strata.sources import feeds
from strata.sources.feeds import FEEDS

CLEAN_STORED = tuple(f"{feed}_clean" for feed in FEEDS)
MODEL_STORED = ("dim_customers", "dim_products", "dim_employees", "dim_shippers", "dim_dates",
                "fact_sales")
STORED = CLEAN_STORED + MODEL_STORED

# Row rules observed while a stored table is written (no extra scan); the
# results land in <root>/<table>/_quality (ignored by readers of the table).
BUILD_CHECKS = {
    "fact_sales": lambda: [
        quality.not_null("orderid"), quality.not_null("customer_id"),
        quality.not_null("product_id"), quality.not_null("order_date"),
        quality.rule("unit_price_non_negative", "unit_price >= 0"),
        quality.rule("quantity_non_negative", "order_quantity >= 0"),
        quality.rule("discount_at_most_one", "discount_rate <= 1.0"),
        quality.row_count(),
    ],
}
# Hashes of a stored table that follow from its other columns: they are not
# written, and worked out for the queries that ask for them.
DERIVED = {**{f"{feed}_clean": clean.derived_hashes(feed) for feed in FEEDS}, "fact_sales": dims.FACT_HASHES}
INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


#: Modules whose code decides what the stored tables hold.
BUILDERS = (clean, dims, storage, feeds, columns, dedupe, hashing, quality, layers)


def plan_version() -> str:
    """Hash of the code the stored tables are built by."""
    return hashlib.sha1("".join(inspect.getsource(m) for m in (*BUILDERS, sys.modules[__name__])).encode()).hexdigest()[:8]


def input_signature(spark: SparkSession, base_dir: str) -> str:
    """Hash of (path, bytes, modification time) of every input file."""
    parts = [base_dir]
    sc = spark.sparkContext
    for name in INPUTS:
        p = sc._jvm.org.apache.hadoop.fs.Path(f"{base_dir.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.exists(p):
            files = fs.listFiles(p, True)
            found = []
            while files.hasNext():
                f = files.next()
                found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
            parts += sorted(found)
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


class Warehouse(Layers):
    """``Layers`` whose dimensions and fact are read from the store."""

    def __init__(self, spark: SparkSession, base_dir: str, root: str | None = None):
        super().__init__(spark, base_dir)
        self.root = root or (f"{shared_dir(spark)}/strata/warehouse/"
                             f"{input_signature(spark, base_dir)}-{plan_version()}")

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    def _computed(self, name: str) -> DataFrame:
        if name in CLEAN_STORED:
            return Layers.clean(self, name[: -len("_clean")])
        return getattr(Layers, name).func(self)

    def clean(self, feed: str, keep: str = "first") -> DataFrame:
        """The stored clean table (the default dedupe); other variants are
        computed from the raw feed."""
        if keep != "first":
            return Layers.clean(self, feed, keep)
        return self._stored(f"{feed}_clean")

    def build(self, name: str, force: bool = False) -> str:
        """Folder of the stored table, which is built if it is not there."""
        table = self.table(name)
        if not force and (folder := table.folder()):
            return folder
        df = self._computed(name).drop(*DERIVED.get(name, {}))
        checks = BUILD_CHECKS[name]() if name in BUILD_CHECKS else None
        if checks:
            df, obs = quality.observe(df, checks, f"build_{name}_{uuid.uuid4().hex[:6]}")

        def write(folder: str) -> None:
            if name == "fact_sales":
                storage.write_fact(df, folder)
            else:
                df.write.parquet(folder, compression=CODEC)
            if checks:
                results = quality.observed_results(obs, checks)
                (self.spark.createDataFrame(results, quality.RESULT_SCHEMA).coalesce(1)
                 .write.mode("overwrite").parquet(f"{folder}/_quality"))

        table.replace(write)
        release(self.spark)
        return table.folder()

    def build_all(self, force: bool = False, parallel: bool = True) -> None:
        """Build every stored table: the clean layer, then dimensions and
        fact from it.  Tables of one layer are independent, so their jobs
        are submitted together and share the cluster's task slots."""
        for layer in (CLEAN_STORED, MODEL_STORED):
            if not parallel:
                for name in layer:
                    self.build(name, force)
                continue
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=len(layer)) as pool:
                for f in [pool.submit(self.build, name, force) for name in layer]:
                    f.result()

    def _stored(self, name: str) -> DataFrame:
        # the fact keeps its partition columns (order_year, order_month) so
        # callers filtering on them read only the matching folders
        df = self.spark.read.parquet(self.build(name))
        derived = DERIVED.get(name)
        if not derived:
            return df
        columns = [c for c in self._computed(name).columns if c in derived or c in df.columns]
        columns += [c for c in df.columns if c not in columns]
        return df.withColumns({c: d.of() for c, d in derived.items()}).select(*columns)

    def quality(self, name: str) -> DataFrame:
        """Check results recorded while ``name`` was written."""
        return self.spark.read.parquet(f"{self.build(name)}/_quality")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._stored("dim_customers")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._stored("dim_products")

    @cached_property
    def dim_employees(self) -> DataFrame:
        return self._stored("dim_employees")

    @cached_property
    def dim_shippers(self) -> DataFrame:
        return self._stored("dim_shippers")

    @cached_property
    def dim_dates(self) -> DataFrame:
        return self._stored("dim_dates")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._stored("fact_sales")
