"""Wiring of the layers over one set of input tables.

``Layers(spark, base_dir)`` gives lazy DataFrames for every table of the
model: raw feeds, clean tables, dimensions, fact.  Nothing is written unless a
caller asks (``plans.storage``); the marts then run as one optimised plan
from the parquet scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.plans import clean as cleaning
from strata.plans import dims
from strata.sources import feeds
from strata.sources.tables import Tables


class Layers:
    def __init__(self, spark: SparkSession, base_dir: str, as_of=None):
        self.spark = spark
        self.tables = Tables(spark, base_dir)
        self.as_of = as_of

    # raw and clean ---------------------------------------------------------
    def raw(self, feed: str) -> DataFrame:
        return feeds.raw_feed(self.tables, feed)

    def clean(self, feed: str, keep: str = "first") -> DataFrame:
        return cleaning.clean_table(self.raw(feed), feed, as_of=self.as_of, keep=keep)

    # dimensional -----------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.clean("customers"), as_of=self.as_of)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.clean("products"), self.clean("categories"),
                                 as_of=self.as_of)

    @cached_property
    def dim_employees(self) -> DataFrame:
        return dims.dim_employees(self.clean("employees"), as_of=self.as_of)

    @cached_property
    def dim_shippers(self) -> DataFrame:
        return dims.dim_shippers(self.clean("shippers"))

    @cached_property
    def dim_dates(self) -> DataFrame:
        return dims.dim_dates(self.clean("orders"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return dims.fact_sales(self.clean("order_details"), self.clean("orders"))
