"""The layers as declarations: streaming tables and materialised views.

``define`` takes the module that registers them (``pyspark.pipelines`` in a
pipeline run, or anything with ``table`` and ``materialized_view``
decorators), so the same definitions serve a pipeline and the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from strata.plans import clean as cleaning
from strata.plans import dims, marts
from strata.sources.feeds import FEEDS
from strata.streaming import ingest


class Registry(Protocol):
    def table(self, *, name: str) -> Callable: ...

    def materialized_view(self, *, name: str) -> Callable: ...


def define(dp: Registry, spark: SparkSession, source_dir: str) -> None:
    """Register 7 streaming tables, 7 clean tables, 6 model tables, 6 marts."""
    read: Callable[[str], DataFrame] = spark.read.table

    def stream(feed: str) -> None:
        @dp.table(name=f"{feed}_raw")
        def _():
            return ingest.raw_feed_stream(spark, f"{source_dir}/{feed}", feed)

    def view(name: str, build: Callable[[], DataFrame]) -> None:
        @dp.materialized_view(name=name)
        def _():
            return build()

    def clean_view(feed: str) -> None:
        view(f"{feed}_clean", lambda: cleaning.clean_table(read(f"{feed}_raw"), feed))

    for feed in FEEDS:
        stream(feed)
        clean_view(feed)
    view("dim_customers", lambda: dims.dim_customers(read("customers_clean")))
    view("dim_products", lambda: dims.dim_products(read("products_clean"), read("categories_clean")))
    view("dim_employees", lambda: dims.dim_employees(read("employees_clean")))
    view("dim_shippers", lambda: dims.dim_shippers(read("shippers_clean")))
    view("dim_dates", lambda: dims.dim_dates(read("orders_clean")))
    view("fact_sales", lambda: dims.fact_sales(read("order_details_clean"), read("orders_clean")))
    fact = lambda: read("fact_sales")
    view("gold_sales_by_country", lambda: marts.sales_by_country(fact(), read("dim_customers")))
    view("gold_sales_by_category", lambda: marts.sales_by_category(fact(), read("dim_products")))
    view("gold_sales_by_employee", lambda: marts.sales_by_employee(fact(), read("dim_employees")))
    view("gold_top_products", lambda: marts.top_products(fact(), read("dim_products")))
    view("gold_kpis", lambda: marts.kpis(fact(), read("dim_customers"), read("dim_products"), read("dim_employees")))
    view("gold_monthly_trends", lambda: marts.monthly_trends(fact()))
