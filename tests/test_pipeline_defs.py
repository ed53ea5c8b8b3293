"""The declared layers, registered with a recorder instead of a pipeline run."""

import decimal

import pytest
from pyspark.sql import functions as F

from strata.plans import clean as cleaning
from strata.plans import pipeline_defs, stored_fact, versions
from strata.plans.layers import Layers
from strata.session import scratch_path
from strata.sources.feeds import FEEDS
from strata.streaming import ingest

SMALL = "/root/testdata/sf0.001"


class Recorder:
    def __init__(self):
        self.tables, self.views = {}, {}

    def table(self, *, name):
        return lambda fn: self.tables.setdefault(name, fn)

    def materialized_view(self, *, name):
        return lambda fn: self.views.setdefault(name, fn)


def test_declarations_build_from_each_other(spark):
    source = scratch_path(spark, "feeds")
    layers = Layers(spark, SMALL)
    for feed in FEEDS:
        ingest.write_csv_files(layers.raw(feed).drop("ingestion_timestamp"), f"{source}/{feed}")
    seen = Recorder()
    pipeline_defs.define(seen, spark, source)
    assert len(seen.tables) == 7 and len(seen.views) == 19
    assert all(fn().isStreaming for fn in seen.tables.values())
    # Stand-ins for the stored streaming tables; then every view from the ones before it.
    made = []
    try:
        for feed in FEEDS:
            layers.raw(feed).createOrReplaceTempView(f"{feed}_raw")
            made.append(f"{feed}_raw")
        for name, fn in seen.views.items():
            fn().createOrReplaceTempView(name)
            made.append(name)
        assert spark.read.table("fact_sales").count() == layers.fact_sales.count()
        assert spark.read.table("gold_sales_by_country").count() > 0
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def test_wider_money_type_takes_amounts_the_default_cannot(spark):
    raw = spark.createDataFrame(
        [(1, 2, 2_000_000_000, decimal.Decimal("99999999.99"), 0.1)],
        "orderID long, productID long, quantity int, unitPrice decimal(10,2), discount double")
    wide = cleaning.clean_table(raw, "order_details", money="decimal(28,2)").first()
    assert wide.line_total == decimal.Decimal("199999999980000000.00")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW|cannot be represented"):
        cleaning.clean_table(raw, "order_details").collect()


def test_versions_before_the_first_load_and_after_a_delete(spark):
    customers = spark.createDataFrame([("3", "c", "t", "x"), ("11", "d", "u", "y")],
                                      "customerid string, companyname string, contacttitle string, country string")
    products = spark.createDataFrame([(4, "p", decimal.Decimal("5.00"), 0)],
                                     "productid long, productname string, unitprice decimal(10,2), discontinued int")
    fact = spark.createDataFrame(
        [(n, 4, c, d, 1.0) for n, (c, d) in enumerate([("3", "1995-06-01"), ("3", "1996-01-01"), ("3", "1999-01-01"),
                                                     ("11", "1999-12-31"), ("11", "2000-01-01"), ("9", "1997-01-01")])],
        "orderid long, product_id long, customer_id string, order_date string, line_total double") \
        .withColumn("order_date", F.to_date("order_date"))
    out = versions.fact_sales_versioned(fact, versions.dim_customers_history(customers), versions.dim_products_history(products))
    got = {r.orderid: (r.customer_contacttitle, r.product_unitprice) for r in out.collect()}
    old, new = decimal.Decimal("5.00"), decimal.Decimal("15.00")
    assert got == {0: (None, None), 1: ("t", old), 2: ("t II", new), 3: ("u", new), 4: (None, new), 5: (None, old)}


def test_upsert_moves_a_row_between_months(spark):
    cols = "orderid long, product_id long, order_date date, v string, _change_hash string, _is_deleted boolean"
    rows = lambda data: spark.createDataFrame(data, "orderid long, product_id long, order_date string, v string") \
        .select("orderid", "product_id", F.to_date("order_date").alias("order_date"), "v",
                F.md5(F.concat_ws("|", "v", "order_date")).alias("_change_hash"), F.lit(False).alias("_is_deleted"))
    assert rows([]).schema.simpleString() == spark.createDataFrame([], cols).schema.simpleString()
    store = stored_fact.fact_store(spark, scratch_path(spark, "fact"))
    stored_fact.create(store, rows([(1, 1, "2024-01-05", "a"), (2, 1, "2024-01-06", "b"), (3, 1, "2024-03-01", "c"),
                                    (4, None, None, "d")]))
    months = stored_fact.upsert(store, rows([(1, 1, "2024-02-05", "a"), (3, 1, "2024-03-01", "c"), (4, None, None, "D"),
                                             (5, 1, "2024-05-01", "e")]))
    assert months == [0, 202401, 202402, 202405]
    got = sorted((r.orderid, str(r.order_date), r.v) for r in store.read(stored_fact.TABLE).collect())
    assert got == [(1, "2024-02-05", "a"), (2, "2024-01-06", "b"), (3, "2024-03-01", "c"), (4, "None", "D"), (5, "2024-05-01", "e")]
    assert stored_fact.soft_delete(store, rows([(1, 1, "2024-01-01", "")]).select("orderid"), ["orderid"]) == [0, 202401, 202403, 202405]
    flags = {r.orderid: r._is_deleted for r in store.read(stored_fact.TABLE).collect()}
    assert flags == {1: False, 2: True, 3: True, 4: True, 5: True}
