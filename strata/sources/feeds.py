"""Raw feed shapes derived from the driver's star-schema tables.

The cleaning layer expects seven raw feeds (categories, products, customers,
employees, orders, order_details, shippers) whose every column is text, as a
CSV file gives it, plus the ``ingestion_timestamp`` stamp of the ingest.
These functions derive those feeds from the TPC-H-like tables with plain
projections and small dimension joins, so all work stays proportional to the
input tables and runs distributed.

The mapping is a test fixture of this repository, written identically in the
DuckDB oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.tables import Tables

# Fixed values of the fixture (shared with the oracle SQL):
#   * ingestion stamp of every fixture row: 2024-01-01 00:00:00 (no time zone)
#   * category id per part type: ECONOMY 1, LARGE 2, MEDIUM 3, PROMO 4,
#     SMALL 5, STANDARD 6
#   * a product is discontinued when its key is a multiple of 10
#   * a customer has no contact name when its key is a multiple of 7
#   * employee title: NULL below 0 balance, Representative below 5000,
#     else Manager
FIXTURE_INGEST_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)
CATEGORY_IDS = {
    "ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6,
}

FEEDS = (
    "categories", "products", "customers", "employees", "orders",
    "order_details", "shippers",
)

# Raw column names of each feed (camelCase headers), in file order.
FEED_COLUMNS = {
    "categories": ["categoryID", "categoryName", "description"],
    "products": ["productID", "productName", "quantityPerUnit", "unitPrice",
                 "discontinued", "categoryID"],
    "customers": ["customerID", "companyName", "contactName", "contactTitle",
                  "city", "country"],
    "employees": ["employeeID", "employeeName", "title", "city", "country",
                  "reportsTo"],
    "orders": ["orderID", "customerID", "employeeID", "orderDate",
               "requiredDate", "shippedDate", "shipperID", "freight"],
    "order_details": ["orderID", "productID", "unitPrice", "quantity", "discount"],
    "shippers": ["shipperID", "companyName"],
}


def _s(c: Column) -> Column:
    return c.cast("string")


def _category_id(p_type: Column) -> Column:
    expr = None
    for name, cid in CATEGORY_IDS.items():
        expr = (F.when(p_type == name, F.lit(cid)) if expr is None
                else expr.when(p_type == name, F.lit(cid)))
    return expr


def _stamp(df: DataFrame) -> DataFrame:
    # written as text so the stamp does not depend on any time zone
    stamp = F.lit(FIXTURE_INGEST_TS.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumn("ingestion_timestamp", stamp)


def _location(t: Tables) -> DataFrame:
    """nation key -> (country, city) from nation x region (both tiny)."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("_country"), F.col("r_name").alias("_city"))


def categories(t: Tables) -> DataFrame:
    df = t.part.select("p_type").distinct().select(
        _s(_category_id(F.col("p_type"))).alias("categoryID"),
        F.col("p_type").alias("categoryName"),
        F.lit(None).cast("string").alias("description"),
    )
    return _stamp(df)


def products(t: Tables) -> DataFrame:
    df = t.part.select(
        _s(F.col("p_partkey")).alias("productID"),
        F.col("p_name").alias("productName"),
        _s(F.col("p_size")).alias("quantityPerUnit"),
        _s(F.col("p_retailprice").cast("decimal(10,2)")).alias("unitPrice"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit("1")).otherwise(F.lit("0")).alias("discontinued"),
        _s(_category_id(F.col("p_type"))).alias("categoryID"),
    )
    return _stamp(df)


def customers(t: Tables) -> DataFrame:
    c = t.customer.join(_location(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    df = c.select(
        _s(F.col("c_custkey")).alias("customerID"),
        F.col("c_name").alias("companyName"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" Contact "), _s(F.col("c_custkey")), F.lit(" ")))
        .alias("contactName"),
        F.col("c_mktsegment").alias("contactTitle"),
        F.col("_city").alias("city"),
        F.col("_country").alias("country"),
    )
    return _stamp(df)


def employees(t: Tables) -> DataFrame:
    s = t.supplier.join(_location(t), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    df = s.select(
        _s(F.col("s_suppkey")).alias("employeeID"),
        F.col("s_name").alias("employeeName"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
        .when(F.col("s_acctbal") < 5000, F.lit("Representative"))
        .otherwise(F.lit("Manager")).alias("title"),
        F.col("_city").alias("city"),
        F.col("_country").alias("country"),
        F.when(F.col("s_suppkey") == 0, F.lit(None).cast("string"))
        .otherwise(_s(F.floor(F.col("s_suppkey") / 10))).alias("reportsTo"),
    )
    return _stamp(df)


def orders(t: Tables) -> DataFrame:
    n_sup = t.supplier.agg(F.count(F.lit(1))).scalar()
    o = t.orders
    odate = F.col("o_orderdate").cast("date")
    df = o.select(
        _s(F.col("o_orderkey")).alias("orderID"),
        _s(F.col("o_custkey")).alias("customerID"),
        _s(F.col("o_custkey") % n_sup).alias("employeeID"),
        _s(odate).alias("orderDate"),
        _s(F.date_add(odate, 30)).alias("requiredDate"),
        F.when(F.col("o_orderstatus") == "F", _s(F.date_add(odate, 7))).alias("shippedDate"),
        F.substring("o_orderpriority", 1, 1).alias("shipperID"),
        _s((F.col("o_totalprice").cast("decimal(12,2)") * F.lit(0.01).cast("decimal(3,2)"))
           .cast("decimal(10,2)")).alias("freight"),
    )
    return _stamp(df)


def order_details(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        _s(F.col("l_orderkey")).alias("orderID"),
        _s(F.col("l_partkey")).alias("productID"),
        _s(F.col("l_extendedprice").cast("decimal(10,2)")).alias("unitPrice"),
        _s(F.col("l_quantity").cast("int")).alias("quantity"),
        _s(F.col("l_discount").cast("decimal(5,4)")).alias("discount"),
    )
    return _stamp(df)


def shippers(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderpriority").distinct().select(
        F.substring("o_orderpriority", 1, 1).alias("shipperID"),
        F.expr("substring(o_orderpriority, 3)").alias("companyName"),
    )
    return _stamp(df)


_BUILDERS = {
    "categories": categories, "products": products, "customers": customers,
    "employees": employees, "orders": orders, "order_details": order_details,
    "shippers": shippers,
}


def raw_feed(t: Tables, name: str) -> DataFrame:
    """One raw feed (all-text columns + ingestion_timestamp)."""
    return _BUILDERS[name](t)
