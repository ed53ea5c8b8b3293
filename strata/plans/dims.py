"""Dimensional layer: dimensions and the sales fact.

Joins are equi-joins on business keys; no broadcast is forced: Spark's
planner broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime), and
otherwise shuffles both sides on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing
from strata.operators import columns as ops

AUDIT = ["_loaded_at", "_source", "_processing_timestamp", "_change_hash"]
#: Hashes of a fact row that follow from its other columns: the key's, and the
#: order line's as the cleaning layer made it.
FACT_HASHES = {
    "fact_sales_sk": hashing.Derived(("orderid", "product_id"), hashing.KEY_NULL),
    "_change_hash": hashing.Derived(("orderid", "product_id", "order_quantity", "unit_price", "discount_rate"), hashing.CHANGE_NULL),
}


def dim_customers(customers: DataFrame, as_of=None) -> DataFrame:
    ops.validate_required_columns(customers, ["customerid", "companyname"])
    df = customers.select(
        hashing.surrogate_key(["customerid"]).alias("dim_customer_sk"),
        F.col("customerid").alias("customer_id"),
        "companyname", "contactname", "contacttitle", "city", "country", *AUDIT,
    )
    return ops.create_version_columns(df, as_of=as_of)


def dim_products(products: DataFrame, categories: DataFrame, as_of=None) -> DataFrame:
    ops.validate_required_columns(products, ["productid"])
    ops.validate_required_columns(categories, ["categoryid"])
    p = products.alias("p")
    c = categories.select(F.col("categoryid").alias("_cat_id"),
                          F.col("categoryname").alias("category_name"))
    df = p.join(c, F.col("p.categoryid") == F.col("_cat_id"), "left").select(
        hashing.surrogate_key([F.col("p.productid")]).alias("dim_product_sk"),
        F.col("p.productid").alias("product_id"),
        F.col("p.productname").alias("product_name"),
        F.col("p.categoryid").alias("category_id"),
        "category_name",
        F.col("p.unitprice").alias("unit_price"),
        F.col("p.quantityperunit").alias("quantity_per_unit"),
        F.col("p.discontinued").alias("discontinued"),
        *[F.col(f"p.{a}").alias(a) for a in AUDIT],
    )
    return ops.create_version_columns(df, as_of=as_of)


def dim_employees(employees: DataFrame, as_of=None) -> DataFrame:
    """Employees with their manager's name (left self join on reportsto).

    The top of the tree keeps ``reports_to_id = -1`` and a NULL manager.
    """
    ops.validate_required_columns(employees, ["employeeid"])
    e = employees.alias("e")
    m = employees.select(F.col("employeeid").alias("_mgr_id"),
                         F.col("employeename").alias("manager_name"))
    df = e.join(m, F.col("e.reportsto") == F.col("_mgr_id"), "left").select(
        hashing.surrogate_key([F.col("e.employeeid")]).alias("dim_employee_sk"),
        F.col("e.employeeid").alias("employee_id"),
        F.col("e.employeename").alias("employee_name"),
        F.col("e.title").alias("title"),
        F.col("e.city").alias("city"),
        F.col("e.country").alias("country"),
        F.col("e.reportsto").alias("reports_to_id"),
        "manager_name",
        *[F.col(f"e.{a}").alias(a) for a in AUDIT],
    )
    return ops.create_version_columns(df, as_of=as_of)


def dim_shippers(shippers: DataFrame) -> DataFrame:
    ops.validate_required_columns(shippers, ["shipperid", "companyname"])
    return shippers.select(
        hashing.surrogate_key(["shipperid"]).alias("dim_shipper_sk"),
        F.col("shipperid").alias("shipper_id"),
        F.col("companyname").alias("shipper_name"),
        *AUDIT,
    )


def _date_attributes(d) -> list:
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofweek(d).alias("day_of_week"),
        F.when(F.dayofweek(d).isin(1, 7), F.lit(1)).otherwise(F.lit(0)).alias("is_weekend"),
    ]


def dim_dates(orders: DataFrame) -> DataFrame:
    """One row per distinct non-null order date (Sunday = 1)."""
    d = F.col("orderdate")
    return (orders.select(d).where(d.isNotNull()).distinct()
            .select(*_date_attributes(d), F.lit(0).alias("is_holiday")))


def dim_dates_calendar(orders: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Every day from the first to the last order date, holidays flagged.

    ``holidays`` is a DataFrame with a ``holiday_date`` column; without it no
    day is a holiday.  The date range is generated by ``sequence`` from the
    one-row min/max aggregate, then exploded: rows grow with the span of
    days, not with the number of orders.
    """
    span = orders.agg(F.min("orderdate").alias("lo"), F.max("orderdate").alias("hi"))
    days = span.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("orderdate"))
    d = F.col("orderdate")
    df = days.select(*_date_attributes(d))
    if holidays is None:
        return df.withColumn("is_holiday", F.lit(0))
    h = holidays.select(F.col("holiday_date").cast("date").alias("_hday")).distinct()
    return (df.join(h, F.col("full_date") == F.col("_hday"), "left")
            .withColumn("is_holiday", F.when(F.col("_hday").isNotNull(), 1).otherwise(0))
            .drop("_hday"))


def fact_sales(order_details: DataFrame, orders: DataFrame) -> DataFrame:
    """Order-line fact: details inner join orders on ``orderid``.

    Columns are pruned and hashes packed before the join so only what the
    fact needs is shuffled; audit and hash come from the order lines.
    """
    ops.validate_required_columns(orders, ["orderid"])
    ops.validate_required_columns(order_details, ["orderid", "productid"])
    od = order_details.select(
        "orderid", "productid", "quantity", "unitprice", "discount", "line_total",
        "discount_amount", *AUDIT)
    o = orders.select("orderid", "customerid", "employeeid", "shipperid", "orderdate",
                      "requireddate", "shippeddate", "freight")
    df = hashing.packed_during(od, lambda d: d.join(o, "orderid", "inner"))
    return df.select(
        hashing.surrogate_key(["orderid", "productid"]).alias("fact_sales_sk"),
        "orderid",
        F.col("customerid").alias("customer_id"),
        F.col("employeeid").alias("employee_id"),
        F.col("productid").alias("product_id"),
        F.col("shipperid").alias("shipper_id"),
        F.col("quantity").alias("order_quantity"),
        F.col("unitprice").alias("unit_price"),
        F.col("discount").alias("discount_rate"),
        "line_total", "discount_amount",
        F.col("orderdate").alias("order_date"),
        F.col("requireddate").alias("required_date"),
        F.col("shippeddate").alias("shipped_date"),
        "freight", *AUDIT,
        F.lit(False).alias("_is_deleted"),
    )


def fact_with_dimension_keys(fact: DataFrame) -> DataFrame:
    """Add each dimension's surrogate key and the date key to the fact.

    The dimension keys are hashes of the business keys, so they are
    recomputed in place (no join); ``order_date_key`` is yyyyMMdd.
    """
    return fact.withColumns({
        "dim_customer_sk": hashing.surrogate_key(["customer_id"]),
        "dim_employee_sk": hashing.surrogate_key(["employee_id"]),
        "dim_product_sk": hashing.surrogate_key(["product_id"]),
        "dim_shipper_sk": hashing.surrogate_key(["shipper_id"]),
        "order_date_key": F.date_format("order_date", "yyyyMMdd").cast("int"),
    })


def current_rows(dim: DataFrame) -> DataFrame:
    """Rows valid now (dimensions with history carry ``_is_current``)."""
    return dim.where(F.col("_is_current")) if "_is_current" in dim.columns else dim
