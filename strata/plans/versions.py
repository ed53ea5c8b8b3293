"""Versioned dimensions and the fact joined to the versions of its time.

``customer_feed`` and ``product_feed`` are change feeds of the clean tables
(the given tables hold one state each, so the later changes are derived from
it by fixed rules); the histories come from them by ``operators.history``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import history, temporal

#: Times of the feeds: first load, changes, deletes.  Orders begin before the
#: first load and go on after the deletes.
FIRST, CHANGED, DELETED = dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1)
CUSTOMER_TRACKED = ["companyname", "contacttitle", "country"]
EMPLOYEE_TRACKED = ["employeename", "title", "city", "country", "reportsto"]
PRODUCT_TRACKED = ["productname", "unitprice", "discontinued"]


def _feed(first: DataFrame, changed: DataFrame, deleted: DataFrame) -> DataFrame:
    parts = [df.withColumns({"changed_at": F.lit(at), "_is_delete": F.lit(gone)})
             for df, at, gone in ((first, FIRST, False), (changed, CHANGED, False), (deleted, DELETED, True))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def customer_feed(customers: DataFrame) -> DataFrame:
    """Every third customer gets another title, every eleventh goes."""
    c = customers.select("customerid", *CUSTOMER_TRACKED)
    number = F.col("customerid").cast("bigint")
    changed = c.where(number % 3 == 0).withColumn("contacttitle", F.concat("contacttitle", F.lit(" II")))
    return _feed(c, changed, c.where(number % 11 == 0))


def product_feed(products: DataFrame) -> DataFrame:
    """Every second product is sent again, every fourth at a higher price;
    every thirteenth goes."""
    p = products.select("productid", *PRODUCT_TRACKED)
    price = F.when(F.col("productid") % 4 == 0, (F.col("unitprice") + 10).cast("decimal(10,2)")).otherwise(F.col("unitprice"))
    changed = p.where(F.col("productid") % 2 == 0).withColumn("unitprice", price)
    return _feed(p, changed, p.where(F.col("productid") % 13 == 0))


def dim_customers_history(customers: DataFrame) -> DataFrame:
    return history.scd2_from_log(customer_feed(customers), ["customerid"], "changed_at", CUSTOMER_TRACKED) \
        .withColumnRenamed("customerid", "customer_id")


def dim_products_history(products: DataFrame) -> DataFrame:
    return history.scd2_from_log(product_feed(products), ["productid"], "changed_at", PRODUCT_TRACKED) \
        .withColumnRenamed("productid", "product_id")


def employee_feed(employees: DataFrame) -> DataFrame:
    """Every third employee gets another name, every fifth another manager,
    every eleventh goes; the managers among them change their reports' versions."""
    e = employees.select("employeeid", *EMPLOYEE_TRACKED)
    number = F.col("employeeid")
    changed = e.where((number % 3 == 0) | (number % 5 == 0)).withColumns({
        "employeename": F.when(number % 3 == 0, F.concat("employeename", F.lit(" II"))).otherwise(F.col("employeename")),
        "reportsto": F.when(number % 5 == 0, F.lit(2)).otherwise(F.col("reportsto")).cast("long")})
    return _feed(e, changed, e.where(number % 11 == 0))


def dim_employees_history(employees: DataFrame) -> DataFrame:
    """Employee versions with the manager's name of their time.

    A version is split where the manager is renamed or goes; the split is told
    by the manager's names alone, so a manager's new title splits nothing.
    """
    feed = employee_feed(employees)
    own = history.scd2_from_log(feed, ["employeeid"], "changed_at", EMPLOYEE_TRACKED)
    names = history.scd2_from_log(feed, ["employeeid"], "changed_at", ["employeename"]).select(
        F.col("employeeid").alias("manager_id"), F.col("employeename").alias("manager_name"), "_effective_date", "_end_date")
    return (temporal.temporal_join(own.drop("_change_hash"), names, "reportsto", "manager_id", ["manager_name"], ["employeeid"])
            .withColumnsRenamed({"employeeid": "employee_id", "employeename": "employee_name", "reportsto": "reports_to_id"}))


def category_feed(categories: DataFrame) -> DataFrame:
    """Every second category is renamed, every fifth goes."""
    c = categories.select("categoryid", "categoryname")
    renamed = c.where("categoryid % 2 = 0").withColumn("categoryname", F.concat("categoryname", F.lit(" II")))
    return _feed(c, renamed, c.where("categoryid % 5 = 0"))


def dim_products_category_history(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product versions with the category's name of their time."""
    p = products.select("productid", *PRODUCT_TRACKED, "categoryid")
    feed = product_feed(p).join(p.select("productid", "categoryid"), "productid")
    own = history.scd2_from_log(feed, ["productid"], "changed_at", [*PRODUCT_TRACKED, "categoryid"])
    names = history.scd2_from_log(category_feed(categories), ["categoryid"], "changed_at", ["categoryname"]).select(
        F.col("categoryid").alias("_category"), F.col("categoryname").alias("category_name"), "_effective_date", "_end_date")
    return (temporal.temporal_join(own.drop("_change_hash"), names, "categoryid", "_category", ["category_name"], ["productid"])
            .withColumnsRenamed({"productid": "product_id", "categoryid": "category_id"}))


def fact_sales_versioned(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with the customer's and product's version of the order date.

    A line keeps NULL versions where its order is older than the first version
    or falls after a delete.
    """
    f = fact.select("orderid", "product_id", "customer_id", "order_date", "line_total")
    f = history.asof_join(f, customers, ["customer_id"], "order_date", ["version_sk", "contacttitle"], prefix="customer_")
    f = f.drop("customer__effective_date", "customer__end_date")
    f = history.asof_join(f, products, ["product_id"], "order_date", ["version_sk", "unitprice"], prefix="product_")
    return f.drop("product__effective_date", "product__end_date")
