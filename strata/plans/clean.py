"""Cleaning layer: raw feed -> typed, filled, stamped, hashed, deduplicated.

One generic chain, table differences as data (``CleanSpec``):

    required columns -> standard names -> trim -> typed casts -> null fills
    -> dedupe on the key -> derived columns -> audit stamp -> change hash

Derived, audit and hash columns are functions of the business columns (or
constants of the run), so deduplicating before computing them keeps the
same winner and result while the aggregate carries only the business
columns, and md5 runs on surviving rows only.  The steps before and after
the dedupe are single Projects; the dedupe is one aggregate (partial on the
map side, one shuffle on the primary key).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing
from strata.operators import columns as ops
from strata.operators.dedupe import remove_duplicates


@dataclass(frozen=True)
class CleanSpec:
    name: str
    required: Sequence[str]
    key: Sequence[str]
    hash_columns: Sequence[str]
    source_tag: str
    casts: Mapping[str, str] = field(default_factory=dict)
    fills: Mapping[str, object] = field(default_factory=dict)
    trim: bool = True
    derive: Callable[[DataFrame, str], DataFrame] | None = None


MONEY = "decimal(12,2)"


def line_amounts(df: DataFrame, money: str = MONEY) -> DataFrame:
    """Extended and discount amounts of an order line; a wider ``money`` type
    takes amounts that the default one cannot hold."""
    line_total = (F.col("quantity") * F.col("unitprice")).cast(money)
    return df.withColumn("line_total", line_total).withColumn(
        "discount_amount", (F.col("line_total") * F.col("discount")).cast(money))


# Fixed table rules of the cleaning layer: required raw columns, typed casts,
# null fills, hashed columns and source tags per table.  Identifier casts are
# bigint (order and part keys pass 2^31 at large scale factors; an int cast
# would turn them into NULL).
SPECS: dict[str, CleanSpec] = {
    "categories": CleanSpec(
        name="categories_clean",
        required=["categoryID", "categoryName"],
        key=["categoryid"],
        casts={"categoryid": "int"},
        fills={"description": "N/A"},
        hash_columns=["categoryid", "categoryname", "description"],
        source_tag="northwind_categories",
    ),
    "products": CleanSpec(
        name="products_clean",
        required=["productID", "productName", "categoryID"],
        key=["productid"],
        casts={"productid": "bigint", "categoryid": "int", "unitprice": "decimal(10,2)",
               "quantityperunit": "string", "discontinued": "int"},
        fills={"unitprice": 0.00, "quantityperunit": "Unknown", "discontinued": 0},
        hash_columns=["productid", "productname", "categoryid", "unitprice", "discontinued"],
        source_tag="northwind_products",
    ),
    "customers": CleanSpec(
        name="customers_clean",
        required=["customerID", "companyName"],
        key=["customerid"],
        fills={"contactname": "Unknown", "contacttitle": "Unknown", "city": "Unknown",
               "country": "Unknown"},
        hash_columns=["customerid", "companyname", "contactname", "city", "country"],
        source_tag="northwind_customers",
    ),
    "employees": CleanSpec(
        name="employees_clean",
        required=["employeeID", "employeeName"],
        key=["employeeid"],
        casts={"employeeid": "bigint", "reportsto": "bigint"},
        fills={"title": "Unknown", "city": "Unknown", "country": "Unknown", "reportsto": -1},
        hash_columns=["employeeid", "employeename", "title", "city", "country"],
        source_tag="northwind_employees",
    ),
    "orders": CleanSpec(
        name="orders_clean",
        required=["orderID", "customerID", "employeeID", "orderDate"],
        key=["orderid"],
        trim=False,
        casts={"orderid": "bigint", "customerid": "string", "employeeid": "bigint",
               "shipperid": "int", "orderdate": "date", "requireddate": "date",
               "shippeddate": "date", "freight": "decimal(10,2)"},
        fills={"freight": 0.00, "shippeddate": None},
        hash_columns=["orderid", "customerid", "employeeid", "orderdate", "freight"],
        source_tag="northwind_orders",
    ),
    "order_details": CleanSpec(
        name="order_details_clean",
        required=["orderID", "productID", "quantity", "unitPrice"],
        key=["orderid", "productid"],
        trim=False,
        casts={"orderid": "bigint", "productid": "bigint", "unitprice": "decimal(10,2)",
               "quantity": "int", "discount": "decimal(5,4)"},
        fills={"discount": 0.0, "quantity": 0},
        derive=line_amounts,
        hash_columns=["orderid", "productid", "quantity", "unitprice", "discount"],
        source_tag="northwind_order_details",
    ),
    "shippers": CleanSpec(
        name="shippers_clean",
        required=["shipperID", "companyName"],
        key=["shipperid"],
        casts={"shipperid": "int"},
        fills={"companyname": "Unknown"},
        hash_columns=["shipperid", "companyname"],
        source_tag="northwind_shippers",
    ),
}

INGEST_COL = "ingestion_timestamp"


def derived_hashes(feed: str) -> dict[str, hashing.Derived]:
    """The hash columns of a clean table."""
    return {"_change_hash": hashing.Derived(tuple(SPECS[feed].hash_columns), hashing.CHANGE_NULL)}


def typed(raw: DataFrame, spec: CleanSpec, strict_casts: bool = False) -> DataFrame:
    """Raw rows with standard names, trimmed, cast and filled."""
    ops.validate_required_columns(raw, spec.required)
    df = ops.standardize_columns(raw)
    if spec.trim:
        df = ops.normalize_strings(df)
    df = ops.cast_columns(df, spec.casts, strict=strict_casts)
    return ops.handle_nulls(df, spec.fills)


def deduplicated(df: DataFrame, spec: CleanSpec, keep: str = "first") -> DataFrame:
    """One typed row a key: newest ingest first, then every business column
    ascending, nulls first.  The winner of winners is the winner of all."""
    order = [f"-{INGEST_COL}"] if INGEST_COL in df.columns else []
    return remove_duplicates(df, subset=spec.key, keep=keep, order_by=order)


def finished(df: DataFrame, spec: CleanSpec, as_of=None, money: str = MONEY) -> DataFrame:
    """Derived, audit and hash columns of deduplicated rows."""
    if spec.derive is not None:
        df = spec.derive(df, money)
    df = ops.add_audit_columns(df, source=spec.source_tag, as_of=as_of)
    return ops.create_hash_column(df, spec.hash_columns)


def clean(raw: DataFrame, spec: CleanSpec, as_of=None, strict_casts: bool = False,
          keep: str = "first", money: str = MONEY) -> DataFrame:
    """Run the cleaning chain on one raw feed.

    ``keep="last"`` keeps the last row of a key instead (the last re-sent
    version of a record).  ``money`` is the type of derived amounts."""
    return finished(deduplicated(typed(raw, spec, strict_casts), spec, keep), spec, as_of, money)


def clean_table(raw: DataFrame, feed: str, as_of=None, keep: str = "first", money: str = MONEY) -> DataFrame:
    return clean(raw, SPECS[feed], as_of=as_of, keep=keep, money=money)
