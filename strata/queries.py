"""Registered queries: name -> callable(spark, base_dir) -> DataFrame.

Every query reads the given tables (or what Spark derives from them) in
full.  Clock-valued columns (audit timestamps, ingest stamp, effective date
of a one-shot load, report date) are projected away so results are
reproducible; everything else is returned as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.operators.columns import drop_bookkeeping
from strata.plans import marts
from strata.plans.layers import Layers
from strata.plans.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _stable(df: DataFrame) -> DataFrame:
    return drop_bookkeeping(df)


# ---------------------------------------------------------------- clean layer
for _feed in ("categories", "products", "customers", "employees", "orders",
              "order_details", "shippers"):
    def _make(feed):
        def q(spark, base):
            return _stable(Layers(spark, base).clean(feed))
        return q
    register(f"{_feed}_clean")(_make(_feed))


# ---------------------------------------------------------------- dimensional
@register("dim_customers")
def q_dim_customers(spark, base):
    return _stable(Layers(spark, base).dim_customers)


@register("dim_products")
def q_dim_products(spark, base):
    return _stable(Layers(spark, base).dim_products)


@register("dim_employees")
def q_dim_employees(spark, base):
    return _stable(Layers(spark, base).dim_employees)


@register("dim_shippers")
def q_dim_shippers(spark, base):
    return _stable(Layers(spark, base).dim_shippers)


@register("dim_dates")
def q_dim_dates(spark, base):
    return Layers(spark, base).dim_dates


@register("fact_sales")
def q_fact_sales(spark, base):
    return _stable(Layers(spark, base).fact_sales)


# ---------------------------------------------------------------- marts
def _mart(builder, grain):
    def q(spark, base):
        return _stable(builder(Warehouse(spark, base), grain))
    return q


_MARTS = {
    "gold_sales_by_country": lambda L, g: marts.sales_by_country(L.fact_sales, L.dim_customers, g),
    "gold_sales_by_category": lambda L, g: marts.sales_by_category(L.fact_sales, L.dim_products, g),
    "gold_sales_by_employee": lambda L, g: marts.sales_by_employee(L.fact_sales, L.dim_employees, g),
    "gold_top_products": lambda L, g: marts.top_products(L.fact_sales, L.dim_products, g),
    "gold_kpis": lambda L, g: marts.kpis(L.fact_sales, L.dim_customers, L.dim_products,
                                         L.dim_employees, g),
    "gold_monthly_trends": lambda L, g: marts.monthly_trends(L.fact_sales, g),
}
for _name, _builder in _MARTS.items():
    register(_name)(_mart(_builder, "line"))
    register(f"{_name}_order_grain")(_mart(_builder, "order"))


# ---------------------------------------------------------------- table operators
from pyspark.sql import functions as F  # noqa: E402

from strata.operators import columns as ops  # noqa: E402
from strata.operators import quality as dq  # noqa: E402
from strata.operators.dedupe import remove_duplicates  # noqa: E402
from strata.sources.tables import Tables  # noqa: E402

CUSTOMER_RAW = ["customerID", "companyName", "contactName", "contactTitle", "city", "country"]


@register("util_audit_columns")
def q_util_audit_columns(spark, base):
    df = ops.add_audit_columns(Layers(spark, base).raw("customers"), source="crm_feed")
    return df.select(*CUSTOMER_RAW, "_source",
                     (F.col("_loaded_at") == F.col("_processing_timestamp")).alias("same_clock"),
                     F.col("_loaded_at").isNotNull().alias("stamped"))


@register("util_change_hash")
def q_util_change_hash(spark, base):
    df = ops.create_hash_column(Layers(spark, base).raw("customers"),
                                ["customerID", "companyName", "contactName", "city", "country"])
    return df.select("customerID", "_change_hash")


@register("util_change_hash_all")
def q_util_change_hash_all(spark, base):
    df = ops.create_hash_column(Layers(spark, base).raw("order_details"), None, "_row_hash")
    return df.select("orderID", "productID", "_row_hash")


@register("util_standardize_columns")
def q_util_standardize_columns(spark, base):
    o = Tables(spark, base).orders.select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("Cust-Key"),
        F.col("o_orderdate").alias("Order.Date"), F.col("o_orderpriority").alias("PRIORITY"))
    return ops.standardize_columns(o)


@register("util_trim_strings")
def q_util_trim_strings(spark, base):
    df = ops.normalize_strings(Layers(spark, base).raw("customers"), exclude_cols=["customerID"])
    return df.select(*CUSTOMER_RAW)


@register("util_fill_nulls")
def q_util_fill_nulls(spark, base):
    df = ops.handle_nulls(Layers(spark, base).raw("customers"),
                          {"contactName": "Unknown", "no_such_column": 0, "city": None})
    return df.select(*CUSTOMER_RAW)


@register("util_dedupe_first")
def q_util_dedupe_first(spark, base):
    return remove_duplicates(Tables(spark, base).lineitem, ["l_orderkey", "l_partkey"], "first")


@register("util_dedupe_last")
def q_util_dedupe_last(spark, base):
    return remove_duplicates(Tables(spark, base).lineitem, ["l_orderkey", "l_partkey"], "last")


@register("util_dedupe_full_row")
def q_util_dedupe_full_row(spark, base):
    o = Tables(spark, base).orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    return remove_duplicates(o)


@register("util_surrogate_key")
def q_util_surrogate_key(spark, base):
    li = Tables(spark, base).lineitem.select("l_orderkey", "l_linenumber")
    return ops.create_surrogate_key(li, ["l_orderkey", "l_linenumber"], "line_sk")


@register("util_version_columns")
def q_util_version_columns(spark, base):
    d = Layers(spark, base).dim_customers
    return d.select("customer_id", "_end_date", "_is_current",
                    F.col("_effective_date").isNotNull().alias("has_effective_date"))


# ---------------------------------------------------------------- data quality
DQ_AS_OF = "2024-01-02 12:00:00"


@register("dq_not_null")
def q_dq_not_null(spark, base):
    o = Warehouse(spark, base).clean("orders")
    return dq.evaluate(o, [dq.not_null(c) for c in
                           ("orderid", "customerid", "employeeid", "orderdate", "shippeddate")])


@register("dq_type_valid")
def q_dq_type_valid(spark, base):
    p = Layers(spark, base).raw("products")
    return dq.evaluate(p, [dq.type_valid("productID", "bigint"),
                           dq.type_valid("unitPrice", "decimal(10,2)"),
                           dq.type_valid("discontinued", "int"),
                           dq.type_valid("quantityPerUnit", "int"),
                           dq.type_valid("productName", "int")])


BUSINESS_RULES = [
    ("unit_price_non_negative", "unitprice >= 0"),
    ("quantity_non_negative", "quantity >= 0"),
    ("discount_at_most_one", "discount <= 1.0"),
]


@register("dq_business_rules")
def q_dq_business_rules(spark, base):
    od = Warehouse(spark, base).clean("order_details")
    return dq.evaluate(od, [dq.rule(n, p) for n, p in BUSINESS_RULES])


@register("dq_freshness")
def q_dq_freshness(spark, base):
    c = Layers(spark, base, as_of=ops.FIXED_CLOCK).clean("customers")
    return dq.evaluate(c, [dq.freshness("_loaded_at", DQ_AS_OF),
                           dq.freshness("ingestion_timestamp", DQ_AS_OF),
                           dq.row_count()])


def _per_table(frames, column="table"):
    out = None
    for name, df in frames:
        df = df.select(F.lit(name).alias(column), "*")
        out = df if out is None else out.unionByName(df)
    return out


@register("dq_row_count")
def q_dq_row_count(spark, base):
    L = Warehouse(spark, base)
    return _per_table((f"{t}_clean", dq.evaluate(L.clean(t), [dq.row_count()]))
                      for t in ("categories", "products", "customers", "employees", "orders",
                                "order_details", "shippers"))


@register("dq_duplicate_keys")
def q_dq_duplicate_keys(spark, base):
    L = Warehouse(spark, base)
    return _per_table([
        ("order_details_raw", dq.evaluate(L.raw("order_details"),
                                          [dq.unique_key(["orderID", "productID"])])),
        ("order_details_clean", dq.evaluate(L.clean("order_details"),
                                            [dq.unique_key(["orderid", "productid"])])),
        ("orders_clean", dq.evaluate(L.clean("orders"), [dq.unique_key(["orderid"])])),
    ])


@register("dq_referential_integrity")
def q_dq_referential_integrity(spark, base):
    L = Warehouse(spark, base)
    fact = L.fact_sales
    checks = [
        dq.foreign_key(["customer_id"], L.dim_customers, ["customer_id"]),
        dq.foreign_key(["product_id"], L.dim_products, ["product_id"]),
        dq.foreign_key(["employee_id"], L.dim_employees, ["employee_id"]),
        dq.foreign_key(["shipper_id"], L.dim_shippers, ["shipper_id"]),
    ]
    lines = dq.evaluate(L.clean("order_details"),
                        [dq.foreign_key(["orderid"], L.clean("orders"), ["orderid"])])
    return _per_table([("fact_sales", dq.evaluate(fact, checks)),
                       ("order_details_clean", lines)])


QUARANTINE_RULES = [
    ("freight_non_negative", "freight >= 0"),
    ("ordered_before_required", "orderdate <= requireddate"),
    ("shipped", "shippeddate IS NOT NULL"),
]


@register("dq_quarantine")
def q_dq_quarantine(spark, base):
    o = Warehouse(spark, base).clean("orders")
    flagged = dq.flag_rows(o, [dq.rule(n, p) for n, p in QUARANTINE_RULES])
    return flagged.select("orderid", "_dq_failures",
                          (F.col("_dq_failures") != "").alias("_quarantined"))


# ---------------------------------------------------------------- history and CDC
import datetime as _dt  # noqa: E402
import uuid as _uuid  # noqa: E402

from strata.functions import hashing  # noqa: E402
from strata.operators import cdc  # noqa: E402
from strata.operators import history  # noqa: E402
from strata.plans import dims as dimplans  # noqa: E402
from strata.session import scratch_path  # noqa: E402

EVENT_KEYS = ["user_id"]
DELETE_RULE = "event_type = 'error'"
SNAPSHOT_CUT = _dt.datetime(2024, 1, 16)


def event_history(events):
    return history.scd2_from_log(events, EVENT_KEYS, "ts", ["event_type"], tiebreak="event_id")


@register("scd2_history_events")
def q_scd2_history_events(spark, base):
    return event_history(Tables(spark, base).events)


EVENT_BATCH_WEEKS, EVENT_BATCHES = 7, 4


def _staged_batches(events, name, number):
    """Events written once, one folder for each batch ``number``; yields the
    batches in the order of their numbers (NULL numbers first)."""
    spark = events.sparkSession
    path = scratch_path(spark, name)
    events.withColumn("_batch", number).write.partitionBy("_batch").parquet(path)
    staged = spark.read.parquet(path)
    for n in sorted((r[0] for r in staged.select("_batch").distinct().collect()),
                    key=lambda x: (x is not None, x)):
        yield staged.where(F.col("_batch").eqNullSafe(F.lit(n))).drop("_batch")


def _history_by_batches(spark, base, name, number):
    ev = Tables(spark, base).events.select("user_id", "ts", "event_type", "event_id")
    target = scratch_path(spark, name)
    for batch in _staged_batches(ev, f"{name}-batches", number):
        history.apply_to_table(spark, target, batch, EVENT_KEYS, "ts", ["event_type"],
                               tiebreak="event_id")
    found = history.read_history(spark, target, EVENT_KEYS)
    return event_history(ev.limit(0)) if found is None else found


@register("scd2_apply_batch")
def q_scd2_apply_batch(spark, base):
    """History maintained batch by batch (one batch per week of events;
    events without a time are a batch of their own) in a stored table of key
    buckets; each batch rewrites only the buckets of the keys it touches."""
    week = F.floor(F.unix_date(F.to_date("ts")) / EVENT_BATCH_WEEKS).cast("int")
    return _history_by_batches(spark, base, "history-users", week)


@register("scd2_apply_out_of_order")
def q_scd2_apply_out_of_order(spark, base):
    """The same with batches that all span the whole time, so most events of
    every batch after the first are late."""
    return _history_by_batches(spark, base, "history-late", F.pmod("event_id", F.lit(EVENT_BATCHES)).cast("int"))


@register("asof_dim_join")
def q_asof_dim_join(spark, base):
    ev = Tables(spark, base).events
    facts = ev.select("event_id", "user_id", "ts", "value")
    return history.asof_join(facts, event_history(ev), EVENT_KEYS, "ts",
                             ["version_sk", "event_type"], prefix="v_")


def _event_state(events, delete_when=None):
    st = cdc.apply_changes(events.select("user_id", "event_id", "ts", "event_type", "value"),
                           EVENT_KEYS, "ts", "event_id", delete_when)
    return st.withColumn("_change_hash", hashing.change_hash(
        ["event_type", F.col("value").cast("decimal(12,2)")]))


@register("cdc_apply_latest")
def q_cdc_apply_latest(spark, base):
    return _event_state(Tables(spark, base).events, DELETE_RULE).drop("_change_hash")


@register("snapshot_diff")
def q_snapshot_diff(spark, base):
    ev = Tables(spark, base).events
    old = _event_state(ev.where(F.col("ts") < F.lit(SNAPSHOT_CUT)))
    new = _event_state(ev, DELETE_RULE)
    return cdc.snapshot_diff(old, new, EVENT_KEYS)


@register("cdc_soft_delete")
def q_cdc_soft_delete(spark, base):
    ev = Tables(spark, base).events
    return cdc.soft_delete(_event_state(ev), _event_state(ev, DELETE_RULE), EVENT_KEYS) \
        .drop("_change_hash")


@register("cdc_upsert_fact")
def q_cdc_upsert_fact(spark, base):
    """The fact upserted with re-sent order lines: the source is the fact
    rebuilt from the last copy of every line; changed lines are replaced."""
    L = Warehouse(spark, base)
    source = dimplans.fact_sales(L.clean("order_details", keep="last"), L.clean("orders"))
    target = L.fact_sales.select(*source.columns)   # the stored fact
    out = cdc.cdc_upsert(target, source, ["orderid", "product_id"], action_col="_cdc_action", derived=dimplans.FACT_HASHES)
    return _stable(out)


# ---------------------------------------------------------------- streaming ingest
from strata.session import scratch_path  # noqa: E402
from strata.sources.feeds import FEEDS  # noqa: E402
from strata.streaming import changes as stream_changes  # noqa: E402
from strata.streaming import ingest  # noqa: E402

EVENT_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                "value DOUBLE, props STRING")


def _stage_events(spark, base, where=None, path=None):
    """Drop the events as CSV files, one folder per day of ``ts``."""
    ev = Tables(spark, base).events
    if where is not None:
        ev = ev.where(where)
    path = path or scratch_path(spark, "events-csv")
    ingest.write_csv_files(ev.withColumn("day", F.to_date("ts")), path, split_by="day")
    return path


def _bronze(feed):
    def q(spark, base):
        src = scratch_path(spark, f"{feed}-csv")
        ingest.write_csv_files(Layers(spark, base).raw(feed).drop("ingestion_timestamp"), src)
        target, ckpt = scratch_path(spark, f"bronze-{feed}"), scratch_path(spark, f"ckpt-{feed}")
        ingest.run_to_end(ingest.write_incremental(ingest.raw_feed_stream(spark, src, feed),
                                                   target, ckpt))
        return ingest.read_table(spark, target).drop("ingestion_timestamp")
    return q


for _feed in FEEDS:
    register(f"bronze_{_feed}")(_bronze(_feed))


@register("ingest_stream_csv")
def q_ingest_stream_csv(spark, base):
    src = _stage_events(spark, base)
    target, ckpt = scratch_path(spark, "bronze-events"), scratch_path(spark, "ckpt-events")
    stream = ingest.stamp(ingest.csv_stream(spark, src, EVENT_SCHEMA))
    ingest.run_to_end(ingest.write_incremental(stream, target, ckpt))
    return ingest.read_table(spark, target).drop("ingestion_timestamp")


@register("ingest_stream_incremental")
def q_ingest_stream_incremental(spark, base):
    """Two runs on one checkpoint: the second sees only the newly dropped
    files; the table ends with every event exactly once."""
    src = scratch_path(spark, "events-csv")
    target, ckpt = scratch_path(spark, "bronze-events"), scratch_path(spark, "ckpt-events")
    early = F.coalesce(F.col("ts") < F.lit(SNAPSHOT_CUT), F.lit(True))
    for part in (early, ~early):
        _stage_events(spark, base, where=part, path=src)
        stream = ingest.stamp(ingest.csv_stream(spark, src, EVENT_SCHEMA))
        ingest.run_to_end(ingest.write_incremental(stream, target, ckpt))
    return ingest.read_table(spark, target).drop("ingestion_timestamp")


@register("ingest_stream_dedup")
def q_ingest_stream_dedup(spark, base):
    """A feed whose second delivery repeats all of the first: each event is
    stored once, the repeats being in the state or behind the watermark."""
    src = scratch_path(spark, "csv-events-twice")
    target, ckpt = scratch_path(spark, "bronze-dedup"), scratch_path(spark, "ckpt-dedup")
    early = F.coalesce(F.col("ts") < F.lit(SNAPSHOT_CUT), F.lit(True))
    for part in (early, F.lit(True)):
        _stage_events(spark, base, where=part, path=src)
        stream = ingest.csv_stream(spark, src, EVENT_SCHEMA, max_files_per_trigger=64)
        once = ingest.deduplicated(stream, ["event_id"], "ts", delay="30 days")
        ingest.run_to_end(ingest.write_incremental(ingest.stamp(once), target, ckpt))
    return ingest.read_table(spark, target).drop("ingestion_timestamp")


@register("cdc_stream_apply")
def q_cdc_stream_apply(spark, base):
    """Change feed applied micro-batch by micro-batch (a week of daily files
    per batch) into a versioned state; final state = latest per key."""
    src = _stage_events(spark, base)
    target, ckpt = scratch_path(spark, "state-users"), scratch_path(spark, "ckpt-state")
    stream = ingest.csv_stream(spark, src, EVENT_SCHEMA, max_files_per_trigger=7).drop("props")
    ingest.run_to_end(stream_changes.apply_stream(stream, target, ckpt, EVENT_KEYS, "ts",
                                                  "event_id", DELETE_RULE))
    return stream_changes.read_state(spark, target).select(
        "user_id", "event_id", "ts", "event_type", "value")


# ---------------------------------------------------------------- documented marts
from strata.plans import storage  # noqa: E402

_MORE = {
    "gold_monthly_yoy": lambda L: marts.monthly_yoy(L.fact_sales),
    "gold_team_summary": lambda L: marts.team_summary(L.fact_sales, L.dim_employees),
    "gold_territory_rollup": lambda L: marts.territory_rollup(L.fact_sales, L.dim_employees),
    "gold_category_top_bottom": lambda L: marts.category_top_bottom(L.fact_sales, L.dim_products),
    "gold_country_comparison": lambda L: marts.country_comparison(L.fact_sales, L.dim_customers),
    "gold_order_frequency": lambda L: marts.order_frequency(L.fact_sales),
    "gold_orders_by_weekday": lambda L: marts.orders_by_weekday(L.fact_sales, L.dim_dates),
    "gold_product_net_revenue": lambda L: marts.product_net_revenue(L.fact_sales, L.dim_products),
}
for _name, _builder in _MORE.items():
    register(_name)((lambda b: lambda spark, base: _stable(b(Warehouse(spark, base))))(_builder))


@register("dim_dates_calendar")
def q_dim_dates_calendar(spark, base):
    return dimplans.dim_dates_calendar(Layers(spark, base).clean("orders"))


@register("fact_sales_with_sks")
def q_fact_sales_with_sks(spark, base):
    return _stable(dimplans.fact_with_dimension_keys(Layers(spark, base).fact_sales))


@register("fact_partition_roundtrip")
def q_fact_partition_roundtrip(spark, base):
    """The fact written partitioned by order year/month (clustered by
    customer and date inside each partition) and read back whole."""
    path = scratch_path(spark, "fact-sales")
    fact = Warehouse(spark, base).fact_sales.drop(*storage.PARTITION_COLUMNS)
    storage.write_fact(_stable(fact), path, cluster_by=["customer_id", "order_date"])
    return storage.read_fact(spark, path)


@register("dq_fact_build_checks")
def q_dq_fact_build_checks(spark, base):
    """Rule results observed while the stored fact was written."""
    return Warehouse(spark, base).quality("fact_sales")


# ---------------------------------------------------------------- versioned model
from strata.plans import stored_fact, versions  # noqa: E402


@register("dim_customers_history")
def q_dim_customers_history(spark, base):
    return versions.dim_customers_history(Warehouse(spark, base).clean("customers"))


@register("dim_products_history")
def q_dim_products_history(spark, base):
    return versions.dim_products_history(Warehouse(spark, base).clean("products"))


@register("dim_employees_history")
def q_dim_employees_history(spark, base):
    return versions.dim_employees_history(Warehouse(spark, base).clean("employees"))


@register("dim_products_category_history")
def q_dim_products_category_history(spark, base):
    L = Warehouse(spark, base)
    return versions.dim_products_category_history(L.clean("products"), L.clean("categories"))


@register("fact_sales_versioned")
def q_fact_sales_versioned(spark, base):
    L = Warehouse(spark, base)
    return versions.fact_sales_versioned(
        L.fact_sales, versions.dim_customers_history(L.clean("customers")),
        versions.dim_products_history(L.clean("products")))


# ---------------------------------------------------------------- changes in the stored fact
def _stored_fact(spark, base, name):
    L = Warehouse(spark, base)
    store = stored_fact.fact_store(spark, scratch_path(spark, name))
    stored_fact.create(store, L.fact_sales.drop(*storage.PARTITION_COLUMNS))
    return L, store


def _read_fact(store):
    return _stable(store.read(stored_fact.TABLE).drop("_bucket"))


@register("fact_upsert_stored")
def q_fact_upsert_stored(spark, base):
    """Re-sent order lines written into the stored fact, month by month that
    they touch, and the whole fact read back."""
    L, store = _stored_fact(spark, base, "fact-upsert")
    stored_fact.upsert(store, dimplans.fact_sales(L.clean("order_details", keep="last"), L.clean("orders")))
    return _read_fact(store)


@register("fact_upsert_by_feed")
def q_fact_upsert_by_feed(spark, base):
    """A snapshot deletes every seventh order; then a small feed with moved,
    shipped, new and re-sent deleted lines is written, twice by one batch id."""
    L, store = _stored_fact(spark, base, "fact-feed")
    fact = L.fact_sales.drop(*storage.PARTITION_COLUMNS)
    stored_fact.soft_delete(store, fact.where("orderid % 7 != 0").select("orderid"), ["orderid"])
    store.vacuum(1)  # nobody else reads this store
    new_key = F.when(F.col("orderid") % 50 == 3, F.col("product_id") + 10_000_000).otherwise(F.col("product_id"))
    feed = (fact.where("orderid % 50 in (1, 2, 3) or orderid % 35 = 0")
            .withColumns({"order_date": F.when(F.col("orderid") % 50 == 1, F.add_months("order_date", 1)).otherwise(F.col("order_date")),
                          "shipped_date": F.when(F.col("orderid") % 50 == 2, F.col("required_date")).otherwise(F.col("shipped_date")),
                          "product_id": new_key})
            .withColumn("fact_sales_sk", hashing.surrogate_key(["orderid", "product_id"])))
    for _ in range(2):
        stored_fact.upsert(store, feed, batch_id=7)
    store.vacuum(1)
    return _read_fact(store)


@register("fact_soft_delete_stored")
def q_fact_soft_delete_stored(spark, base):
    """Lines of orders that a snapshot of closed orders lacks are flagged in
    the stored fact; the whole fact is read back."""
    L, store = _stored_fact(spark, base, "fact-delete")
    closed = Tables(spark, base).orders.where("o_orderstatus != 'P'") \
        .select(F.col("o_orderkey").cast("bigint").alias("orderid"))
    stored_fact.soft_delete(store, closed, ["orderid"])
    return _read_fact(store)


@register("cdc_delete_feed")
def q_cdc_delete_feed(spark, base):
    ev = Tables(spark, base).events
    feed = ev.select("user_id", F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"))
    return cdc.apply_delete_feed(_event_state(ev).drop("_change_hash"), feed, EVENT_KEYS)


@register("dq_quarantine_split")
def q_dq_quarantine_split(spark, base):
    """Good and bad orders written to tables of their own and read back."""
    o = Warehouse(spark, base).clean("orders").select("orderid", "orderdate", "requireddate", "shippeddate", "freight")
    parts = dq.quarantine(o, [dq.rule(n, p) for n, p in QUARANTINE_RULES])
    out = None
    for name, df in zip(("good", "bad"), parts):
        path = scratch_path(spark, f"orders-{name}")
        df.write.parquet(path)
        back = spark.read.parquet(path)
        if name == "good":
            back = back.withColumn("_dq_failures", F.lit(""))
        back = back.select("orderid", "_dq_failures", F.lit(name).alias("_part"))
        out = back if out is None else out.unionByName(back)
    return out


@register("ingest_schema_evolution")
def q_ingest_schema_evolution(spark, base):
    """Two ingests into one table, the second with a column more."""
    ev = Tables(spark, base).events
    target = scratch_path(spark, "bronze-evolving")
    early = F.coalesce(F.col("ts") < F.lit(SNAPSHOT_CUT), F.lit(True))
    for number, (where, drop) in enumerate(((early, ["value"]), (~early, []))):
        src, ckpt = scratch_path(spark, f"evolving-csv-{number}"), scratch_path(spark, f"ckpt-evolving-{number}")
        part = ev.where(where).drop(*drop)
        ingest.write_csv_files(part, src)
        columns = [c for c in EVENT_SCHEMA.split(", ") if c.split()[0] not in drop]
        stream = ingest.stamp(ingest.csv_stream(spark, src, ", ".join(columns)))
        ingest.run_to_end(ingest.write_incremental(stream, f"{target}/load={number}", ckpt))
    return ingest.read_table(spark, target).drop("ingestion_timestamp", "load")


@register("fact_saved_with_statistics")
def q_fact_saved_with_statistics(spark, base):
    """The fact saved as a catalog table with ANALYZE; rows and distinct
    orders of the table by year."""
    name = f"strata_fact_{_uuid.uuid4().hex[:8]}"
    fact = Warehouse(spark, base).fact_sales.select("orderid", "line_total", "order_year")
    storage.save_table(spark, fact, name, scratch_path(spark, "fact-table"), partition_by=["order_year"],
                       analyze_columns=["orderid"])
    return spark.read.table(name).groupBy("order_year").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("orderid").alias("orders"),
        F.sum("line_total").cast("decimal(28,2)").alias("sales"))


# ---------------------------------------------------------------- layers in increments
from strata.plans.incremental import IncrementalLayers  # noqa: E402


@register("layers_incremental")
def q_layers_incremental(spark, base):
    """The fact after three batches: headers come by order number, lines by
    quantity (so before and after their header, and repeats of a line in other
    batches than the first); the last batch deletes every eleventh order."""
    L = Layers(spark, base)
    layers = IncrementalLayers(spark, scratch_path(spark, "increments"), {})
    orders, lines = (L.raw(f).withColumn("ingestion_timestamp", F.lit(ops.FIXED_CLOCK).cast("timestamp"))
                     for f in IncrementalLayers.SALES)
    number = F.col("orderID").cast("bigint")
    for n in range(3):
        raws = {"orders": orders.where(F.pmod(number, F.lit(3)) == n),
                "order_details": lines.where(F.pmod(F.col("quantity").cast("int"), F.lit(3)) == n)}
        gone = {"orders": orders.where(number % 11 == 0).select(number.alias("orderid"))} if n == 2 else {}
        layers.apply(n, versions.CHANGED, raws, gone)
        layers.vacuum(1)  # nobody else reads these stores
    return _stable(layers.read_fact())


@register("layers_incremental_history")
def q_layers_incremental_history(spark, base):
    """Customer versions after three batches: all, the changed third, deletes."""
    raw = Layers(spark, base).raw("customers")
    number = F.col("customerID").cast("bigint")
    layers = IncrementalLayers(spark, scratch_path(spark, "increments"), {"customers": versions.CUSTOMER_TRACKED})
    changed = raw.where(number % 3 == 0).withColumn("contactTitle", F.concat("contactTitle", F.lit(" II")))
    gone = raw.where(number % 11 == 0).select(F.col("customerID").alias("customerid"))
    for n, (at, rows, deletes) in enumerate(((versions.FIRST, raw, {}), (versions.CHANGED, changed, {}),
                                             (versions.DELETED, raw.limit(0), {"customers": gone}))):
        layers.apply(n, at, {"customers": rows.withColumn("ingestion_timestamp", F.lit(at).cast("timestamp"))}, deletes)
    return layers.read_history("customers").withColumnRenamed("customerid", "customer_id")


# ---------------------------------------------------------------- expectations on the way in
from strata.streaming import expectations as expect  # noqa: E402

EVENT_EXPECTATIONS = [
    expect.Expectation("has_id", "event_id IS NOT NULL", expect.FAIL),
    expect.Expectation("no_error", "event_type <> 'error'", expect.DROP),
    expect.Expectation("value_at_least_ten", "value >= 10", expect.DROP),
    expect.Expectation("even_user", "user_id % 2 = 0", expect.WARN),
]


def _checked_events(spark, base):
    """Two runs on one checkpoint, the second with the later files."""
    src = scratch_path(spark, "checked-csv")
    target, ckpt = scratch_path(spark, "checked-events"), scratch_path(spark, "ckpt-checked")
    early = F.coalesce(F.col("ts") < F.lit(SNAPSHOT_CUT), F.lit(True))
    for part in (early, ~early):
        _stage_events(spark, base, where=part, path=src)
        stream = ingest.csv_stream(spark, src, EVENT_SCHEMA, max_files_per_trigger=64)
        ingest.run_to_end(expect.write_checked(stream, target, ckpt, EVENT_EXPECTATIONS))
    return target


@register("ingest_expectations")
def q_ingest_expectations(spark, base):
    """Good and rejected events with the rules that each broke."""
    target = _checked_events(spark, base)
    return expect.read_good(spark, target).withColumn("part", F.lit("good")).unionByName(
        expect.read_rejected(spark, target).withColumn("part", F.lit("rejected")))


@register("ingest_expectation_metrics")
def q_ingest_expectation_metrics(spark, base):
    """Failed and total rows of each rule, over all batches."""
    return expect.read_metrics(spark, _checked_events(spark, base)).groupBy("check", "action").agg(
        F.sum("failed").alias("failed"), F.sum("total").alias("total"))


# ---------------------------------------------------------------- change attribution
from strata.operators import attribution  # noqa: E402


def _attributed(spark, base):
    """dimension -> changes of its versions, keyed by a text."""
    L = Warehouse(spark, base)
    for name, key, df, tracked in (
            ("customers", "customer_id", versions.dim_customers_history(L.clean("customers")), versions.CUSTOMER_TRACKED),
            ("products", "product_id", versions.dim_products_history(L.clean("products")), versions.PRODUCT_TRACKED)):
        changes = attribution.version_changes(df, [key], tracked)
        yield name, changes.withColumn("key", F.col(key).cast("string")).drop(key)


@register("dim_history_changes")
def q_dim_history_changes(spark, base):
    """Old and new value of every column that changed between versions."""
    return _per_table(_attributed(spark, base), "dimension")


@register("dim_history_change_counts")
def q_dim_history_change_counts(spark, base):
    return _per_table(((name, attribution.changes_by_column(df, ["key"])) for name, df in _attributed(spark, base)), "dimension")


@register("dim_dates_holidays")
def q_dim_dates_holidays(spark, base):
    """The calendar with a holiday table: both fixed days of every order year."""
    orders = Layers(spark, base).clean("orders")
    holidays = orders.select(F.year("orderdate").alias("y")).where("y IS NOT NULL").distinct().select(
        F.explode(F.array(F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(25)))).alias("holiday_date"))
    return dimplans.dim_dates_calendar(orders, holidays)
