"""Oracle SQL (DuckDB) per registered query name."""

from __future__ import annotations

from oracle.base import MONEY, mean, pct, ratio, with_model

ORACLE: dict[str, str] = {}

for _t in ("categories", "products", "customers", "employees", "orders", "order_details",
           "shippers"):
    ORACLE[f"{_t}_clean"] = with_model(f"SELECT * FROM {_t}_clean")

for _t in ("dim_customers", "dim_products", "dim_employees", "dim_shippers", "dim_dates",
           "fact_sales"):
    ORACLE[_t] = with_model(f"SELECT * FROM {_t}")

CUR = "WHERE _is_current"

# ------------------------------------------------------------------ G1
ORACLE["gold_sales_by_country"] = with_model(f"""
SELECT country, CAST(sum(line_total) AS {MONEY}) AS total_sales,
       CAST(sum(order_quantity) AS BIGINT) AS total_quantity,
       count(orderid) AS total_orders, count(customer_id) AS unique_customers,
       {mean('sum(line_total)', 'count(line_total)')} AS avg_order_value,
       min(line_total) AS min_order_value, max(line_total) AS max_order_value,
       count(*) FILTER (WHERE discount_rate > 0) AS orders_with_discount,
       {pct('count(*) FILTER (WHERE discount_rate > 0)', 'count(orderid)')} AS discount_percentage,
       'gold_sales_by_country' AS _source
FROM fact_sales JOIN (SELECT customer_id, country FROM dim_customers {CUR}) c USING (customer_id)
GROUP BY country""")

ORACLE["gold_sales_by_country_order_grain"] = with_model(f"""
SELECT country, CAST(sum(ot) AS {MONEY}) AS total_sales,
       CAST(sum(q) AS BIGINT) AS total_quantity,
       count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       {mean('sum(ot)', 'count(ot)')} AS avg_order_value,
       CAST(min(ot) AS DECIMAL(22,2)) AS min_order_value,
       CAST(max(ot) AS DECIMAL(22,2)) AS max_order_value,
       count(*) FILTER (WHERE disc = 1) AS orders_with_discount,
       {pct('count(*) FILTER (WHERE disc = 1)', 'count(*)')} AS discount_percentage,
       'gold_sales_by_country' AS _source
FROM o JOIN (SELECT customer_id, country FROM dim_customers {CUR}) c USING (customer_id)
GROUP BY country""", o="""
  SELECT customer_id, orderid, sum(line_total) AS ot, sum(order_quantity) AS q,
         max(CASE WHEN discount_rate > 0 THEN 1 ELSE 0 END) AS disc
  FROM fact_sales GROUP BY customer_id, orderid""")

# ------------------------------------------------------------------ G2
_CAT_JOIN = f"""fact_sales f JOIN (SELECT product_id, category_name, discontinued
                 FROM dim_products {CUR}) p USING (product_id)"""
_CAT_COMMON = f"""CAST(sum(line_total) AS {MONEY}) AS total_sales,
       CAST(sum(order_quantity) AS BIGINT) AS total_quantity"""
_CAT_TAIL = f"""{mean('sum(unit_price)', 'count(unit_price)')} AS avg_unit_price,
       {mean('sum(discount_rate)', 'count(discount_rate)', scale=4, total_scale=4)} AS avg_discount_rate,
       {pct('sum(line_total)', f'(SELECT sum(line_total) FROM {_CAT_JOIN})', num_scale=2, den_scale=2)} AS revenue_contribution,
       'gold_sales_by_category' AS _source"""
ORACLE["gold_sales_by_category"] = with_model(f"""
SELECT category_name, {_CAT_COMMON}, count(orderid) AS total_orders,
       count(*) FILTER (WHERE discontinued = 0) AS active_products,
       count(*) FILTER (WHERE discontinued = 1) AS discontinued_products,
       {_CAT_TAIL}
FROM {_CAT_JOIN} GROUP BY category_name""")
ORACLE["gold_sales_by_category_order_grain"] = with_model(f"""
SELECT category_name, {_CAT_COMMON}, count(DISTINCT orderid) AS total_orders,
       count(DISTINCT product_id) FILTER (WHERE discontinued = 0) AS active_products,
       count(DISTINCT product_id) FILTER (WHERE discontinued = 1) AS discontinued_products,
       {_CAT_TAIL}
FROM {_CAT_JOIN} GROUP BY category_name""")

# ------------------------------------------------------------------ G3
_EMP_KEYS = "employee_id, employee_name, title, city, country, manager_name"
_EMP_JOIN = f"fact_sales JOIN (SELECT {_EMP_KEYS} FROM dim_employees {CUR}) e USING (employee_id)"
_EMP_FINAL = f"""
SELECT {_EMP_KEYS}, total_sales, total_quantity, total_orders, unique_customers,
       {mean('v_sum', 'v_n')} AS avg_order_value,
       {mean('dr_sum', 'dr_n', scale=4, total_scale=4)} AS avg_discount_rate,
       first_order_date, last_order_date, sales_rank,
       {pct('sales_rank - 1', 'n_emp')} AS sales_percentile,
       'gold_sales_by_employee' AS _source
FROM (SELECT *, CAST(rank() OVER (ORDER BY total_sales DESC NULLS LAST) AS INT) AS sales_rank,
             count(*) OVER () AS n_emp FROM a) r"""
_EMP_COMMON = f"""CAST(sum(line_total) AS {MONEY}) AS total_sales,
         CAST(sum(order_quantity) AS BIGINT) AS total_quantity,
         sum(discount_rate) AS dr_sum, count(discount_rate) AS dr_n,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date"""
ORACLE["gold_sales_by_employee"] = with_model(_EMP_FINAL, a=f"""
  SELECT {_EMP_KEYS}, {_EMP_COMMON},
         count(orderid) AS total_orders, count(customer_id) AS unique_customers,
         sum(line_total) AS v_sum, count(line_total) AS v_n
  FROM {_EMP_JOIN} GROUP BY {_EMP_KEYS}""")
ORACLE["gold_sales_by_employee_order_grain"] = with_model(_EMP_FINAL, a=f"""
  SELECT l.*, o.total_orders, o.unique_customers, o.v_sum, o.v_n
  FROM (SELECT {_EMP_KEYS}, {_EMP_COMMON} FROM {_EMP_JOIN} GROUP BY {_EMP_KEYS}) l
  JOIN (SELECT employee_id, count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
               sum(ot) AS v_sum, count(ot) AS v_n
        FROM (SELECT employee_id, orderid, customer_id, sum(line_total) AS ot
              FROM fact_sales GROUP BY employee_id, orderid, customer_id) x
        GROUP BY employee_id) o USING (employee_id)""")

# ------------------------------------------------------------------ G4
_PROD_KEYS = "product_id, product_name, category_name, unit_price, discontinued"
_TOP_FINAL = f"""
SELECT {_PROD_KEYS}, total_sales, total_quantity, order_count, unique_customers,
       {mean('dr_sum', 'dr_n', scale=4, total_scale=4)} AS avg_discount_rate,
       {mean('v_sum', 'v_n')} AS avg_order_value,
       rank_by_sales, rank_by_quantity, rank_by_popularity,
       CASE WHEN discontinued = 1 THEN 'Discontinued' WHEN order_count = 0 THEN 'No Sales'
            ELSE 'Active' END AS product_status,
       'gold_top_products' AS _source
FROM (SELECT *,
        CAST(rank() OVER (ORDER BY total_sales DESC NULLS LAST) AS INT) AS rank_by_sales,
        CAST(rank() OVER (ORDER BY total_quantity DESC NULLS LAST) AS INT) AS rank_by_quantity,
        CAST(rank() OVER (ORDER BY unique_customers DESC NULLS LAST) AS INT) AS rank_by_popularity
      FROM a) r
WHERE rank_by_sales <= 50"""
_PROD_DIM = f"(SELECT {_PROD_KEYS} FROM dim_products {CUR}) d"
ORACLE["gold_top_products"] = with_model(_TOP_FINAL, a=f"""
  SELECT d.product_id, d.product_name, d.category_name, d.unit_price, d.discontinued,
         CAST(sum(line_total) AS {MONEY}) AS total_sales,
         CAST(sum(order_quantity) AS BIGINT) AS total_quantity,
         count(orderid) AS order_count, count(customer_id) AS unique_customers,
         sum(discount_rate) AS dr_sum, count(discount_rate) AS dr_n,
         sum(line_total) AS v_sum, count(line_total) AS v_n
  FROM fact_sales f JOIN {_PROD_DIM} ON f.product_id = d.product_id
  GROUP BY d.product_id, d.product_name, d.category_name, d.unit_price, d.discontinued""")
ORACLE["gold_top_products_order_grain"] = with_model(_TOP_FINAL, a=f"""
  SELECT d.product_id, d.product_name, d.category_name, d.unit_price, d.discontinued,
         coalesce(s.total_sales, CAST(0 AS {MONEY})) AS total_sales,
         coalesce(s.total_quantity, 0) AS total_quantity,
         coalesce(s.order_count, 0) AS order_count,
         coalesce(s.unique_customers, 0) AS unique_customers,
         s.dr_sum, coalesce(s.dr_n, 0) AS dr_n, s.v_sum, coalesce(s.v_n, 0) AS v_n
  FROM {_PROD_DIM} LEFT JOIN (
    SELECT product_id, CAST(sum(pt) AS {MONEY}) AS total_sales,
           CAST(sum(q) AS BIGINT) AS total_quantity, count(*) AS order_count,
           count(DISTINCT customer_id) AS unique_customers,
           sum(drs) AS dr_sum, CAST(sum(drn) AS BIGINT) AS dr_n, sum(pt) AS v_sum, count(pt) AS v_n
    FROM (SELECT product_id, orderid, customer_id, sum(line_total) AS pt,
                 sum(order_quantity) AS q, sum(discount_rate) AS drs, count(discount_rate) AS drn
          FROM fact_sales GROUP BY product_id, orderid, customer_id) x
    GROUP BY product_id) s ON s.product_id = d.product_id""")

# ------------------------------------------------------------------ G5
_N_CUST = f"(SELECT count(DISTINCT customer_id) FROM dim_customers {CUR})"
_N_PROD = f"(SELECT count(DISTINCT product_id) FROM dim_products {CUR})"
_N_EMP = f"(SELECT count(DISTINCT employee_id) FROM dim_employees {CUR})"
_KPI_FINAL = f"""
SELECT total_sales, total_orders, unique_customers, unique_products_sold,
       {mean('v_sum', 'v_n')} AS avg_order_value, total_units_sold, total_discount_amount,
       {mean('dr_sum', 'dr_n', scale=4, total_scale=4)} AS avg_discount_rate,
       {_N_CUST} AS total_customers_in_database, {_N_PROD} AS total_products_in_database,
       {_N_EMP} AS total_employees, first_order_date, last_order_date,
       {pct('unique_customers', _N_CUST)} AS customer_conversion_rate,
       {pct('total_discount_amount', 'total_sales', num_scale=2, den_scale=2)} AS discount_impact,
       {ratio('total_units_sold', 'total_orders')} AS avg_order_size,
       'executive_summary' AS kpi_type, 'gold_kpis' AS _source
FROM k"""
_DISC = "CASE WHEN discount_rate > 0 THEN discount_amount ELSE 0 END"
ORACLE["gold_kpis"] = with_model(_KPI_FINAL, k=f"""
  SELECT CAST(sum(line_total) AS {MONEY}) AS total_sales, count(orderid) AS total_orders,
         count(customer_id) AS unique_customers, count(product_id) AS unique_products_sold,
         sum(line_total) AS v_sum, count(line_total) AS v_n,
         CAST(sum(order_quantity) AS BIGINT) AS total_units_sold,
         CAST(sum({_DISC}) AS {MONEY}) AS total_discount_amount,
         sum(discount_rate) AS dr_sum, count(discount_rate) AS dr_n,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM fact_sales""")
ORACLE["gold_kpis_order_grain"] = with_model(_KPI_FINAL, k=f"""
  SELECT CAST(sum(line_total) AS {MONEY}) AS total_sales, count(DISTINCT orderid) AS total_orders,
         count(DISTINCT customer_id) AS unique_customers,
         count(DISTINCT product_id) AS unique_products_sold,
         (SELECT sum(ot) FROM (SELECT sum(line_total) AS ot FROM fact_sales GROUP BY orderid, customer_id) x) AS v_sum,
         (SELECT count(ot) FROM (SELECT sum(line_total) AS ot FROM fact_sales GROUP BY orderid, customer_id) x) AS v_n,
         CAST(sum(order_quantity) AS BIGINT) AS total_units_sold,
         CAST(sum({_DISC}) AS {MONEY}) AS total_discount_amount,
         sum(discount_rate) AS dr_sum, count(discount_rate) AS dr_n,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM fact_sales""")

# ------------------------------------------------------------------ G6
_MA = "RANGE BETWEEN INTERVAL 2 MONTH PRECEDING AND CURRENT ROW"
_MONTH_FINAL = f"""
SELECT year_month, CAST(year(year_month) AS INT) AS year, CAST(month(year_month) AS INT) AS month,
       monthly_sales, monthly_quantity, monthly_orders, monthly_customers,
       {mean('v_sum', 'v_n')} AS avg_order_value,
       {mean('dr_sum', 'dr_n', scale=4, total_scale=4)} AS avg_discount_rate,
       {mean('ma_sum', 'ma_n')} AS sales_3m_moving_avg,
       {pct('monthly_sales - prev', 'prev', num_scale=2, den_scale=2)} AS mom_sales_change,
       'gold_monthly_trends' AS _source
FROM w"""
_MONTH_COMMON = f"""CAST(date_trunc('month', order_date) AS DATE) AS year_month,
         CAST(sum(line_total) AS {MONEY}) AS monthly_sales,
         CAST(sum(order_quantity) AS BIGINT) AS monthly_quantity,
         sum(discount_rate) AS dr_sum, count(discount_rate) AS dr_n"""
ORACLE["gold_monthly_trends"] = with_model(_MONTH_FINAL, m=f"""
  SELECT {_MONTH_COMMON}, count(orderid) AS monthly_orders, count(customer_id) AS monthly_customers,
         sum(line_total) AS v_sum, count(line_total) AS v_n
  FROM fact_sales GROUP BY 1""", w=f"""
  SELECT *, sum(monthly_sales) OVER (ORDER BY year_month {_MA}) AS ma_sum,
         count(monthly_sales) OVER (ORDER BY year_month {_MA}) AS ma_n,
         lag(monthly_sales) OVER (ORDER BY year_month) AS prev
  FROM m""")
ORACLE["gold_monthly_trends_order_grain"] = with_model(_MONTH_FINAL, m=f"""
  SELECT l.*, o.monthly_orders, o.monthly_customers, o.v_sum, o.v_n
  FROM (SELECT {_MONTH_COMMON} FROM fact_sales GROUP BY 1) l
  JOIN (SELECT year_month, count(*) AS monthly_orders,
               count(DISTINCT customer_id) AS monthly_customers, sum(ot) AS v_sum, count(ot) AS v_n
        FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS year_month, orderid,
                     customer_id, sum(line_total) AS ot
              FROM fact_sales GROUP BY 1, 2, 3) x GROUP BY year_month) o
    ON l.year_month IS NOT DISTINCT FROM o.year_month""", w=f"""
  SELECT m.*, sum(m.monthly_sales) OVER (ORDER BY m.year_month {_MA}) AS ma_sum,
         count(m.monthly_sales) OVER (ORDER BY m.year_month {_MA}) AS ma_n,
         p.monthly_sales AS prev
  FROM m LEFT JOIN (SELECT year_month, monthly_sales FROM m) p
    ON p.year_month = CAST(m.year_month - INTERVAL 1 MONTH AS DATE)""")

# ------------------------------------------------------------------ table operators
from oracle.base import check_row, hash_of, sk, with_raw  # noqa: E402

_CUST_RAW = "customerID, companyName, contactName, contactTitle, city, country"
ORACLE["util_audit_columns"] = with_raw(
    f"SELECT {_CUST_RAW}, 'crm_feed' AS _source, TRUE AS same_clock, TRUE AS stamped "
    "FROM raw_customers")
ORACLE["util_change_hash"] = with_raw(
    f"SELECT customerID, {hash_of(['customerID', 'companyName', 'contactName', 'city', 'country'])}"
    " AS _change_hash FROM raw_customers")
ORACLE["util_change_hash_all"] = with_raw(
    "SELECT orderID, productID, "
    f"{hash_of(['orderID', 'productID', 'unitPrice', 'quantity', 'discount', 'ingestion_timestamp'])}"
    " AS _row_hash FROM raw_order_details")
ORACLE["util_standardize_columns"] = """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderdate AS order_date,
       o_orderpriority AS priority FROM orders"""
ORACLE["util_trim_strings"] = with_raw(
    "SELECT customerID, trim(companyName) AS companyName, trim(contactName) AS contactName, "
    "trim(contactTitle) AS contactTitle, trim(city) AS city, trim(country) AS country "
    "FROM raw_customers")
ORACLE["util_fill_nulls"] = with_raw(
    "SELECT customerID, companyName, coalesce(contactName, 'Unknown') AS contactName, "
    "contactTitle, city, country FROM raw_customers")
_LI_REST = ["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
ORACLE["util_dedupe_first"] = (
    "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in _LI_REST) + ") = 1")
ORACLE["util_dedupe_last"] = (
    "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY "
    + ", ".join(f"{c} DESC NULLS LAST" for c in _LI_REST) + ") = 1")
ORACLE["util_dedupe_full_row"] = "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders"
ORACLE["util_surrogate_key"] = (
    f"SELECT l_orderkey, l_linenumber, {sk(['l_orderkey', 'l_linenumber'])} AS line_sk FROM lineitem")
ORACLE["util_version_columns"] = with_model(
    "SELECT customer_id, CAST(NULL AS TIMESTAMP) AS _end_date, TRUE AS _is_current, "
    "TRUE AS has_effective_date FROM dim_customers")

# ------------------------------------------------------------------ data quality
ORACLE["dq_not_null"] = with_model("\nUNION ALL\n".join(
    check_row(f"not_null:{c}", f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)", "orders_clean")
    for c in ("orderid", "customerid", "employeeid", "orderdate", "shippeddate")))
ORACLE["dq_type_valid"] = with_raw("\nUNION ALL\n".join(
    check_row(f"type_valid:{c}:{t}",
              f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t.upper()}) IS NULL)",
              "count(*)", "raw_products")
    for c, t in (("productID", "bigint"), ("unitPrice", "decimal(10,2)"), ("discontinued", "int"),
                 ("quantityPerUnit", "int"), ("productName", "int"))))
_RULES = [("unit_price_non_negative", "unitprice >= 0"), ("quantity_non_negative", "quantity >= 0"),
          ("discount_at_most_one", "discount <= 1.0")]
ORACLE["dq_business_rules"] = with_model("\nUNION ALL\n".join(
    check_row(n, f"count(*) FILTER (WHERE NOT coalesce({p}, FALSE))", "count(*)",
              "order_details_clean") for n, p in _RULES))
_LIMIT = "TIMESTAMP '2024-01-02 12:00:00' - INTERVAL 24 HOUR"
ORACLE["dq_freshness"] = with_model("\nUNION ALL\n".join([
    check_row("freshness:_loaded_at",
              f"CASE WHEN coalesce(max(TIMESTAMP '2024-01-02 00:00:00') >= {_LIMIT}, FALSE) THEN 0 ELSE 1 END",
              "1", "customers_clean"),
    check_row("freshness:ingestion_timestamp",
              f"CASE WHEN coalesce(max(TIMESTAMP '2024-01-01 00:00:00') >= {_LIMIT}, FALSE) THEN 0 ELSE 1 END",
              "1", "customers_clean"),
    check_row("row_count_positive", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END", "1",
              "customers_clean"),
]))
ORACLE["dq_row_count"] = with_model("\nUNION ALL\n".join(
    check_row("row_count_positive", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END", "1",
              f"{t}_clean", table=f"{t}_clean")
    for t in ("categories", "products", "customers", "employees", "orders", "order_details",
              "shippers")))


def _dup(table, keys, source):
    return check_row(f"unique_key:{keys}", "count(*) FILTER (WHERE n > 1)", "count(*)",
                     f"(SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys}) k", table=table)


ORACLE["dq_duplicate_keys"] = with_raw("\nUNION ALL\n".join([
    _dup("order_details_raw", "orderID,productID", "raw_order_details"),
    _dup("order_details_clean", "orderid,productid", "order_details_clean"),
    _dup("orders_clean", "orderid", "orders_clean"),
]))


def _fk(table, col, parent, pcol):
    src = (f"(SELECT c.{col}, p.{pcol} AS pk FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL) c "
           f"LEFT JOIN (SELECT DISTINCT {pcol} FROM {parent}) p ON c.{col} = p.{pcol}) j")
    return check_row(f"foreign_key:{col}", "count(*) FILTER (WHERE pk IS NULL)", "count(*)", src,
                     table=table)


ORACLE["dq_referential_integrity"] = with_model("\nUNION ALL\n".join([
    _fk("fact_sales", "customer_id", "dim_customers", "customer_id"),
    _fk("fact_sales", "product_id", "dim_products", "product_id"),
    _fk("fact_sales", "employee_id", "dim_employees", "employee_id"),
    _fk("fact_sales", "shipper_id", "dim_shippers", "shipper_id"),
    _fk("order_details_clean", "orderid", "orders_clean", "orderid"),
]))
_Q = [("freight_non_negative", "freight >= 0"), ("ordered_before_required", "orderdate <= requireddate"),
      ("shipped", "shippeddate IS NOT NULL")]
_QF = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT coalesce({p}, FALSE) THEN '{n}' END" for n, p in _Q) + ")"
ORACLE["dq_quarantine"] = with_model(
    f"SELECT orderid, {_QF} AS _dq_failures, {_QF} <> '' AS _quarantined FROM orders_clean")

# ------------------------------------------------------------------ history and CDC
from oracle.base import CLEAN, MODEL  # noqa: E402

_HIST = {
    "ev_pick": """
  SELECT user_id, ts, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
  FROM events GROUP BY user_id, ts""",
    "ev_hash": f"SELECT *, {hash_of(['event_type'])} AS _change_hash FROM ev_pick",
    "ev_changes": """
  SELECT * FROM ev_hash
  QUALIFY lag(_change_hash) OVER (PARTITION BY user_id ORDER BY ts) IS DISTINCT FROM _change_hash""",
    "ev_history": f"""
  SELECT user_id, event_type, event_id, _change_hash, ts AS _effective_date,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS _end_date,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS _is_current,
         {sk(['user_id', 'ts'])} AS version_sk
  FROM ev_changes""",
}


def _with_hist(sql: str, **extra: str) -> str:
    ctes = [f"{n} AS ({b}\n)" for n, b in {**_HIST, **extra}.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


ORACLE["scd2_history_events"] = _with_hist("SELECT * FROM ev_history")
ORACLE["scd2_apply_batch"] = ORACLE["scd2_history_events"]
ORACLE["scd2_apply_out_of_order"] = ORACLE["scd2_history_events"]
ORACLE["asof_dim_join"] = _with_hist("""
SELECT e.event_id, e.user_id, e.ts, e.value, h.version_sk AS v_version_sk,
       h.event_type AS v_event_type, h._effective_date AS v__effective_date,
       h._end_date AS v__end_date
FROM events e LEFT JOIN ev_history h
  ON e.user_id = h.user_id AND h._effective_date <= e.ts
 AND (h._end_date IS NULL OR e.ts < h._end_date)""")

_STATE_HASH = ("md5(concat_ws('|', coalesce(CAST(event_type AS VARCHAR), 'NULL_VALUE'), "
               "coalesce(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), 'NULL_VALUE')))")


def _state(where: str = "TRUE", deletes: bool = False) -> str:
    keep = "WHERE NOT coalesce(event_type = 'error', FALSE)" if deletes else ""
    return f"""
  SELECT *, {_STATE_HASH} AS _change_hash FROM (
    SELECT user_id, event_id, ts, event_type, value FROM events WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) s
  {keep}"""


ORACLE["cdc_apply_latest"] = (
    "WITH st AS (" + _state(deletes=True) + ")\n"
    "SELECT user_id, event_id, ts, event_type, value FROM st")
ORACLE["snapshot_diff"] = (
    "WITH old AS (" + _state("ts < TIMESTAMP '2024-01-16 00:00:00'") + "),\n"
    "new AS (" + _state(deletes=True) + ")\n" + """
SELECT coalesce(o.user_id, n.user_id) AS user_id,
       CASE WHEN o._change_hash IS NULL AND n._change_hash IS NOT NULL THEN 'insert'
            WHEN n._change_hash IS NULL AND o._change_hash IS NOT NULL THEN 'delete'
            WHEN o._change_hash = n._change_hash THEN 'unchanged' ELSE 'update' END AS change
FROM old o FULL OUTER JOIN new n ON o.user_id = n.user_id""")
ORACLE["cdc_soft_delete"] = (
    "WITH t AS (" + _state() + "),\nn AS (" + _state(deletes=True) + ")\n" + """
SELECT t.user_id, t.event_id, t.ts, t.event_type, t.value,
       NOT EXISTS (SELECT 1 FROM n WHERE n.user_id = t.user_id) AS _is_deleted
FROM t""")

_LAST_DETAILS = CLEAN["order_details_clean"].replace(
    "ORDER BY unitprice NULLS FIRST,\n          quantity NULLS FIRST, discount NULLS FIRST",
    "ORDER BY unitprice DESC NULLS LAST,\n          quantity DESC NULLS LAST, discount DESC NULLS LAST")
assert _LAST_DETAILS != CLEAN["order_details_clean"]
_FACT_LAST = MODEL["fact_sales"].replace("order_details_clean d", "order_details_last d")
ORACLE["cdc_upsert_fact"] = with_model("""
SELECT f.*, 'keep' AS _cdc_action FROM fact_sales f
WHERE NOT EXISTS (SELECT 1 FROM fact_last l WHERE l.orderid = f.orderid
                  AND l.product_id = f.product_id AND l._change_hash IS DISTINCT FROM f._change_hash)
UNION ALL
SELECT l.*, CASE WHEN EXISTS (SELECT 1 FROM fact_sales f WHERE l.orderid = f.orderid
                              AND l.product_id = f.product_id) THEN 'update' ELSE 'insert' END
FROM fact_last l
WHERE NOT EXISTS (SELECT 1 FROM fact_sales f WHERE l.orderid = f.orderid
                  AND l.product_id = f.product_id AND l._change_hash IS NOT DISTINCT FROM f._change_hash)""",
    order_details_last=_LAST_DETAILS, fact_last=_FACT_LAST)

# ------------------------------------------------------------------ streaming ingest
for _f in ("categories", "products", "customers", "employees", "orders", "order_details",
           "shippers"):
    ORACLE[f"bronze_{_f}"] = with_raw(
        f"SELECT * EXCLUDE (ingestion_timestamp) FROM raw_{_f}"
        if _f in ("products", "customers", "order_details") else f"SELECT * FROM raw_{_f}")
ORACLE["ingest_stream_csv"] = "SELECT * FROM events"
ORACLE["ingest_stream_incremental"] = "SELECT * FROM events"
ORACLE["ingest_stream_dedup"] = "SELECT * FROM events"
ORACLE["cdc_stream_apply"] = ORACLE["cdc_apply_latest"]

# ------------------------------------------------------------------ documented marts
ORACLE["gold_monthly_yoy"] = with_model(f"""
SELECT m.year_month, CAST(year(m.year_month) AS INT) AS year, CAST(month(m.year_month) AS INT) AS month,
       m.monthly_sales, p.monthly_sales AS prev_year_sales,
       {pct('m.monthly_sales - p.monthly_sales', 'p.monthly_sales', num_scale=2, den_scale=2)} AS yoy_sales_change,
       'gold_monthly_yoy' AS _source
FROM mm m LEFT JOIN mm p ON p.year_month = CAST(m.year_month - INTERVAL 12 MONTH AS DATE)""", mm=f"""
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS year_month,
         CAST(sum(line_total) AS {MONEY}) AS monthly_sales
  FROM fact_sales GROUP BY 1""")
_EMP_TOT = """
  SELECT employee_id, sum(ot) AS sales, sum(q) AS units, count(*) AS orders
  FROM (SELECT employee_id, orderid, sum(line_total) AS ot, sum(order_quantity) AS q
        FROM fact_sales GROUP BY employee_id, orderid) x GROUP BY employee_id"""
ORACLE["gold_team_summary"] = with_model(f"""
SELECT manager_name, count(*) AS team_members, count(t.sales) AS members_with_sales,
       coalesce(CAST(sum(t.sales) AS {MONEY}), CAST(0 AS {MONEY})) AS team_sales,
       coalesce(CAST(sum(t.orders) AS BIGINT), 0) AS team_orders,
       CAST(max(t.sales) AS DECIMAL(22,2)) AS top_member_sales,
       {mean('coalesce(sum(t.sales), 0)', 'count(*)')} AS avg_member_sales,
       'gold_team_summary' AS _source
FROM (SELECT employee_id, manager_name FROM dim_employees WHERE _is_current) e
LEFT JOIN et t USING (employee_id)
GROUP BY manager_name""", et=_EMP_TOT)
ORACLE["gold_territory_rollup"] = with_model(f"""
SELECT country, city, CAST(grouping(country, city) AS INT) AS grouping_level,
       CAST(sum(sales) AS {MONEY}) AS total_sales, CAST(sum(units) AS BIGINT) AS total_quantity,
       CAST(sum(orders) AS BIGINT) AS total_orders, count(*) AS employees,
       'gold_territory_rollup' AS _source
FROM et JOIN (SELECT employee_id, country, city FROM dim_employees WHERE _is_current) e
  USING (employee_id)
GROUP BY ROLLUP (country, city)""", et=_EMP_TOT)
_PERF = f"""
  SELECT d.product_id, d.product_name, d.category_name,
         CAST(sum(line_total) AS {MONEY}) AS total_sales
  FROM fact_sales f JOIN (SELECT * FROM dim_products WHERE _is_current) d
    ON f.product_id = d.product_id
  GROUP BY d.product_id, d.product_name, d.category_name"""
ORACLE["gold_category_top_bottom"] = with_model("""
SELECT category_name, product_id, product_name, total_sales, rank_in_category, position,
       'gold_category_top_bottom' AS _source
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category_name
              ORDER BY total_sales DESC NULLS LAST, product_id) AS INT) AS rank_in_category,
             'top' AS position FROM perf) t WHERE rank_in_category <= 5
UNION ALL
SELECT category_name, product_id, product_name, total_sales, rank_in_category, position,
       'gold_category_top_bottom' AS _source
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category_name
              ORDER BY total_sales ASC NULLS LAST, product_id) AS INT) AS rank_in_category,
             'bottom' AS position FROM perf) b WHERE rank_in_category <= 5""", perf=_PERF)
_AVG_C = ratio("(SELECT sum(total_sales) FROM bc)", "(SELECT count(*) FROM bc)", num_scale=2)
ORACLE["gold_country_comparison"] = with_model(f"""
SELECT country, total_sales,
       {pct('total_sales', '(SELECT sum(total_sales) FROM bc)', num_scale=2, den_scale=2)} AS share_of_total,
       {_AVG_C} AS mean_country_sales,
       CAST(total_sales - {_AVG_C} AS {MONEY}) AS diff_to_mean,
       'gold_country_comparison' AS _source
FROM bc""", bc=f"""
  SELECT country, CAST(sum(line_total) AS {MONEY}) AS total_sales
  FROM fact_sales JOIN (SELECT customer_id, country FROM dim_customers WHERE _is_current) c
    USING (customer_id) GROUP BY country""")
ORACLE["gold_order_frequency"] = with_model(f"""
SELECT customer_id, count(*) AS order_count, CAST(sum(ot) AS {MONEY}) AS total_sales,
       {mean('sum(ot)', 'count(ot)')} AS avg_order_value,
       min(d) AS first_order_date, max(d) AS last_order_date,
       CAST(datediff('day', min(d), max(d)) AS INT) AS active_days,
       'gold_order_frequency' AS _source
FROM (SELECT customer_id, orderid, sum(line_total) AS ot, min(order_date) AS d
      FROM fact_sales GROUP BY customer_id, orderid) o
GROUP BY customer_id""")
ORACLE["gold_orders_by_weekday"] = with_model(f"""
SELECT day_of_week, is_weekend, orders, total_sales,
       {pct('orders', '(SELECT sum(orders) FROM pd)')} AS share_of_orders,
       'gold_orders_by_weekday' AS _source
FROM pd""", pd=f"""
  SELECT day_of_week, is_weekend, count(*) AS orders, CAST(sum(ot) AS {MONEY}) AS total_sales
  FROM (SELECT orderid, order_date, sum(line_total) AS ot FROM fact_sales
        GROUP BY orderid, order_date) o
  JOIN dim_dates d ON d.full_date = o.order_date
  GROUP BY day_of_week, is_weekend""")
ORACLE["gold_product_net_revenue"] = with_model(f"""
SELECT *, CAST(rank() OVER (ORDER BY net_revenue DESC NULLS LAST) AS INT) AS net_rank,
       'gold_product_net_revenue' AS _source
FROM (SELECT d.product_id, d.product_name, d.category_name,
             CAST(sum(line_total) AS {MONEY}) AS gross_revenue,
             CAST(sum(discount_amount) AS {MONEY}) AS total_discount,
             CAST(sum(line_total - discount_amount) AS {MONEY}) AS net_revenue
      FROM fact_sales f JOIN (SELECT * FROM dim_products WHERE _is_current) d
        ON f.product_id = d.product_id
      GROUP BY d.product_id, d.product_name, d.category_name) p""")
ORACLE["dim_dates_calendar"] = with_model("""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date,
       CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
       CAST(month(d) AS INT) AS month, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
       CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday
FROM (SELECT CAST(unnest(generate_series(min(orderdate), max(orderdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders_clean) c""")
ORACLE["fact_sales_with_sks"] = with_model(f"""
SELECT *, {sk(['customer_id'])} AS dim_customer_sk, {sk(['employee_id'])} AS dim_employee_sk,
       {sk(['product_id'])} AS dim_product_sk, {sk(['shipper_id'])} AS dim_shipper_sk,
       CAST(strftime(order_date, '%Y%m%d') AS INT) AS order_date_key
FROM fact_sales""")
ORACLE["fact_partition_roundtrip"] = with_model("""
SELECT *, CAST(year(order_date) AS INT) AS order_year, CAST(month(order_date) AS INT) AS order_month
FROM fact_sales""")

ORACLE["dq_fact_build_checks"] = with_model("\nUNION ALL\n".join(
    [check_row(f"not_null:{c}", f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)", "fact_sales")
     for c in ("orderid", "customer_id", "product_id", "order_date")]
    + [check_row(n, f"count(*) FILTER (WHERE NOT coalesce({p}, FALSE))", "count(*)", "fact_sales")
       for n, p in (("unit_price_non_negative", "unit_price >= 0"),
                    ("quantity_non_negative", "order_quantity >= 0"),
                    ("discount_at_most_one", "discount_rate <= 1.0"))]
    + [check_row("row_count_positive", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END", "1", "fact_sales")]))


# ------------------------------------------------------------------ versioned model
def _history_of(name: str, key: str, feed: str, tracked: list[str]) -> dict[str, str]:
    """CTEs of the type-2 history of one change feed (key, tracked, changed_at, gone)."""
    h = hash_of(tracked)
    return {
        f"{name}_feed": feed,
        f"{name}_changes": f"""
  SELECT *, CASE WHEN gone THEN '__deleted__' ELSE {h} END AS _change_hash FROM {name}_feed
  QUALIFY lag(CASE WHEN gone THEN '__deleted__' ELSE {h} END) OVER (PARTITION BY {key} ORDER BY changed_at)
          IS DISTINCT FROM CASE WHEN gone THEN '__deleted__' ELSE {h} END""",
        f"{name}_history": f"""
  SELECT * EXCLUDE (gone, changed_at, nxt), changed_at AS _effective_date, nxt AS _end_date, nxt IS NULL AS _is_current,
         {sk([key, 'changed_at'])} AS version_sk
  FROM (SELECT *, lead(changed_at) OVER (PARTITION BY {key} ORDER BY changed_at) AS nxt FROM {name}_changes) WHERE NOT gone""",
    }


_T1, _T2, _T3 = (f"TIMESTAMP '{y}-01-01 00:00:00'" for y in (1996, 1998, 2000))
_CUSTOMERS = _history_of("cust", "customerid", f"""
  SELECT customerid, companyname, contacttitle, country, {_T1} AS changed_at, FALSE AS gone FROM customers_clean
  UNION ALL SELECT customerid, companyname, contacttitle || ' II', country, {_T2}, FALSE FROM customers_clean
            WHERE CAST(customerid AS BIGINT) % 3 = 0
  UNION ALL SELECT customerid, companyname, contacttitle, country, {_T3}, TRUE FROM customers_clean
            WHERE CAST(customerid AS BIGINT) % 11 = 0""", ["companyname", "contacttitle", "country"])
_PRODUCTS = _history_of("prod", "productid", f"""
  SELECT productid, productname, unitprice, discontinued, {_T1} AS changed_at, FALSE AS gone FROM products_clean
  UNION ALL SELECT productid, productname, CASE WHEN productid % 4 = 0 THEN CAST(unitprice + 10 AS DECIMAL(10,2)) ELSE unitprice END,
            discontinued, {_T2}, FALSE FROM products_clean WHERE productid % 2 = 0
  UNION ALL SELECT productid, productname, unitprice, discontinued, {_T3}, TRUE FROM products_clean WHERE productid % 13 = 0""",
                        ["productname", "unitprice", "discontinued"])
ORACLE["dim_customers_history"] = with_model(
    "SELECT * RENAME (customerid AS customer_id) FROM cust_history", **_CUSTOMERS)
ORACLE["dim_products_history"] = with_model(
    "SELECT * RENAME (productid AS product_id) FROM prod_history", **_PRODUCTS)
_EMP_TRACKED = ["employeename", "title", "city", "country", "reportsto"]
_EMPLOYEE_FEED = f"""
  SELECT employeeid, {', '.join(_EMP_TRACKED)}, {_T1} AS changed_at, FALSE AS gone FROM employees_clean
  UNION ALL SELECT employeeid, CASE WHEN employeeid % 3 = 0 THEN employeename || ' II' ELSE employeename END, title, city, country,
            CASE WHEN employeeid % 5 = 0 THEN 2 ELSE reportsto END, {_T2}, FALSE FROM employees_clean
            WHERE employeeid % 3 = 0 OR employeeid % 5 = 0
  UNION ALL SELECT employeeid, {', '.join(_EMP_TRACKED)}, {_T3}, TRUE FROM employees_clean WHERE employeeid % 11 = 0"""


def _with_names(own: str, key: str, link: str, names: str, names_key: str, name: str, out: str, fields: str) -> str:
    """Versions of `own` cut at every start and end of the linked name's versions."""
    return f"""
SELECT {fields}, n.{name} AS {out}, s.cut AS _effective_date, s.til AS _end_date, s.til IS NULL AS _is_current,
       md5(concat_ws('|', CAST(o.{key} AS VARCHAR), CAST(s.cut AS VARCHAR))) AS version_sk
FROM {own} o JOIN (
  SELECT {key}, since, cut, least(lead(cut) OVER (PARTITION BY {key}, since ORDER BY cut), _end_date) AS til, _end_date FROM (
    SELECT DISTINCT o.{key}, o._effective_date AS since, o._end_date, t.cut FROM {own} o JOIN (
      SELECT {key}, _effective_date AS cut, NULL AS link FROM {own}
      UNION SELECT NULL, _effective_date, {names_key} FROM {names}
      UNION SELECT NULL, _end_date, {names_key} FROM {names} WHERE _end_date IS NOT NULL) t
    ON (t.{key} = o.{key} OR t.link = o.{link}) AND t.cut >= o._effective_date AND (o._end_date IS NULL OR t.cut < o._end_date))) s
  ON s.{key} = o.{key} AND s.since = o._effective_date
LEFT JOIN {names} n ON n.{names_key} = o.{link} AND n._effective_date <= s.cut AND (n._end_date IS NULL OR s.cut < n._end_date)"""


ORACLE["dim_employees_history"] = with_model(
    _with_names("emp_history", "employeeid", "reportsto", "mgr_history", "employeeid", "employeename", "manager_name",
                "o.employeeid AS employee_id, o.employeename AS employee_name, o.title, o.city, o.country, o.reportsto AS reports_to_id"),
    **_history_of("emp", "employeeid", _EMPLOYEE_FEED, _EMP_TRACKED),
    **_history_of("mgr", "employeeid", _EMPLOYEE_FEED, ["employeename"]))
_PRODUCT_CATEGORY = _history_of("prod", "productid", _PRODUCTS["prod_feed"].replace("discontinued, ", "discontinued, categoryid, "),
                                ["productname", "unitprice", "discontinued", "categoryid"])
_CATEGORY = _history_of("cat", "categoryid", f"""
  SELECT categoryid, categoryname, {_T1} AS changed_at, FALSE AS gone FROM categories_clean
  UNION ALL SELECT categoryid, categoryname || ' II', {_T2}, FALSE FROM categories_clean WHERE categoryid % 2 = 0
  UNION ALL SELECT categoryid, categoryname, {_T3}, TRUE FROM categories_clean WHERE categoryid % 5 = 0""", ["categoryname"])
ORACLE["dim_products_category_history"] = with_model(
    _with_names("prod_history", "productid", "categoryid", "cat_history", "categoryid", "categoryname", "category_name",
                "o.productid AS product_id, o.productname, o.unitprice, o.discontinued, o.categoryid AS category_id"),
    **_PRODUCT_CATEGORY, **_CATEGORY)
ORACLE["fact_sales_versioned"] = with_model("""
SELECT f.orderid, f.product_id, f.customer_id, f.order_date, f.line_total,
       c.version_sk AS customer_version_sk, c.contacttitle AS customer_contacttitle,
       p.version_sk AS product_version_sk, p.unitprice AS product_unitprice
FROM fact_sales f
LEFT JOIN cust_history c ON c.customerid = f.customer_id AND c._effective_date <= f.order_date
     AND (c._end_date IS NULL OR f.order_date < c._end_date)
LEFT JOIN prod_history p ON p.productid = f.product_id AND p._effective_date <= f.order_date
     AND (p._end_date IS NULL OR f.order_date < p._end_date)""", **_CUSTOMERS, **_PRODUCTS)

# ------------------------------------------------------------------ changes in the stored fact
ORACLE["fact_upsert_stored"] = with_model("""
SELECT f.* FROM fact_sales f
WHERE NOT EXISTS (SELECT 1 FROM fact_last l WHERE l.orderid = f.orderid AND l.product_id = f.product_id)
UNION ALL SELECT l.* FROM fact_last l""", order_details_last=_LAST_DETAILS, fact_last=_FACT_LAST)
ORACLE["fact_upsert_by_feed"] = with_model(f"""
SELECT f.* REPLACE (
         CAST(CASE WHEN orderid % 50 = 1 THEN order_date + INTERVAL 1 MONTH ELSE order_date END AS DATE) AS order_date,
         CASE WHEN orderid % 50 = 2 THEN required_date ELSE shipped_date END AS shipped_date,
         orderid % 7 = 0 AND orderid % 50 NOT IN (1, 2) AND orderid % 35 <> 0 AS _is_deleted) FROM fact_sales f
UNION ALL
SELECT * REPLACE ({sk(['orderid', 'product_id'])} AS fact_sales_sk)
FROM (SELECT f.* REPLACE (product_id + 10000000 AS product_id) FROM fact_sales f WHERE orderid % 50 = 3) n""")
ORACLE["fact_soft_delete_stored"] = with_model("""
SELECT f.* REPLACE (f.orderid IN (SELECT o_orderkey FROM orders GROUP BY o_orderkey
                                  HAVING bool_and(o_orderstatus = 'P')) AS _is_deleted) FROM fact_sales f""")
ORACLE["cdc_delete_feed"] = (
    "WITH t AS (" + _state() + ")\n" + """
SELECT t.user_id, t.event_id, t.ts, t.event_type, t.value,
       EXISTS (SELECT 1 FROM events e WHERE e.user_id = t.user_id AND e.event_type = 'error') AS _is_deleted
FROM t""")
ORACLE["dq_quarantine_split"] = with_model(
    f"SELECT orderid, {_QF} AS _dq_failures, CASE WHEN {_QF} = '' THEN 'good' ELSE 'bad' END AS _part FROM orders_clean")
ORACLE["ingest_schema_evolution"] = (
    "SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN value END AS value) FROM events")
ORACLE["fact_saved_with_statistics"] = with_model("""
SELECT CAST(year(order_date) AS INT) AS order_year, count(*) AS lines, count(DISTINCT orderid) AS orders,
       CAST(sum(line_total) AS DECIMAL(28,2)) AS sales FROM fact_sales GROUP BY 1""")
ORACLE["layers_incremental"] = with_model("""
SELECT f.* REPLACE (orderid % 11 = 0 AS _is_deleted) FROM fact_sales f
WHERE orderid % 11 <> 0
   OR (orderid % 3 < 2 AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = f.orderid AND l.l_partkey = f.product_id
                                   AND CAST(l.l_quantity AS INT) % 3 < 2))""")
ORACLE["layers_incremental_history"] = ORACLE["dim_customers_history"]
_EXPECTED = [("no_error", "drop", "event_type <> 'error'"), ("value_at_least_ten", "drop", "value >= 10"),
             ("even_user", "warn", "user_id % 2 = 0")]
_BROKEN = [f"NOT coalesce({p}, FALSE)" for _, _, p in _EXPECTED]
_BROKEN_NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN {b} THEN '{n}' END" for (n, _, _), b in zip(_EXPECTED, _BROKEN)) + ")"
ORACLE["ingest_expectations"] = (
    f"SELECT *, {_BROKEN_NAMES} AS _dq_failures, CASE WHEN {_BROKEN[0]} OR {_BROKEN[1]} THEN 'rejected' ELSE 'good' END AS part FROM events")
ORACLE["ingest_expectation_metrics"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"check\", '{a}' AS action, count(*) FILTER (WHERE NOT coalesce({p}, FALSE)) AS failed, count(*) AS total FROM events"
    for n, a, p in [("has_id", "fail", "event_id IS NOT NULL"), *_EXPECTED])


def _attributed(name: str, key: str, dimension: str, tracked: list[str]) -> str:
    """Changes between adjacent versions of one history, a SELECT a column."""
    w = f"OVER (PARTITION BY {key} ORDER BY _effective_date)"
    return " UNION ALL ".join(f"""
SELECT '{dimension}' AS dimension, CAST({key} AS VARCHAR) AS key, _effective_date, '{c}' AS "column", old_value, new_value
FROM (SELECT {key}, _effective_date, lag(_end_date) {w} AS before, lag(CAST({c} AS VARCHAR)) {w} AS old_value,
             CAST({c} AS VARCHAR) AS new_value FROM {name}_history)
WHERE before = _effective_date AND old_value IS DISTINCT FROM new_value""" for c in tracked)


_CHANGES = (_attributed("cust", "customerid", "customers", ["companyname", "contacttitle", "country"])
            + " UNION ALL " + _attributed("prod", "productid", "products", ["productname", "unitprice", "discontinued"]))
ORACLE["dim_history_changes"] = with_model(_CHANGES, **_CUSTOMERS, **_PRODUCTS)
ORACLE["dim_history_change_counts"] = with_model(f"""
SELECT dimension, "column", count(*) AS changes, count(DISTINCT key) AS keys_changed FROM ({_CHANGES}) GROUP BY ALL""", **_CUSTOMERS, **_PRODUCTS)
ORACLE["dim_dates_holidays"] = f"""
SELECT * REPLACE (CASE WHEN strftime(full_date, '%m-%d') IN ('01-01', '12-25') THEN 1 ELSE 0 END AS is_holiday)
FROM ({ORACLE["dim_dates_calendar"]}) c"""
