"""DuckDB SQL building blocks of the oracle.

An independent formulation of the model in plain SQL over the driver's views
(``part``, ``orders``, ...): clean tables, dimensions, fact.  Queries are
``WITH <ctes> SELECT ...``; DuckDB inlines the CTEs a query does not use.
"""

from __future__ import annotations


def ratio(num: str, den: str, scale: int = 2, factor: int = 1, num_scale: int = 0,
          den_scale: int = 0, precision: int = 18) -> str:
    """round(num/den*factor, scale), half away from zero, exact (HUGEINT)."""
    n = f"(CAST(({num}) * {10 ** num_scale} AS HUGEINT) * {factor * 10 ** (den_scale + scale)})"
    d = f"(CAST(({den}) * {10 ** den_scale} AS HUGEINT) * {10 ** num_scale})"
    q = f"((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{q} ELSE {q} END)"
    step = f"0.{'0' * (scale - 1)}1" if scale else "1"
    return (f"(CASE WHEN {d} <> 0 THEN CAST(CAST({signed} AS DECIMAL({precision},0)) * {step}"
            f" AS DECIMAL({precision},{scale})) END)")


def pct(num: str, den: str, scale: int = 2, num_scale: int = 0, den_scale: int = 0) -> str:
    return ratio(num, den, scale=scale, factor=100, num_scale=num_scale, den_scale=den_scale)


def mean(total: str, count: str, scale: int = 2, total_scale: int = 2) -> str:
    return ratio(total, count, scale=scale, num_scale=total_scale)


def hash_of(cols, marker: str = "NULL_VALUE") -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{marker}')" for c in cols)
    return f"md5(concat_ws('|', {parts}))"


def sk(cols) -> str:
    return hash_of(cols, "NULL")


MONEY = "DECIMAL(28,2)"

CATEGORY_CASE = ("CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 "
                 "WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END")

CLEAN = {
    "categories_clean": f"""
  SELECT *, 'northwind_categories' AS _source,
         {hash_of(['categoryid', 'categoryname', 'description'])} AS _change_hash
  FROM (SELECT DISTINCT CAST({CATEGORY_CASE} AS INT) AS categoryid, trim(p_type) AS categoryname,
               'N/A' AS description FROM part) c
  QUALIFY row_number() OVER (PARTITION BY categoryid
          ORDER BY categoryname NULLS FIRST, description NULLS FIRST) = 1""",
    "products_clean": f"""
  SELECT *, 'northwind_products' AS _source,
         {hash_of(['productid', 'productname', 'categoryid', 'unitprice', 'discontinued'])} AS _change_hash
  FROM (SELECT CAST(p_partkey AS BIGINT) AS productid, trim(p_name) AS productname,
               coalesce(trim(CAST(p_size AS VARCHAR)), 'Unknown') AS quantityperunit,
               coalesce(CAST(p_retailprice AS DECIMAL(10,2)), 0) AS unitprice,
               CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS discontinued,
               CAST({CATEGORY_CASE} AS INT) AS categoryid
        FROM part) p
  QUALIFY row_number() OVER (PARTITION BY productid ORDER BY productname NULLS FIRST,
          quantityperunit NULLS FIRST, unitprice NULLS FIRST, discontinued NULLS FIRST,
          categoryid NULLS FIRST) = 1""",
    "customers_clean": f"""
  SELECT *, 'northwind_customers' AS _source,
         {hash_of(['customerid', 'companyname', 'contactname', 'city', 'country'])} AS _change_hash
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS customerid, trim(c_name) AS companyname,
               coalesce(CASE WHEN c_custkey % 7 = 0 THEN NULL
                             ELSE trim(' Contact ' || CAST(c_custkey AS VARCHAR) || ' ') END,
                        'Unknown') AS contactname,
               coalesce(trim(c_mktsegment), 'Unknown') AS contacttitle,
               coalesce(trim(r_name), 'Unknown') AS city,
               coalesce(trim(n_name), 'Unknown') AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey) c
  QUALIFY row_number() OVER (PARTITION BY customerid ORDER BY companyname NULLS FIRST,
          contactname NULLS FIRST, contacttitle NULLS FIRST, city NULLS FIRST,
          country NULLS FIRST) = 1""",
    "employees_clean": f"""
  SELECT *, 'northwind_employees' AS _source,
         {hash_of(['employeeid', 'employeename', 'title', 'city', 'country'])} AS _change_hash
  FROM (SELECT CAST(s_suppkey AS BIGINT) AS employeeid, trim(s_name) AS employeename,
               coalesce(CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 5000
                             THEN 'Representative' ELSE 'Manager' END, 'Unknown') AS title,
               coalesce(trim(r_name), 'Unknown') AS city,
               coalesce(trim(n_name), 'Unknown') AS country,
               coalesce(CASE WHEN s_suppkey = 0 THEN NULL
                             ELSE CAST(floor(s_suppkey / 10) AS BIGINT) END, -1) AS reportsto
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey) e
  QUALIFY row_number() OVER (PARTITION BY employeeid ORDER BY employeename NULLS FIRST,
          title NULLS FIRST, city NULLS FIRST, country NULLS FIRST, reportsto NULLS FIRST) = 1""",
    "orders_clean": f"""
  SELECT *, 'northwind_orders' AS _source,
         {hash_of(['orderid', 'customerid', 'employeeid', 'orderdate', 'freight'])} AS _change_hash
  FROM (SELECT CAST(o_orderkey AS BIGINT) AS orderid, CAST(o_custkey AS VARCHAR) AS customerid,
               CAST(o_custkey % (SELECT count(*) FROM supplier) AS BIGINT) AS employeeid,
               CAST(o_orderdate AS DATE) AS orderdate,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS requireddate,
               CASE WHEN o_orderstatus = 'F'
                    THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 7 DAY AS DATE) END AS shippeddate,
               CAST(left(o_orderpriority, 1) AS INT) AS shipperid,
               coalesce(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
                             AS DECIMAL(10,2)), 0) AS freight
        FROM orders) o
  QUALIFY row_number() OVER (PARTITION BY orderid ORDER BY customerid NULLS FIRST,
          employeeid NULLS FIRST, orderdate NULLS FIRST, requireddate NULLS FIRST,
          shippeddate NULLS FIRST, shipperid NULLS FIRST, freight NULLS FIRST) = 1""",
    "order_details_clean": f"""
  SELECT orderid, productid, unitprice, quantity, discount,
         CAST(quantity * unitprice AS DECIMAL(12,2)) AS line_total,
         CAST(CAST(quantity * unitprice AS DECIMAL(12,2)) * discount AS DECIMAL(12,2)) AS discount_amount,
         'northwind_order_details' AS _source,
         {hash_of(['orderid', 'productid', 'quantity', 'unitprice', 'discount'])} AS _change_hash
  FROM (SELECT CAST(l_orderkey AS BIGINT) AS orderid, CAST(l_partkey AS BIGINT) AS productid,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS unitprice,
               coalesce(CAST(trunc(l_quantity) AS INT), 0) AS quantity,
               coalesce(CAST(l_discount AS DECIMAL(5,4)), 0) AS discount
        FROM lineitem) d
  QUALIFY row_number() OVER (PARTITION BY orderid, productid ORDER BY unitprice NULLS FIRST,
          quantity NULLS FIRST, discount NULLS FIRST) = 1""",
    "shippers_clean": f"""
  SELECT *, 'northwind_shippers' AS _source,
         {hash_of(['shipperid', 'companyname'])} AS _change_hash
  FROM (SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INT) AS shipperid,
               coalesce(trim(substring(o_orderpriority, 3)), 'Unknown') AS companyname
        FROM orders) s
  QUALIFY row_number() OVER (PARTITION BY shipperid ORDER BY companyname NULLS FIRST) = 1""",
}

AUDIT = "_source, _change_hash"

MODEL = {
    "dim_customers": f"""
  SELECT {sk(['customerid'])} AS dim_customer_sk, customerid AS customer_id, companyname,
         contactname, contacttitle, city, country, {AUDIT},
         CAST(NULL AS TIMESTAMP) AS _end_date, TRUE AS _is_current
  FROM customers_clean""",
    "dim_products": f"""
  SELECT {sk(['p.productid'])} AS dim_product_sk, p.productid AS product_id,
         p.productname AS product_name, p.categoryid AS category_id,
         c.categoryname AS category_name, p.unitprice AS unit_price,
         p.quantityperunit AS quantity_per_unit, p.discontinued, p._source, p._change_hash,
         CAST(NULL AS TIMESTAMP) AS _end_date, TRUE AS _is_current
  FROM products_clean p LEFT JOIN categories_clean c ON p.categoryid = c.categoryid""",
    "dim_employees": f"""
  SELECT {sk(['e.employeeid'])} AS dim_employee_sk, e.employeeid AS employee_id,
         e.employeename AS employee_name, e.title, e.city, e.country,
         e.reportsto AS reports_to_id, m.employeename AS manager_name, e._source, e._change_hash,
         CAST(NULL AS TIMESTAMP) AS _end_date, TRUE AS _is_current
  FROM employees_clean e LEFT JOIN employees_clean m ON e.reportsto = m.employeeid""",
    "dim_shippers": f"""
  SELECT {sk(['shipperid'])} AS dim_shipper_sk, shipperid AS shipper_id,
         companyname AS shipper_name, {AUDIT}
  FROM shippers_clean""",
    "dim_dates": """
  SELECT CAST(strftime(orderdate, '%Y%m%d') AS INT) AS date_key, orderdate AS full_date,
         CAST(year(orderdate) AS INT) AS year, CAST(quarter(orderdate) AS INT) AS quarter,
         CAST(month(orderdate) AS INT) AS month, CAST(dayofweek(orderdate) + 1 AS INT) AS day_of_week,
         CASE WHEN dayofweek(orderdate) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         0 AS is_holiday
  FROM (SELECT DISTINCT orderdate FROM orders_clean WHERE orderdate IS NOT NULL) d""",
    "fact_sales": f"""
  SELECT {sk(['d.orderid', 'd.productid'])} AS fact_sales_sk, d.orderid,
         o.customerid AS customer_id, o.employeeid AS employee_id, d.productid AS product_id,
         o.shipperid AS shipper_id, d.quantity AS order_quantity, d.unitprice AS unit_price,
         d.discount AS discount_rate, d.line_total, d.discount_amount,
         o.orderdate AS order_date, o.requireddate AS required_date,
         o.shippeddate AS shipped_date, o.freight, d._source, d._change_hash,
         FALSE AS _is_deleted
  FROM order_details_clean d JOIN orders_clean o ON d.orderid = o.orderid""",
}


def with_model(select_sql: str, **extra: str) -> str:
    """Prefix a query with every clean/model CTE (plus ``extra`` ones, in
    keyword order, after the model)."""
    ctes = [f"{name} AS ({body}\n)" for name, body in {**CLEAN, **MODEL, **extra}.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + select_sql


RAW = {
    "raw_customers": """
  SELECT CAST(c_custkey AS VARCHAR) AS customerID, c_name AS companyName,
         CASE WHEN c_custkey % 7 = 0 THEN NULL
              ELSE ' Contact ' || CAST(c_custkey AS VARCHAR) || ' ' END AS contactName,
         c_mktsegment AS contactTitle, r_name AS city, n_name AS country,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
    "raw_order_details": """
  SELECT CAST(l_orderkey AS VARCHAR) AS orderID, CAST(l_partkey AS VARCHAR) AS productID,
         CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS unitPrice,
         CAST(CAST(trunc(l_quantity) AS INT) AS VARCHAR) AS quantity,
         CAST(CAST(l_discount AS DECIMAL(5,4)) AS VARCHAR) AS discount,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM lineitem""",
    "raw_products": f"""
  SELECT CAST(p_partkey AS VARCHAR) AS productID, p_name AS productName,
         CAST(p_size AS VARCHAR) AS quantityPerUnit,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS unitPrice,
         CASE WHEN p_partkey % 10 = 0 THEN '1' ELSE '0' END AS discontinued,
         CAST({CATEGORY_CASE} AS VARCHAR) AS categoryID,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM part""",
}


RAW.update({
    "raw_categories": f"""
  SELECT DISTINCT CAST({CATEGORY_CASE} AS VARCHAR) AS categoryID, p_type AS categoryName,
         CAST(NULL AS VARCHAR) AS description
  FROM part""",
    "raw_employees": """
  SELECT CAST(s_suppkey AS VARCHAR) AS employeeID, s_name AS employeeName,
         CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 5000 THEN 'Representative'
              ELSE 'Manager' END AS title,
         r_name AS city, n_name AS country,
         CASE WHEN s_suppkey = 0 THEN NULL
              ELSE CAST(CAST(floor(s_suppkey / 10) AS BIGINT) AS VARCHAR) END AS reportsTo
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
    "raw_orders": """
  SELECT CAST(o_orderkey AS VARCHAR) AS orderID, CAST(o_custkey AS VARCHAR) AS customerID,
         CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS employeeID,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS orderDate,
         CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS VARCHAR) AS requiredDate,
         CASE WHEN o_orderstatus = 'F'
              THEN CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 7 DAY AS DATE) AS VARCHAR)
         END AS shippedDate,
         left(o_orderpriority, 1) AS shipperID,
         CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
              AS DECIMAL(10,2)) AS VARCHAR) AS freight
  FROM orders""",
    "raw_shippers": """
  SELECT DISTINCT left(o_orderpriority, 1) AS shipperID,
         substring(o_orderpriority, 3) AS companyName
  FROM orders""",
})


def with_raw(select_sql: str, **extra: str) -> str:
    return with_model(select_sql, **RAW, **extra)


def check_row(name: str, failed: str, total: str, source: str, table: str | None = None) -> str:
    t = f"'{table}' AS \"table\", " if table else ""
    return (f"SELECT {t}'{name}' AS \"check\", CAST({failed} AS BIGINT) AS failed, "
            f"CAST({total} AS BIGINT) AS total, ({failed}) = 0 AS passed FROM {source}")
