"""Business marts over the sales fact.

Each mart has two readings:

* ``grain="line"``  the formulas as the source pipeline writes them: every
  "order" count and "order value" is per order *line*;
* ``grain="order"`` the documented meaning: the fact is first reduced to one
  row per (group, order), then orders and customers are counted distinct and
  order values are order totals.

Money stays decimal end to end; averages and percentages are exact
(``functions.exact``), rounded half away from zero.  Dimensions are joined
on their current rows only.  Joins are left to the planner: a dimension is
broadcast when its measured size is under the threshold, otherwise both
sides are shuffled and AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.exact import mean, pct, ratio
from strata.operators import columns as ops
from strata.operators.ranks import top_by, with_global_rank, with_rank_among
from strata.plans.dims import current_rows
from strata.session import materialize

MONEY = "decimal(28,2)"


def _money_sum(c) -> F.Column:
    return F.sum(c).cast(MONEY)


def _line_measures(fact: DataFrame, extra=()) -> DataFrame:
    keep = ["orderid", "customer_id", "employee_id", "product_id", "order_quantity",
            "discount_rate", "line_total", "discount_amount", "order_date", *extra]
    f = fact
    if "_is_deleted" in fact.columns:  # a flag never set counts as not deleted
        f = fact.where(F.col("_is_deleted").isNull() | (F.col("_is_deleted") == F.lit(False)))
    return f.select(*dict.fromkeys(keep))


def _per_order(df: DataFrame, keys) -> DataFrame:
    """One row per (keys, order): order total, units, any-discount flag."""
    return df.groupBy(*keys, "orderid").agg(
        F.sum("line_total").alias("_order_total"),
        F.sum("order_quantity").alias("_units"),
        F.max((F.col("discount_rate") > 0).cast("int")).alias("_disc"),
    )


def _order_partials(df: DataFrame, keys) -> DataFrame:
    """One row per (keys, order, customer) with every partial sum the
    order-grain marts add up, so each of them reads the fact once."""
    return df.groupBy(*keys, "orderid", "customer_id").agg(
        F.sum("line_total").alias("_ot"), F.sum("order_quantity").alias("_q"),
        F.sum("discount_rate").alias("_drs"), F.count("discount_rate").alias("_drn"),
        F.min("order_date").alias("_fd"), F.max("order_date").alias("_ld"))


def _partial_sums(total: str, quantity: str) -> list:
    return [_money_sum("_ot").alias(total), F.sum("_q").alias(quantity),
            F.sum("_drs").alias("_dr_sum"), F.sum("_drn").alias("_dr_n")]


def _join_groups(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Join two per-group aggregates on their group key, NULL group included
    (``GROUP BY`` keeps a NULL group; a plain equi-join would drop it)."""
    b2 = b.withColumnRenamed(key, "_gk")
    return a.join(b2, a[key].eqNullSafe(b2["_gk"])).drop("_gk")


def _stamp(df: DataFrame, name: str, as_of=None) -> DataFrame:
    return ops.add_audit_columns(df, source=name, as_of=as_of)


# --------------------------------------------------------------------- G1
def sales_by_country(fact: DataFrame, dim_customers: DataFrame, grain: str = "line",
                     as_of=None) -> DataFrame:
    cust = current_rows(dim_customers).select("customer_id", "country")
    f = _line_measures(fact)
    if grain == "line":
        df = f.join(cust, "customer_id").groupBy("country").agg(
            _money_sum("line_total").alias("total_sales"),
            F.sum("order_quantity").alias("total_quantity"),
            F.count("orderid").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            F.sum("line_total").alias("_lt_sum"),
            F.count("line_total").alias("_lt_n"),
            F.min("line_total").alias("min_order_value"),
            F.max("line_total").alias("max_order_value"),
            F.count_if(F.col("discount_rate") > 0).alias("orders_with_discount"),
        )
    else:
        orders = _per_order(f, ["customer_id"]).join(cust, "customer_id")
        df = orders.groupBy("country").agg(
            _money_sum("_order_total").alias("total_sales"),
            F.sum("_units").alias("total_quantity"),
            F.count(F.lit(1)).alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("_order_total").alias("_lt_sum"),
            F.count("_order_total").alias("_lt_n"),
            F.min("_order_total").cast("decimal(22,2)").alias("min_order_value"),
            F.max("_order_total").cast("decimal(22,2)").alias("max_order_value"),
            F.count_if(F.col("_disc") == 1).alias("orders_with_discount"),
        )
    df = df.select(
        "country", "total_sales", "total_quantity", "total_orders", "unique_customers",
        mean("_lt_sum", "_lt_n").alias("avg_order_value"),
        "min_order_value", "max_order_value", "orders_with_discount",
        pct("orders_with_discount", "total_orders").alias("discount_percentage"),
    )
    return _stamp(df, "gold_sales_by_country", as_of)


# --------------------------------------------------------------------- G2
def sales_by_category(fact: DataFrame, dim_products: DataFrame, grain: str = "line",
                      as_of=None) -> DataFrame:
    prod = current_rows(dim_products).select("product_id", "category_name", "discontinued")
    f = _line_measures(fact, extra=["unit_price"])
    if grain == "line":
        df = f.join(prod, "product_id").groupBy("category_name").agg(
            _money_sum("line_total").alias("total_sales"),
            F.sum("order_quantity").alias("total_quantity"),
            F.sum("unit_price").alias("_up_sum"), F.count("unit_price").alias("_up_n"),
            F.sum("discount_rate").alias("_dr_sum"), F.count("discount_rate").alias("_dr_n"),
            F.count("orderid").alias("total_orders"),
            F.count_if(F.col("discontinued") == 0).alias("active_products"),
            F.count_if(F.col("discontinued") == 1).alias("discontinued_products"),
        )
    else:
        # lines are reduced to (product, order) before the dimension is joined;
        # products sold are counted from their own narrow scan of the fact
        pairs = f.groupBy("product_id", "orderid").agg(
            F.sum("line_total").alias("_ot"), F.sum("order_quantity").alias("_q"),
            F.sum("unit_price").alias("_ups"), F.count("unit_price").alias("_upn"),
            F.sum("discount_rate").alias("_drs"), F.count("discount_rate").alias("_drn"))
        orders = pairs.join(prod, "product_id").groupBy("category_name", "orderid").agg(
            *[F.sum(c).alias(c) for c in ("_ot", "_q", "_ups", "_upn", "_drs", "_drn")])
        lines = orders.groupBy("category_name").agg(
            *_partial_sums("total_sales", "total_quantity"),
            F.sum("_ups").alias("_up_sum"), F.sum("_upn").alias("_up_n"),
            F.count(F.lit(1)).alias("total_orders"))
        prods = f.select("product_id").distinct().join(prod, "product_id").groupBy("category_name").agg(
            F.count_if(F.col("discontinued") == 0).alias("active_products"),
            F.count_if(F.col("discontinued") == 1).alias("discontinued_products"))
        df = _join_groups(lines, prods, "category_name")
    grand = F.sum("total_sales").over(Window.partitionBy())  # over one row per category
    df = df.select(
        "category_name", "total_sales", "total_quantity", "total_orders",
        "active_products", "discontinued_products",
        mean("_up_sum", "_up_n").alias("avg_unit_price"),
        mean("_dr_sum", "_dr_n", scale=4, total_scale=4).alias("avg_discount_rate"),
        pct(F.col("total_sales"), grand, num_scale=2, den_scale=2).alias("revenue_contribution"),
    )
    return _stamp(df, "gold_sales_by_category", as_of)


# --------------------------------------------------------------------- G3
EMPLOYEE_KEYS = ["employee_id", "employee_name", "title", "city", "country", "manager_name"]


def sales_by_employee(fact: DataFrame, dim_employees: DataFrame, grain: str = "line",
                      as_of=None) -> DataFrame:
    emp = current_rows(dim_employees).select(*EMPLOYEE_KEYS)
    f = _line_measures(fact)
    common = [
        _money_sum("line_total").alias("total_sales"),
        F.sum("order_quantity").alias("total_quantity"),
        F.sum("discount_rate").alias("_dr_sum"), F.count("discount_rate").alias("_dr_n"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    ]
    if grain == "line":
        per_emp = f.groupBy("employee_id").agg(
            *common,
            F.count("orderid").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            F.sum("line_total").alias("_v_sum"), F.count("line_total").alias("_v_n"))
    else:
        # an order has one employee: per-order partials, then per employee
        per_emp = _order_partials(f, ["employee_id"]).groupBy("employee_id").agg(
            *_partial_sums("total_sales", "total_quantity"),
            F.min("_fd").alias("first_order_date"), F.max("_ld").alias("last_order_date"),
            F.count(F.lit(1)).alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("_ot").alias("_v_sum"), F.count("_ot").alias("_v_n"))
    # one row per employee, written once: the rank, the count and the output
    # all read it instead of re-running the fact aggregation
    df = materialize(per_emp.join(emp, "employee_id"))
    n_emp = df.agg(F.count(F.lit(1))).scalar()
    df = with_global_rank(df, "total_sales", "sales_rank")
    df = df.select(
        *EMPLOYEE_KEYS, "total_sales", "total_quantity", "total_orders", "unique_customers",
        mean("_v_sum", "_v_n").alias("avg_order_value"),
        mean("_dr_sum", "_dr_n", scale=4, total_scale=4).alias("avg_discount_rate"),
        "first_order_date", "last_order_date", "sales_rank",
        pct(F.col("sales_rank") - 1, n_emp).alias("sales_percentile"),
    )
    return _stamp(df, "gold_sales_by_employee", as_of)


# --------------------------------------------------------------------- G4
PRODUCT_KEYS = ["product_id", "product_name", "category_name", "unit_price", "discontinued"]


def _product_aggregates(fact: DataFrame, grain: str) -> DataFrame:
    f = _line_measures(fact)
    common = [
        _money_sum("line_total").alias("total_sales"),
        F.sum("order_quantity").alias("total_quantity"),
        F.sum("discount_rate").alias("_dr_sum"), F.count("discount_rate").alias("_dr_n"),
        F.sum("line_total").alias("_v_sum"),
    ]
    if grain == "line":
        return f.groupBy("product_id").agg(
            *common, F.count("orderid").alias("order_count"),
            F.count("customer_id").alias("unique_customers"),
            F.count("line_total").alias("_v_n"))
    return _order_partials(f, ["product_id"]).groupBy("product_id").agg(
        *_partial_sums("total_sales", "total_quantity"),
        F.sum("_ot").alias("_v_sum"), F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count("_ot").alias("_v_n"))


def product_performance(fact: DataFrame, dim_products: DataFrame, grain: str = "line") -> DataFrame:
    """Per-product totals joined to the product dimension (dimension price).

    Line grain: products that sold (inner join).  Order grain: every
    current product, unsold ones with zero totals.
    """
    prod = current_rows(dim_products).select(*PRODUCT_KEYS)
    agg = _product_aggregates(fact, grain)
    if grain == "line":
        return agg.join(prod, "product_id")
    zero = {"total_sales": F.lit(0).cast(MONEY), "total_quantity": F.lit(0).cast("bigint"),
            "order_count": F.lit(0).cast("bigint"), "unique_customers": F.lit(0).cast("bigint"),
            "_v_n": F.lit(0).cast("bigint"), "_dr_n": F.lit(0).cast("bigint")}
    df = prod.join(agg, "product_id", "left")
    return df.withColumns({k: F.coalesce(F.col(k), v) for k, v in zero.items()})


def top_products(fact: DataFrame, dim_products: DataFrame, grain: str = "line", k: int = 50,
                 as_of=None) -> DataFrame:
    """Top ``k`` products by sales (ties kept), ranked three ways.

    ``rank_by_sales <= k`` is taken first (a per-partition limit); the
    quantity and popularity ranks are ranks over *all* products
    (``with_rank_among``), joined to the survivors by value.
    """
    # one row per product, written once and read by the three rankings
    perf = materialize(product_performance(fact, dim_products, grain))
    top = top_by(perf, "total_sales", k, out="rank_by_sales")
    df = with_rank_among(top, perf, "total_quantity", "rank_by_quantity")
    df = with_rank_among(df, perf, "unique_customers", "rank_by_popularity")
    status = (F.when(F.col("discontinued") == 1, F.lit("Discontinued"))
              .when(F.col("order_count") == 0, F.lit("No Sales"))
              .otherwise(F.lit("Active")))
    df = df.select(
        *PRODUCT_KEYS, "total_sales", "total_quantity", "order_count", "unique_customers",
        mean("_dr_sum", "_dr_n", scale=4, total_scale=4).alias("avg_discount_rate"),
        mean("_v_sum", "_v_n").alias("avg_order_value"),
        "rank_by_sales", "rank_by_quantity", "rank_by_popularity",
        status.alias("product_status"),
    )
    return _stamp(df, "gold_top_products", as_of)


# --------------------------------------------------------------------- G5
def kpis(fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame,
         dim_employees: DataFrame, grain: str = "line", as_of=None) -> DataFrame:
    f = _line_measures(fact)
    base = [
        _money_sum("line_total").alias("total_sales"),
        F.sum("order_quantity").alias("total_units_sold"),
        _money_sum(F.when(F.col("discount_rate") > 0, F.col("discount_amount"))
                   .otherwise(F.lit(0))).alias("total_discount_amount"),
        F.sum("discount_rate").alias("_dr_sum"), F.count("discount_rate").alias("_dr_n"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    ]
    if grain == "line":
        k = f.agg(*base,
                  F.count("orderid").alias("total_orders"),
                  F.count("customer_id").alias("unique_customers"),
                  F.count("product_id").alias("unique_products_sold"),
                  F.sum("line_total").alias("_v_sum"), F.count("line_total").alias("_v_n"))
    else:
        # one row per order carries every decomposable partial sum
        orders = f.groupBy("orderid", "customer_id").agg(
            F.sum("line_total").alias("_ot"), F.sum("order_quantity").alias("_q"),
            F.sum(F.when(F.col("discount_rate") > 0, F.col("discount_amount"))
                  .otherwise(F.lit(0))).alias("_da"),
            F.sum("discount_rate").alias("_drs"), F.count("discount_rate").alias("_drn"),
            F.min("order_date").alias("_fd"), F.max("order_date").alias("_ld"))
        n_products = (f.where(F.col("product_id").isNotNull()).select("product_id").distinct()
                      .agg(F.count(F.lit(1))).scalar())
        k = orders.agg(
            _money_sum("_ot").alias("total_sales"),
            F.sum("_q").alias("total_units_sold"),
            _money_sum("_da").alias("total_discount_amount"),
            F.sum("_drs").alias("_dr_sum"), F.sum("_drn").alias("_dr_n"),
            F.min("_fd").alias("first_order_date"), F.max("_ld").alias("last_order_date"),
            F.count(F.lit(1)).alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("_ot").alias("_v_sum"), F.count("_ot").alias("_v_n"),
        ).withColumn("unique_products_sold", n_products)

    def n_distinct(dim, key):
        d = current_rows(dim)
        return d.where(F.col(key).isNotNull()).select(key).distinct().agg(
            F.count(F.lit(1))).scalar()

    df = k.select(
        "total_sales", "total_orders", "unique_customers", "unique_products_sold",
        mean("_v_sum", "_v_n").alias("avg_order_value"),
        "total_units_sold", "total_discount_amount",
        mean("_dr_sum", "_dr_n", scale=4, total_scale=4).alias("avg_discount_rate"),
        n_distinct(dim_customers, "customer_id").alias("total_customers_in_database"),
        n_distinct(dim_products, "product_id").alias("total_products_in_database"),
        n_distinct(dim_employees, "employee_id").alias("total_employees"),
        "first_order_date", "last_order_date",
    )
    df = df.select(
        "*",
        pct("unique_customers", "total_customers_in_database").alias("customer_conversion_rate"),
        pct("total_discount_amount", "total_sales", num_scale=2, den_scale=2).alias("discount_impact"),
        ratio("total_units_sold", "total_orders", scale=2).alias("avg_order_size"),
        F.lit("executive_summary").alias("kpi_type"),
        ops._clock(as_of).alias("report_date"),
    )
    return _stamp(df, "gold_kpis", as_of)


# --------------------------------------------------------------------- G6
MOVING_FRAMES = {
    # calendar reading of "previous 3 months": this month and the two before
    "3m": "RANGE BETWEEN INTERVAL 2 MONTHS PRECEDING AND CURRENT ROW",
    # literal reading: 90 days back from the first day of the month
    "90d": "RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW",
}


def monthly_base(fact: DataFrame, grain: str = "line") -> DataFrame:
    f = _line_measures(fact).withColumn(
        "year_month", F.date_trunc("month", "order_date").cast("date"))
    common = [
        _money_sum("line_total").alias("monthly_sales"),
        F.sum("order_quantity").alias("monthly_quantity"),
        F.sum("discount_rate").alias("_dr_sum"), F.count("discount_rate").alias("_dr_n"),
    ]
    if grain == "line":
        m = f.groupBy("year_month").agg(
            *common, F.count("orderid").alias("monthly_orders"),
            F.count("customer_id").alias("monthly_customers"),
            F.sum("line_total").alias("_v_sum"), F.count("line_total").alias("_v_n"))
    else:
        m = _order_partials(f, ["year_month"]).groupBy("year_month").agg(
            *_partial_sums("monthly_sales", "monthly_quantity"),
            F.count(F.lit(1)).alias("monthly_orders"),
            F.count_distinct("customer_id").alias("monthly_customers"),
            F.sum("_ot").alias("_v_sum"), F.count("_ot").alias("_v_n"))
    return m.withColumns({"year": F.year("year_month"), "month": F.month("year_month")})


def monthly_trends(fact: DataFrame, grain: str = "line", frame: str = "3m",
                   as_of=None) -> DataFrame:
    """Monthly totals, moving average and month-over-month change.

    The windows run over one row per month (a small, time-bounded table).
    Line grain compares with the previous month *present* in the data;
    order grain with the previous calendar month (NULL when it is missing).
    """
    m = monthly_base(fact, grain)
    over = MOVING_FRAMES[frame]
    m = m.withColumns({
        "_ma_sum": F.expr(f"sum(monthly_sales) OVER (ORDER BY year_month {over})"),
        "_ma_n": F.expr(f"count(monthly_sales) OVER (ORDER BY year_month {over})"),
    })
    if grain == "line":
        m = m.withColumn("_prev", F.lag("monthly_sales").over(Window.orderBy("year_month")))
    else:
        by_month = Window.orderBy("year_month")
        is_next = F.lag("year_month").over(by_month) == F.add_months("year_month", -1)
        m = m.withColumn("_prev", F.when(is_next, F.lag("monthly_sales").over(by_month)))
    df = m.select(
        "year_month", "year", "month", "monthly_sales", "monthly_quantity", "monthly_orders",
        "monthly_customers",
        mean("_v_sum", "_v_n").alias("avg_order_value"),
        mean("_dr_sum", "_dr_n", scale=4, total_scale=4).alias("avg_discount_rate"),
        mean("_ma_sum", "_ma_n").alias("sales_3m_moving_avg"),
        pct(F.col("monthly_sales") - F.col("_prev"), F.col("_prev"),
            num_scale=2, den_scale=2).alias("mom_sales_change"),
    )
    return _stamp(df, "gold_monthly_trends", as_of)


# --------------------------------------------------------------------- G7
def monthly_yoy(fact: DataFrame, grain: str = "line", as_of=None) -> DataFrame:
    """Each month against the same calendar month one year earlier (NULL
    when that month has no sales): an equi join on ``add_months(ym, 12)``,
    safe with gaps in the months where ``lag(12)`` would not be."""
    m = monthly_base(fact, grain).select("year_month", "year", "month", "monthly_sales")
    prev = m.select(F.add_months("year_month", 12).alias("year_month"),
                    F.col("monthly_sales").alias("prev_year_sales"))
    df = m.join(prev, "year_month", "left").select(
        "year_month", "year", "month", "monthly_sales", "prev_year_sales",
        pct(F.col("monthly_sales") - F.col("prev_year_sales"), F.col("prev_year_sales"),
            num_scale=2, den_scale=2).alias("yoy_sales_change"))
    return _stamp(df, "gold_monthly_yoy", as_of)


# --------------------------------------------------------------------- G8
def _employee_totals(fact: DataFrame) -> DataFrame:
    """Per employee: sales, units, lines and distinct orders (an order has
    one employee, so per-employee distinct orders add up across teams)."""
    f = _line_measures(fact)
    per_order = f.groupBy("employee_id", "orderid").agg(
        F.sum("line_total").alias("_ot"), F.sum("order_quantity").alias("_q"))
    return per_order.groupBy("employee_id").agg(
        F.sum("_ot").alias("_sales"), F.sum("_q").alias("_units"),
        F.count(F.lit(1)).alias("_orders"))


def team_summary(fact: DataFrame, dim_employees: DataFrame, as_of=None) -> DataFrame:
    """Sales of each manager's team (direct reports); the top of the tree
    (no manager) is the group with a NULL manager."""
    emp = current_rows(dim_employees).select("employee_id", "manager_name")
    df = emp.join(_employee_totals(fact), "employee_id", "left").groupBy("manager_name").agg(
        F.count(F.lit(1)).alias("team_members"),
        F.count("_sales").alias("members_with_sales"),
        F.coalesce(_money_sum("_sales"), F.lit(0).cast(MONEY)).alias("team_sales"),
        F.coalesce(F.sum("_orders"), F.lit(0).cast("bigint")).alias("team_orders"),
        F.max("_sales").cast("decimal(22,2)").alias("top_member_sales"),
        F.sum("_sales").alias("_s"))
    df = df.select("manager_name", "team_members", "members_with_sales", "team_sales",
                   "team_orders", "top_member_sales",
                   mean(F.coalesce(F.col("_s"), F.lit(0)), "team_members").alias("avg_member_sales"))
    return _stamp(df, "gold_team_summary", as_of)


def territory_rollup(fact: DataFrame, dim_employees: DataFrame, as_of=None) -> DataFrame:
    """Sales by employee country and city with country subtotals and a grand
    total (``rollup``); ``grouping_level`` 0 = city, 1 = country, 3 = all."""
    emp = current_rows(dim_employees).select("employee_id", "country", "city")
    per_emp = _employee_totals(fact).join(emp, "employee_id")
    df = per_emp.rollup("country", "city").agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        _money_sum("_sales").alias("total_sales"),
        F.sum("_units").alias("total_quantity"),
        F.sum("_orders").alias("total_orders"),
        F.count(F.lit(1)).alias("employees"))
    return _stamp(df, "gold_territory_rollup", as_of)


# --------------------------------------------------------------------- G9
def category_top_bottom(fact: DataFrame, dim_products: DataFrame, n: int = 5,
                        as_of=None) -> DataFrame:
    """The ``n`` best and ``n`` worst selling products of every category
    (``row_number`` per category, ties broken by product id).  Each limit
    is a per-partition top-n before the shuffle (WindowGroupLimit), so a
    category with very many products never sorts in one task."""
    perf = product_performance(fact, dim_products, "line").select(
        "category_name", "product_id", "product_name", "total_sales")
    parts = []
    for position, order in (("top", F.col("total_sales").desc_nulls_last()),
                            ("bottom", F.col("total_sales").asc_nulls_last())):
        w = Window.partitionBy("category_name").orderBy(order, F.col("product_id").asc())
        parts.append(perf.withColumn("rank_in_category", F.row_number().over(w))
                     .where(F.col("rank_in_category") <= n)
                     .withColumn("position", F.lit(position)))
    return _stamp(parts[0].unionByName(parts[1]), "gold_category_top_bottom", as_of)


# --------------------------------------------------------------------- G10
def country_comparison(fact: DataFrame, dim_customers: DataFrame, as_of=None) -> DataFrame:
    """Each country's share of all sales and its distance to the mean
    country (grand total and country count are scalar subqueries)."""
    by_country = materialize(
        sales_by_country(fact, dim_customers, "line").select("country", "total_sales"))
    grand = by_country.agg(F.sum("total_sales")).scalar()
    n = by_country.agg(F.count(F.lit(1))).scalar()
    avg_country = ratio(grand, n, scale=2, num_scale=2)
    df = by_country.select(
        "country", "total_sales",
        pct(F.col("total_sales"), grand, num_scale=2, den_scale=2).alias("share_of_total"),
        avg_country.alias("mean_country_sales"),
        (F.col("total_sales") - avg_country).cast(MONEY).alias("diff_to_mean"))
    return _stamp(df, "gold_country_comparison", as_of)


# --------------------------------------------------------------------- G11
def order_frequency(fact: DataFrame, as_of=None) -> DataFrame:
    """Orders per customer: count, value and first/last order date."""
    f = _line_measures(fact)
    orders = f.groupBy("customer_id", "orderid").agg(
        F.sum("line_total").alias("_ot"), F.min("order_date").alias("_d"))
    df = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        _money_sum("_ot").alias("total_sales"),
        F.sum("_ot").alias("_s"), F.count("_ot").alias("_n"),
        F.min("_d").alias("first_order_date"), F.max("_d").alias("last_order_date"))
    df = df.select("customer_id", "order_count", "total_sales",
                   mean("_s", "_n").alias("avg_order_value"),
                   "first_order_date", "last_order_date",
                   F.datediff("last_order_date", "first_order_date").alias("active_days"))
    return _stamp(df, "gold_order_frequency", as_of)


def orders_by_weekday(fact: DataFrame, dim_dates: DataFrame, as_of=None) -> DataFrame:
    """Orders and sales per day of week (joined to the date dimension)."""
    f = _line_measures(fact)
    orders = f.groupBy("orderid", "order_date").agg(F.sum("line_total").alias("_ot"))
    dates = dim_dates.select(F.col("full_date").alias("order_date"), "day_of_week", "is_weekend")
    per_day = orders.join(dates, "order_date").groupBy("day_of_week", "is_weekend").agg(
        F.count(F.lit(1)).alias("orders"), _money_sum("_ot").alias("total_sales"))
    total = per_day.agg(F.sum("orders")).scalar()
    df = per_day.select("day_of_week", "is_weekend", "orders", "total_sales",
                        pct(F.col("orders"), total).alias("share_of_orders"))
    return _stamp(df, "gold_orders_by_weekday", as_of)


# --------------------------------------------------------------------- G12
def product_net_revenue(fact: DataFrame, dim_products: DataFrame, as_of=None) -> DataFrame:
    """Net revenue (line totals less discounts; no cost column exists) per
    product, ranked over all products without a one-partition sort."""
    prod = current_rows(dim_products).select("product_id", "product_name", "category_name")
    f = _line_measures(fact)
    agg = f.groupBy("product_id").agg(
        _money_sum("line_total").alias("gross_revenue"),
        _money_sum("discount_amount").alias("total_discount"),
        _money_sum(F.col("line_total") - F.col("discount_amount")).alias("net_revenue"))
    df = with_global_rank(materialize(agg.join(prod, "product_id")), "net_revenue", "net_rank")
    df = df.select("product_id", "product_name", "category_name", "gross_revenue",
                   "total_discount", "net_revenue", "net_rank")
    return _stamp(df, "gold_product_net_revenue", as_of)
