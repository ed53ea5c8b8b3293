import datetime as dt
from decimal import Decimal

from strata.plans import marts
from tests.conftest import rows

FACT = ("orderid long, customer_id string, employee_id long, product_id long, "
        "order_quantity int, unit_price decimal(10,2), discount_rate decimal(5,4), "
        "line_total decimal(12,2), discount_amount decimal(12,2), order_date date, "
        "_is_deleted boolean")


def _fact(spark, data):
    return spark.createDataFrame(data, FACT)


def _line(o, c, p, total, rate="0", day=dt.date(2024, 1, 5), q=1):
    return (o, c, 1, p, q, Decimal(total), Decimal(rate), Decimal(total),
            (Decimal(total) * Decimal(rate)).quantize(Decimal("0.01")), day, False)


def _customers(spark, data):
    return spark.createDataFrame([(c, n, True) for c, n in data],
                                 "customer_id string, country string, _is_current boolean")


def test_country_without_discounts_counts_zero(spark):
    f = _fact(spark, [_line(1, "a", 1, "10.00"), _line(2, "b", 1, "5.00", "0.1")])
    c = _customers(spark, [("a", "X"), ("b", "Y")])
    out = {r["country"]: r for r in marts.sales_by_country(f, c).collect()}
    assert out["X"]["orders_with_discount"] == 0 and out["X"]["discount_percentage"] == Decimal("0.00")
    assert out["Y"]["discount_percentage"] == Decimal("100.00")


def test_history_rows_do_not_fan_out(spark):
    f = _fact(spark, [_line(1, "a", 1, "10.00")])
    c = spark.createDataFrame([("a", "old", False), ("a", "X", True)],
                              "customer_id string, country string, _is_current boolean")
    assert rows(marts.sales_by_country(f, c), "country", "total_orders") == [("X", 1)]


def test_order_grain_counts_orders_not_lines(spark):
    f = _fact(spark, [_line(1, "a", 1, "10.00"), _line(1, "a", 2, "20.00"),
                      _line(2, "a", 1, "5.00")])
    c = _customers(spark, [("a", "X")])
    line = marts.sales_by_country(f, c, "line").first()
    order = marts.sales_by_country(f, c, "order").first()
    assert (line["total_orders"], order["total_orders"]) == (3, 2)
    assert order["avg_order_value"] == Decimal("17.50") and order["unique_customers"] == 1


def test_monthly_trends_gap_and_zero(spark):
    f = _fact(spark, [_line(1, "a", 1, "10.00", day=dt.date(2024, 1, 5)),
                      _line(2, "a", 1, "20.00", day=dt.date(2024, 3, 5)),
                      _line(3, "a", 1, "0.00", day=dt.date(2024, 4, 5)),
                      _line(4, "a", 1, "7.00", day=dt.date(2024, 5, 5))])
    line = {r["month"]: r["mom_sales_change"] for r in marts.monthly_trends(f, "line").collect()}
    order = {r["month"]: r["mom_sales_change"] for r in marts.monthly_trends(f, "order").collect()}
    assert line[3] == Decimal("100.00")      # against the previous month present (January)
    assert order[3] is None                  # February is missing in the calendar reading
    assert line[5] is None                   # previous month sold 0: ratio undefined


def test_top_products_tie_at_the_cut(spark):
    f = _fact(spark, [_line(i, "a", i, "10.00") for i in range(1, 4)])
    p = spark.createDataFrame([(i, f"p{i}", "cat", Decimal("1.00"), 0, True) for i in range(1, 5)],
                              "product_id long, product_name string, category_name string, "
                              "unit_price decimal(10,2), discontinued int, _is_current boolean")
    top = marts.top_products(f, p, k=1)
    assert top.count() == 3 and {r["rank_by_sales"] for r in top.collect()} == {1}
    og = {r["product_id"]: r["product_status"]
          for r in marts.top_products(f, p, "order", k=10).collect()}
    assert og[4] == "No Sales" and og[1] == "Active"


def test_calendar_flags_holidays_and_weekends(spark):
    from strata.plans.dims import dim_dates_calendar
    orders = spark.createDataFrame([(dt.date(2024, 12, 23),), (dt.date(2024, 12, 27),)], "orderdate date")
    hol = spark.createDataFrame([(dt.date(2024, 12, 25),)], "holiday_date date")
    cal = {r["full_date"]: (r["is_holiday"], r["is_weekend"], r["day_of_week"])
           for r in dim_dates_calendar(orders, hol).collect()}
    assert len(cal) == 5
    assert cal[dt.date(2024, 12, 25)][0] == 1 and cal[dt.date(2024, 12, 24)][0] == 0
    assert cal[dt.date(2024, 12, 23)][2] == 2          # Monday (Sunday = 1)


def test_manager_lookup_keeps_the_root(spark):
    from strata.plans.dims import dim_employees
    emp = spark.createDataFrame(
        [(1, "Boss", "CEO", "c", "x", -1, None, "s", None, "h1"),
         (2, "Ann", "Rep", "c", "x", 1, None, "s", None, "h2")],
        "employeeid long, employeename string, title string, city string, country string, "
        "reportsto long, _loaded_at timestamp, _source string, _processing_timestamp timestamp, "
        "_change_hash string")
    got = rows(dim_employees(emp), "employee_id", "reports_to_id", "manager_name")
    assert got == [(1, -1, None), (2, 1, "Boss")]
