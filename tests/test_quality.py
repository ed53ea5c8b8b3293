import datetime as dt

from strata.operators import quality as dq


def _result(df):
    return {r["check"]: (r["failed"], r["total"], r["passed"]) for r in df.collect()}


def test_row_checks_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 0.1), (None, -1.0, 0.0), (3, 2.0, 1.5), (4, None, 0.2)],
        "id int, price double, discount double")
    out = _result(dq.evaluate(df, [
        dq.not_null("id"),
        dq.rule("price_non_negative", "price >= 0"),   # NULL price counts as failed
        dq.rule("discount_at_most_one", "discount <= 1.0"),
        dq.row_count(),
    ]))
    assert out["not_null:id"] == (1, 4, False)
    assert out["price_non_negative"] == (2, 4, False)
    assert out["discount_at_most_one"] == (1, 4, False)
    assert out["row_count_positive"] == (0, 1, True)


def test_empty_table_fails_row_count_and_freshness(spark):
    df = spark.createDataFrame([], "id int, ts timestamp")
    out = _result(dq.evaluate(df, [dq.row_count(), dq.freshness("ts", "2024-01-02 00:00:00")]))
    assert out["row_count_positive"][2] is False and out["freshness:ts"][2] is False


def test_freshness_window(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "ts timestamp")
    fresh = _result(dq.evaluate(df, [dq.freshness("ts", "2024-01-02 06:00:00")]))
    stale = _result(dq.evaluate(df, [dq.freshness("ts", "2024-01-03 06:00:00")]))
    assert fresh["freshness:ts"][2] is True and stale["freshness:ts"][2] is False


def test_type_valid(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], ["q"])
    assert _result(dq.evaluate(df, [dq.type_valid("q", "int")]))["type_valid:q:int"][0] == 2


def test_duplicate_keys_and_orphans(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    out = _result(dq.evaluate(child, [dq.unique_key(["id"]),
                                      dq.foreign_key(["fk"], parent, ["pk"])]))
    assert out["unique_key:id"] == (1, 3, False)
    assert out["foreign_key:fk"] == (1, 3, False)   # NULL fk references nothing


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, q int")
    good, bad = dq.quarantine(df, [dq.rule("q_non_negative", "q >= 0")])
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3]
    assert {r["_dq_failures"] for r in bad.collect()} == {"q_non_negative"}


def test_observed_checks_match_evaluate(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (3, None)], "id int, price double")
    checks = [dq.not_null("id"), dq.rule("price_ok", "price >= 0"), dq.row_count()]
    observed, obs = dq.observe(df, checks)
    observed.write.format("noop").mode("overwrite").save()
    got = {c: (f, t, p) for c, f, t, p in dq.observed_results(obs, checks)}
    assert got == _result(dq.evaluate(df, checks))
