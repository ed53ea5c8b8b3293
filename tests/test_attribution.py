import datetime as dt

from strata.operators import attribution, history

T = [dt.datetime(2020, 1, d) for d in range(1, 9)]
FEED = "k string, ts timestamp, a string, b long, _is_delete boolean"


def _changes(spark, feed):
    h = history.scd2_from_log(spark.createDataFrame(feed, FEED), ["k"], "ts", ["a", "b"])
    return attribution.version_changes(h, ["k"], ["a", "b"])


def test_changed_columns_with_nulls_and_gaps(spark):
    got = _changes(spark, [
        ("x", T[0], "one", 1, False), ("x", T[1], "two", None, False), ("x", T[2], "two", None, False),
        ("x", T[3], "two", 5, False), ("x", T[4], None, None, True), ("x", T[5], "six", 6, False),
        (None, T[0], "n", 1, False), (None, T[1], "m", 1, False), ("y", T[0], "only", 1, False)])
    rows = sorted(((r.k, r._effective_date.day, r.column, r.old_value, r.new_value) for r in got.collect()), key=repr)
    # nothing is told of the first version or of the one after the delete
    assert rows == sorted([("x", 2, "a", "one", "two"), ("x", 2, "b", "1", None), ("x", 4, "b", None, "5"),
                           (None, 2, "a", "n", "m")], key=repr)
    counts = {r.column: (r.changes, r.keys_changed) for r in attribution.changes_by_column(got, ["k"]).collect()}
    assert counts == {"a": (2, 2), "b": (2, 1)}


def test_one_hot_key_and_an_empty_history(spark):
    feed = [("hot", dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i), f"v{i}", i // 10, False) for i in range(500)]
    counts = {r.column: r.changes for r in attribution.changes_by_column(_changes(spark, feed), ["k"]).collect()}
    assert counts == {"a": 499, "b": 49}
    assert _changes(spark, []).count() == 0
