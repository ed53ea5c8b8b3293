import pytest
from pyspark.errors import StreamingQueryException

from strata.plans.versioned import BucketStore
from strata.session import scratch_path
from strata.streaming import expectations as expect
from strata.streaming import ingest
from strata.streaming.expectations import Expectation

SCHEMA = "k long, v long"
RULES = [Expectation("has_key", "k IS NOT NULL", "fail"), Expectation("positive", "v > 0", "drop"),
         Expectation("small", "v < 100", "warn")]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _drop(spark, src, data):
    ingest.write_csv_files(spark.createDataFrame(data, SCHEMA), src)


def test_policies_and_replay(spark):
    target = scratch_path(spark, "checked")
    batch = spark.createDataFrame([(1, 5), (2, -5), (3, 500), (4, None), (1, 5)], SCHEMA)
    for _ in range(2):      # the same batch again is skipped
        expect.apply_batch(batch, 0, target, RULES)
    expect.apply_batch(spark.createDataFrame([(9, 0)], SCHEMA), 1, target, RULES)
    assert _rows(expect.read_good(spark, target)) == [(1, 5, ""), (1, 5, ""), (3, 500, "small")]
    rejected = expect.read_rejected(spark, target)
    assert sorted((r.k, r._dq_failures) for r in rejected.collect()) == [(2, "positive"), (4, "positive,small"), (9, "positive")]
    assert _rows(expect.read_metrics(spark, target).select("_batch", "check", "failed", "total")) == [
        (0, "has_key", 0, 5), (0, "positive", 2, 5), (0, "small", 2, 5),
        (1, "has_key", 0, 1), (1, "positive", 1, 1), (1, "small", 0, 1)]
    assert all(int(f.split("_bucket=")[1].split("/")[0]) % 2 == 0 for f in expect.read_good(spark, target).inputFiles())


def test_a_failing_batch_leaves_nothing_and_comes_again(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("src", "checked", "ckpt"))
    run = lambda rules: ingest.run_to_end(expect.write_checked(
        ingest.csv_stream(spark, src, SCHEMA), target, ckpt, rules))
    _drop(spark, src, [(1, 1)])
    run(RULES)
    _drop(spark, src, [(None, 2), (3, 3)])
    with pytest.raises(StreamingQueryException, match="1 rows break has_key"):
        run(RULES)
    assert _rows(expect.read_good(spark, target)) == [(1, 1, "")]
    run([Expectation("has_key", "k IS NOT NULL", "drop"), *RULES[1:]])
    assert _rows(expect.read_good(spark, target)) == [(1, 1, ""), (3, 3, "")]
    assert _rows(expect.read_rejected(spark, target)) == [(None, 2, "has_key")]


def test_a_batch_stopped_before_its_commit_is_not_seen(spark, monkeypatch):
    target = scratch_path(spark, "checked")
    batch = spark.createDataFrame([(1, 5), (2, -5)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(BucketStore, "_mark", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            expect.apply_batch(batch, 0, target, RULES)
    assert expect.read_good(spark, target) is None and expect.read_metrics(spark, target) is None
    expect.apply_batch(batch, 0, target, RULES)
    assert expect.read_good(spark, target).count() == 1


def test_no_rules_empty_batch_and_bad_rules(spark):
    target = scratch_path(spark, "checked")
    expect.apply_batch(spark.createDataFrame([], SCHEMA), 0, target, RULES)
    assert expect.read_good(spark, target).count() == 0
    expect.apply_batch(spark.createDataFrame([(1, -1)], SCHEMA), 1, target, [])
    assert _rows(expect.read_good(spark, target)) == [(1, -1, "")]
    with pytest.raises(ValueError):
        Expectation("x", "v > 0", "ignore")
    with pytest.raises(ValueError):
        expect.apply_batch(spark.createDataFrame([], SCHEMA), 2, target, [RULES[0], RULES[0]])
