import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans.versioned import BucketStore
from strata.session import scratch_path
from strata.streaming import changes, ingest

SCHEMA = "k long, ts timestamp_ntz, v string"
D = dt.datetime


def _drop(spark, path, data):
    df = spark.createDataFrame(data, SCHEMA).withColumn("day", F.to_date("ts"))
    ingest.write_csv_files(df, path, split_by="day")


def test_incremental_ingest_picks_only_new_files(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("src", "tgt", "ckpt"))
    _drop(spark, src, [(1, D(2024, 1, 1, 1), " a "), (2, D(2024, 1, 1, 2), None)])
    run = lambda: ingest.run_to_end(ingest.write_incremental(
        ingest.stamp(ingest.csv_stream(spark, src, SCHEMA)), target, ckpt))
    run()
    assert ingest.read_table(spark, target).count() == 2
    run()                                   # nothing new: nothing appended
    assert ingest.read_table(spark, target).count() == 2
    _drop(spark, src, [(3, D(2024, 1, 2, 1), "c")])
    run()
    got = ingest.read_table(spark, target)
    assert got.count() == 3
    assert {r["v"] for r in got.collect()} == {" a ", None, "c"}   # text kept as written


def test_stream_apply_is_idempotent_and_keeps_tombstones(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("src", "state", "ckpt"))
    _drop(spark, src, [(1, D(2024, 1, 1), "a"), (1, D(2024, 1, 3), "DEL"), (2, D(2024, 1, 1), "x")])
    go = lambda: ingest.run_to_end(changes.apply_stream(
        ingest.csv_stream(spark, src, SCHEMA, max_files_per_trigger=1), target, ckpt,
        ["k"], "ts", delete_when="v = 'DEL'"))
    go()
    first = sorted(tuple(r) for r in changes.read_state(spark, target).collect())
    go()                                    # replay with the same checkpoint: no change
    assert sorted(tuple(r) for r in changes.read_state(spark, target).collect()) == first
    # a late, older event for the deleted key must not bring it back
    _drop(spark, src, [(1, D(2024, 1, 2), "late")])
    go()
    assert sorted(r["k"] for r in changes.read_state(spark, target).collect()) == [2]


def test_merge_rewrites_and_reads_only_touched_buckets(spark):
    target = scratch_path(spark, "state")
    first = spark.createDataFrame([(k, D(2024, 1, 1), "a") for k in range(40)], SCHEMA)
    changes.merge_batch(first, target, ["k"], "ts", n_buckets=8)
    store = lambda: BucketStore(spark, target, ["k"])
    before = store().manifest()["tables"]["state"]
    one = spark.createDataFrame([(3, D(2024, 1, 2), "b")], SCHEMA)
    touched = store().touched(one)
    files = store().read("state", touched).inputFiles()
    assert len(touched) == 1 and all(f"_bucket={touched[0]}/" in f for f in files)
    changes.merge_batch(one, target, ["k"], "ts", n_buckets=5)    # the stored number of buckets counts
    changes.merge_batch(one, target, ["k"], "ts")                 # replay: same state
    assert store().n_buckets == 8
    after = store().manifest()["tables"]["state"]
    assert [b for b in before if before[b] != after[b]] == [str(touched[0])]
    state = {r["k"]: r["v"] for r in changes.read_state(spark, target).collect()}
    assert len(state) == 40 and state[3] == "b" and state[4] == "a"


def test_failure_before_the_manifest_leaves_the_old_state(spark, monkeypatch):
    target = scratch_path(spark, "state")
    changes.merge_batch(spark.createDataFrame([(k, D(2024, 1, 1), "a") for k in range(9)], SCHEMA),
                        target, ["k"], "ts", n_buckets=2, batch_id=0)
    new = spark.createDataFrame([(k, D(2024, 1, 2), "b") for k in range(4)], SCHEMA)
    state = lambda: sorted((r["k"], r["v"]) for r in changes.read_state(spark, target).collect())
    old = state()

    def stop(self, manifest, done):
        raise OSError("stopped before the manifest")

    with monkeypatch.context() as m:
        m.setattr(BucketStore, "_mark", stop)
        with pytest.raises(OSError):
            changes.merge_batch(new, target, ["k"], "ts", batch_id=1)
    assert state() == old
    for _ in range(2):                                            # applied, then skipped by its id
        changes.merge_batch(new, target, ["k"], "ts", batch_id=1)
    assert state() == [(k, "b" if k < 4 else "a") for k in range(9)]
    store = BucketStore(spark, target, ["k"])
    assert len(store.vacuum(keep=1)) >= 1
    assert state() == [(k, "b" if k < 4 else "a") for k in range(9)]


def test_stream_events_are_logged(spark):
    import time

    from strata.streaming import progress
    src, target, ckpt = (scratch_path(spark, n) for n in ("src", "tgt", "ckpt"))
    _drop(spark, src, [(1, D(2024, 1, 1, 1), "a"), (2, D(2024, 1, 2, 2), "b")])
    log = progress.attach(spark)
    try:
        ingest.run_to_end(ingest.write_incremental(
            ingest.stamp(ingest.csv_stream(spark, src, SCHEMA)), target, ckpt))
        for _ in range(50):                      # listener events arrive asynchronously
            if any(e["event_type"] == "END" for e in log.events()):
                break
            time.sleep(0.1)
        kinds = [e["event_type"] for e in log.events()]
        assert kinds[0] == "START" and "END" in kinds
        assert sum(e.get("input_rows") or 0 for e in log.events()) == 2
    finally:
        progress.detach(spark, log)


def test_dedup_over_runs_drops_repeats_and_bounds_its_state(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("src", "tgt", "ckpt"))
    day = lambda n: D(2024, 1, 1) + dt.timedelta(days=n)
    sent, state = [], []
    for run in range(6):
        new = [(100 * run + k, day(30 * run + k), "a") for k in range(20)]
        # the last delivery again, a key of long ago, and the same row twice
        _drop(spark, src, new + sent[-20:] + sent[:3] + new[:2])
        sent += new
        query = ingest.write_incremental(ingest.deduplicated(ingest.csv_stream(spark, src, SCHEMA), ["k"], "ts", "40 days"), target, ckpt)
        ingest.run_to_end(query)
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r["k"], r["ts"]) for r in ingest.read_table(spark, target).collect())
    assert got == [(k, t) for k, t, _ in sent]
    assert max(state) <= 80 < len(sent)                              # about two delays of keys
    # a new row behind the watermark is lost, as documented
    _drop(spark, src, [(9999, day(1), "late"), (9998, day(175), "new")])
    ingest.run_to_end(ingest.write_incremental(ingest.deduplicated(ingest.csv_stream(spark, src, SCHEMA), ["k"], "ts", "40 days"), target, ckpt))
    assert {r["k"] for r in ingest.read_table(spark, target).collect()} - {k for k, _, _ in sent} == {9998}
