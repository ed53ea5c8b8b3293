"""Expectations on the way in: rules with a policy, applied to a stream.

Each rule has an action for rows that break it:

* ``warn``: the row is stored and carries the rule's name;
* ``drop``: the row is stored with the rejected rows, with the names of all
  rules it broke;
* ``fail``: nothing of the batch is stored and the stream stops with
  ``ExpectationFailed``.  The batch comes again when the stream is started with
  other rules or after its files were mended.

Good rows, rejected rows and the batch's counts per rule appear in one commit
(``plans.versioned``), whose batch id lets a replayed batch be skipped: each
row is stored once, and the counts always are those of the rows stored.  They
are taken from the batch as checkpointed, not from accumulators, so a lost
executor counts no row twice.

A batch is a pair of folders (good, rejected), so readers of good rows never
list or scan rejected ones.  A rule whose predicate is NULL is broken.  The
store belongs to one stream checkpoint: with another one batch ids begin anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans.versioned import BUCKET, BucketStore
from strata.session import materialize

WARN, DROP, FAIL = "warn", "drop", "fail"
ROWS, METRICS = "rows", "metrics"
FAILURES, BATCH, REJECTED = "_dq_failures", "_batch", "_rejected"


class ExpectationFailed(RuntimeError):
    """Rows of a batch break a rule whose action is to fail."""


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: Column | str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r} of expectation {self.name!r}")
        if "," in self.name:
            raise ValueError(f"the name of expectation {self.name!r} must have no comma")

    @property
    def check(self) -> quality.Check:
        return quality.rule(self.name, self.predicate)


def _store(spark: SparkSession, target: str) -> BucketStore:
    return BucketStore(spark, target, [], buckets={
        ROWS: F.col(BATCH) * 2 + F.col(REJECTED).cast("int"), METRICS: F.col(BATCH)})


def apply_batch(batch: DataFrame, batch_id: int, target: str, expectations: Sequence[Expectation]) -> None:
    """Check a batch and commit it, unless the store has seen its id."""
    names = [e.name for e in expectations]
    if len(set(names)) < len(names):
        raise ValueError(f"expectations need names of their own: {names}")
    store = _store(batch.sparkSession, target)
    if store.has_applied(batch_id):
        return
    checks = [e.check for e in expectations]
    dropping = [e.name for e in expectations if e.action == DROP]
    broken = F.split(FAILURES, ",")
    flagged = quality.flag_rows(batch, checks)
    flagged = materialize(flagged.withColumns({
        BATCH: F.lit(batch_id).cast("long"),
        REJECTED: F.arrays_overlap(broken, F.array(*map(F.lit, dropping))) if dropping else F.lit(False)}))
    counts = [F.count_if(F.array_contains(broken, n)).alias(f"_f{i}") for i, n in enumerate(names)]
    totals = flagged.agg(F.count(F.lit(1)).alias("_total"), *counts).first()
    fatal = [(e.name, totals[f"_f{i}"]) for i, e in enumerate(expectations) if e.action == FAIL and totals[f"_f{i}"]]
    if fatal:
        raise ExpectationFailed(f"batch {batch_id}: " + ", ".join(f"{n} rows break {name}" for name, n in fatal))
    metrics = batch.sparkSession.createDataFrame(
        [(batch_id, e.name, e.action, totals[f"_f{i}"], totals["_total"]) for i, e in enumerate(expectations)],
        f"{BATCH} long, check string, action string, failed long, total long")
    store.commit({ROWS: flagged, METRICS: metrics}, {ROWS: [2 * batch_id, 2 * batch_id + 1], METRICS: [batch_id]}, batch_id)


def write_checked(stream: DataFrame, target: str, checkpoint: str, expectations: Sequence[Expectation],
                  available_now: bool = True):
    """Start the checked ingest of a stream; returns the query."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, target, expectations)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _rows(spark: SparkSession, target: str, rejected: int) -> DataFrame | None:
    store = _store(spark, target)
    held = (store.manifest() or {"tables": {}})["tables"].get(ROWS, {})
    df = store.read(ROWS, [int(b) for b in held if int(b) % 2 == rejected])
    return df.drop(BUCKET, BATCH, REJECTED) if df is not None else None


def read_good(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows that were let in, with the rules they broke (``warn``) in
    ``_dq_failures``; None before the first batch."""
    return _rows(spark, target, 0)


def read_rejected(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows that were kept out, with the rules they broke."""
    return _rows(spark, target, 1)


def read_metrics(spark: SparkSession, target: str) -> DataFrame | None:
    """Failed and total rows of each batch and rule."""
    df = _store(spark, target).read(METRICS)
    return df.drop(BUCKET) if df is not None else None
