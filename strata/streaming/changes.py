"""Streaming change application: each micro-batch is merged into a state
table of key-hash buckets (``plans.versioned``).

``foreachBatch`` receives (batch DataFrame, batch id).  For each batch:

1. the batch is kept for the two passes over it;
2. the buckets its keys fall in are read off it: at most ``n_buckets`` small
   numbers, and only those buckets' folders of the state are scanned;
3. the new rows per key are "latest change wins" over old + new (the same
   aggregate as ``cdc.apply_changes``, combined map-side);
4. the touched buckets are written as new files, and a manifest with the
   batch id last.

The cost of a batch grows with the buckets it touches, not with the whole
state.  A batch that failed before its manifest left nothing a reader sees,
and is applied again; one that failed after it is skipped by its id.

Deletes are kept as tombstones in the state (so a late, older event cannot
resurrect a deleted key) and filtered out on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.versioned import BucketStore, CommitConflict

STATE = "state"
#: Times that a batch is merged again when another writer was faster.
ATTEMPTS = 3


def read_state(spark: SparkSession, target: str, include_tombstones: bool = False):
    df = BucketStore(spark, target, []).read(STATE)
    if df is None or include_tombstones:
        return df
    return df.where(~F.col("_deleted")).drop("_deleted")


def merge_latest(state: DataFrame | None, batch: DataFrame, keys: Sequence[str], seq: str,
                 tiebreak: str | None, delete_when) -> DataFrame:
    keys = list(keys)
    cond = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    incoming = batch.withColumn(
        "_deleted", F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(False))
    allrows = incoming if state is None else state.unionByName(incoming)
    payload = [c for c in allrows.columns if c not in keys]
    first = [seq] + ([tiebreak] if tiebreak else [])
    fields = first + [c for c in payload if c not in first]
    latest = allrows.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_w"))
    return latest.select(*keys, *[F.col("_w")[c].alias(c) for c in payload])


def merge_batch(batch: DataFrame, target: str, keys: Sequence[str], seq: str,
                tiebreak: str | None = None, delete_when=None, n_buckets: int = 16,
                batch_id: int | None = None) -> None:
    """Merge one batch of changes into the bucketed state at ``target``."""
    batch = batch.persist()
    try:
        for attempt in range(ATTEMPTS):
            # after a conflict the store is read anew
            store = BucketStore(batch.sparkSession, target, keys, n_buckets)
            if batch_id is not None and store.has_applied(batch_id):
                return
            touched = store.touched(batch)
            if not touched:
                return
            state = store.read(STATE, touched)
            try:
                store.commit({STATE: merge_latest(state, batch, keys, seq, tiebreak, delete_when)}, touched, batch_id)
                return
            except CommitConflict:
                if attempt == ATTEMPTS - 1:
                    raise
    finally:
        batch.unpersist()


def apply_stream(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], seq: str,
                 tiebreak: str | None = None, delete_when=None, n_buckets: int = 16,
                 available_now: bool = True):
    """Start the streaming merge; returns the query."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, target, keys, seq, tiebreak, delete_when, n_buckets, batch_id)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
