"""Type-2 history: build it from a change log, apply batches, look it up as-of.

Versions are half-open intervals ``[_effective_date, _end_date)``; the open
version has ``_end_date`` NULL and ``_is_current`` true.  ``version_sk`` is
the md5 of (key, effective time) next to the key-only surrogate key.

All steps are keyed DataFrame operations: the per-(key, time) pick is an
aggregate, neighbours come from ``operators.sequence`` (range-sliced, so a
key with a huge history is spread over many tasks), the as-of lookup is a
union + forward fill instead of a key-only join that would pair every
version with every fact row of that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing
from strata.operators import cdc
from strata.operators import sequence as seqops
from strata.plans.versioned import BucketStore
from strata.session import materialize

DELETED = "__deleted__"


def _latest_per_instant(log: DataFrame, keys, seq, tracked, tiebreak, extra=()) -> DataFrame:
    """One row per (key, seq): the one with the largest tiebreak."""
    payload = ([tiebreak] if tiebreak else []) + [*tracked, *extra]
    # the largest (tiebreak, tracked...) wins: a total order, so the pick does
    # not depend on input order; an aggregate, so it combines map-side
    picked = log.groupBy(*keys, seq).agg(F.max(F.struct(*payload)).alias("_p"))
    return picked.select(*keys, seq, *[F.col("_p")[c].alias(c) for c in payload])


def scd2_from_log(log: DataFrame, keys: Sequence[str], seq: str, tracked: Sequence[str],
                  tiebreak: str | None = None, delete_when: Column | str | None = None,
                  end_inclusive: str | None = None) -> DataFrame:
    """Full type-2 history of ``keys`` from an ordered change log.

    1. one row per (key, seq), the largest ``tiebreak`` wins;
    2. change hash over ``tracked``; a row matching ``delete_when`` is a
       delete (hash of a fixed marker);
    3. rows equal to their predecessor are dropped (no change);
    4. ``_end_date`` = next change's time; deletes close a version and are
       not versions themselves;
    5. ``version_sk`` = md5(key | effective time).

    ``end_inclusive="day"`` reports closed ends as the previous day
    (inclusive-day convention) instead of the half-open end.
    """
    keys, tracked = list(keys), list(tracked)
    df = event_log(log, keys, seq, tracked, tiebreak, delete_when)
    df = _latest_per_instant(df, keys, seq, tracked, tiebreak, extra=["_is_delete"])
    df = df.withColumn("_change_hash", F.when(F.col("_is_delete"), F.lit(DELETED))
                       .otherwise(hashing.change_hash(tracked)))

    with_prev = seqops.previous_values(df, keys, [seq], ["_change_hash"], keep_slice=True)
    prev = F.col("_prev__change_hash")
    changes = with_prev.where(prev.isNull() | (prev != F.col("_change_hash")))
    # a leading delete (nothing to close) is not a change either
    changes = changes.where(~(F.col("_is_delete") & prev.isNull())).drop("_prev__change_hash")

    # the change rows feed two consumers (local lead and slice summaries):
    # write them once; they keep their slices, so no second range sampling
    changes = materialize(changes)
    with_next = seqops.next_values(changes, keys, [seq], [seq], presliced=True)
    versions = with_next.where(~F.col("_is_delete"))
    end = F.col(f"_next_{seq}")
    if end_inclusive == "day":
        end = F.date_sub(end.cast("date"), 1).cast("timestamp")
    out_cols = [*keys, *tracked] + ([tiebreak] if tiebreak else [])
    return versions.select(
        *out_cols, "_change_hash",
        F.col(seq).alias("_effective_date"),
        end.alias("_end_date"),
        F.col(f"_next_{seq}").isNull().alias("_is_current"),
        hashing.surrogate_key([*keys, seq]).alias("version_sk"),
    )


def event_log(batch: DataFrame, keys: Sequence[str], seq: str, tracked: Sequence[str],
              tiebreak: str | None = None, delete_when: Column | str | None = None) -> DataFrame:
    """A batch as change events: keys, seq, tracked, tiebreak, ``_is_delete``."""
    marked = (F.coalesce(F.col("_is_delete"), F.lit(False)) if "_is_delete" in batch.columns
              else F.lit(False))
    if delete_when is not None:
        cond = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        marked = marked | F.coalesce(cond, F.lit(False))
    carried = [*keys, seq, *tracked] + ([tiebreak] if tiebreak else [])
    return batch.withColumn("_is_delete", marked).select(*dict.fromkeys(carried), "_is_delete")


def scd2_apply(log: DataFrame | None, batch: DataFrame, keys: Sequence[str], seq: str,
               tracked: Sequence[str], tiebreak: str | None = None,
               delete_when: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(log, history) of the batch's keys after a batch of changes.

    A stored history alone cannot take late events: it has forgotten the
    events that changed nothing, and a late event may turn one of them into a
    change (A@1, A@3, then B@2 makes A@3 a version).  So the store keeps the
    applied events too, one per (key, seq), and the touched keys' history is
    rebuilt from them.  Which event stays at one (key, seq) does not depend
    on the order of arrival, so batches may come in any order and more than
    once: the history equals ``scd2_from_log`` over all events.

    ``log`` are the stored events of the batch's keys (rows of other keys are
    passed through and rebuilt as well).
    """
    keys, tracked = list(keys), list(tracked)
    events = event_log(batch, keys, seq, tracked, tiebreak, delete_when)
    merged = events if log is None else log.unionByName(events)
    # Written once: the log keeps it and the history is built from it.
    merged = materialize(_latest_per_instant(merged, keys, seq, tracked, tiebreak, extra=["_is_delete"]))
    return merged, scd2_from_log(merged, keys, seq, tracked, tiebreak)


LOG, HISTORY = "log", "history"


def apply_to_table(spark, target: str, batch: DataFrame, keys: Sequence[str], seq: str,
                   tracked: Sequence[str], tiebreak: str | None = None,
                   delete_when: Column | str | None = None, n_buckets: int = 16,
                   batch_id: int | None = None) -> None:
    """``scd2_apply`` against a stored log and history.

    Only the buckets of the batch's keys are read and written; both tables
    change in one commit (``plans.versioned``).  Applying a batch again is
    harmless.
    """
    store = BucketStore(spark, target, keys, n_buckets)
    if batch_id is not None and store.has_applied(batch_id):
        return
    batch = materialize(batch, spark)
    touched = store.touched(batch)
    if not touched:
        if batch_id is not None:
            store.commit({}, touched, batch_id)
        return
    log, history = scd2_apply(store.read(LOG, touched), batch, keys, seq, tracked, tiebreak, delete_when)
    store.commit({LOG: log, HISTORY: history}, touched, batch_id)


def read_history(spark, target: str, keys: Sequence[str]) -> DataFrame | None:
    """The stored history, or None before the first batch."""
    return BucketStore(spark, target, keys).read(HISTORY)


#: Versions of a key, at most, that its facts are joined with all at once.
FEW_VERSIONS = 64


def asof_join(facts: DataFrame, history: DataFrame, keys: Sequence[str], at: str,
              version_cols: Sequence[str], prefix: str = "") -> DataFrame:
    """Each fact row with the version of its key valid at ``facts[at]``.

    Valid = ``_effective_date <= at < _end_date`` (open end = NULL).  Facts
    and version starts are merged into one stream ordered by (key, time,
    version before fact) and the latest version start is carried forward
    to the facts (``sequence.fill_forward``): linear in rows, no pairs.
    Where no key has more than `FEW_VERSIONS` versions (one small aggregate
    tells), a key's versions are one sorted array instead, and the facts are
    shuffled once and copied nowhere.
    """
    keys = list(keys)
    vcols = list(version_cols) + ["_effective_date", "_end_date"]
    fact_cols = [c for c in facts.columns if c not in keys and c != at]
    most = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if (most or 0) <= FEW_VERSIONS:
        return _asof_in_array(facts, history, keys, at, fact_cols, vcols, prefix)
    vers = history.select(
        *keys, F.col("_effective_date").cast("timestamp").alias("_t"), F.lit(0).alias("_kind"),
        F.struct(*[F.col(c) for c in vcols]).alias("_v"),
        *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in fact_cols],
        F.lit(None).cast(facts.schema[at].dataType).alias(at))
    fx = facts.select(
        *keys, F.col(at).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(vers.schema["_v"].dataType).alias("_v"), *fact_cols, at)
    stream = vers.unionByName(fx)
    filled = seqops.fill_forward(stream, keys, ["_t", "_kind"], "_v", "_cur")
    return _valid_versions(filled.where(F.col("_kind") == 1), keys, at, fact_cols, vcols, prefix)


def _asof_in_array(facts, history, keys, at, fact_cols, vcols, prefix) -> DataFrame:
    version = F.struct(F.col("_effective_date").cast("timestamp").alias("_t"), *vcols)
    versions = history.select(*keys, version.alias("_v")).groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_versions"))
    hashes = [c for c in facts.columns if c in hashing.HASHES or c.endswith("_sk")]
    joined = hashing.packed_during(facts, lambda d: cdc._null_safe_join(d, versions, keys, "left"), hashes)
    joined = joined.withColumn("_t", F.col(at).cast("timestamp"))
    # A start without a time is before all others, a fact without one meets no other.
    begun = F.filter("_versions", lambda v: F.coalesce(v["_t"] <= F.col("_t"), v["_t"].isNull()))
    return _valid_versions(joined.withColumn("_cur", F.try_element_at(begun, F.lit(-1))), keys, at, fact_cols, vcols, prefix)


def _valid_versions(hit, keys, at, fact_cols, vcols, prefix) -> DataFrame:
    """Facts with the version in ``_cur``, if it is still valid at ``_t``."""
    valid = F.col("_cur").isNotNull() & (
        F.col("_cur._end_date").isNull() | (F.col("_t") < F.col("_cur._end_date").cast("timestamp")))
    return hit.select(
        *keys, at, *fact_cols,
        *[F.when(valid, F.col(f"_cur.{c}")).alias(prefix + c) for c in vcols])
