"""Join of two histories: each version split where the other side changes.

``temporal_join(left, right, left_key, right_key, columns)`` gives the left
versions with ``columns`` of the right version valid at the same time.  A left
version during which the right side changes becomes several; where the right
side has no version the columns are NULL, and no time of a left version is
lost.

No version pairs are formed per key.  The right side's versions (and the gaps
between them) are numbered within their key over range slices, two as-of
lookups tell each left version the number valid at its start and the last one
before its end, and the numbers in between are exactly the right versions it
meets.  The join is then an equi-join on (key, number), whose rows are the
result's rows: a manager of a third of all employees spreads over its numbers,
and within one number over the splits AQE makes of the left side.

A NULL left key meets nothing; a left version that ends when it starts is
dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing
from strata.operators import history
from strata.operators import sequence as seqops
from strata.session import materialize

END_OF_TIME = "9999-12-31 00:00:00"


def _points(right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, _t, _v, _no, _next): the right side's changes, gaps included, in
    order; change 0 lies before the first one and has no values."""
    values = F.struct(*columns)
    kind = right.select(values.alias("_v")).schema["_v"].dataType
    starts = right.select(F.col(key).alias("_key"), F.col("_effective_date").alias("_t"), values.alias("_v"))
    ends = right.where("_end_date IS NOT NULL").select(
        F.col(key).alias("_key"), F.col("_end_date").alias("_t"), F.lit(None).cast(kind).alias("_v"))
    # where one version ends and another starts the start wins
    points = (starts.union(ends).where("_key IS NOT NULL").groupBy("_key", "_t").agg(F.max("_v").alias("_v")))
    points = materialize(seqops.numbered(points, ["_key"], ["_t"], "_no"))
    first = points.groupBy("_key").agg(F.min("_t").alias("_next")).select(
        "_key", F.lit(None).cast("timestamp").alias("_t"), F.lit(None).cast(kind).alias("_v"),
        F.lit(0).cast("long").alias("_no"), "_next")
    following = points.select("_key", (F.col("_no") - 1).alias("_no"), F.col("_t").alias("_next")).where("_no > 0")
    return points.join(following, ["_key", "_no"], "left").select("_key", "_t", "_v", "_no", "_next").unionByName(first)


def temporal_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Sequence[str],
                  version_keys: Sequence[str]) -> DataFrame:
    """The left history with ``columns`` of the right one, as described above.

    Both have ``_effective_date`` and ``_end_date`` (half-open, NULL = open).
    ``version_sk`` and ``_is_current`` are those of the split versions;
    ``version_keys`` name the left side's business key.
    """
    own = [c for c in left.columns if c not in ("_effective_date", "_end_date", "_is_current", "version_sk")]
    points = materialize(_points(right, right_key, columns))
    as_of = points.where("_no > 0").select("_key", F.col("_no").cast("long").alias("no"), F.col("_t").alias("_effective_date"),
                                           F.col("_next").alias("_end_date"))
    spans = left.select(F.struct(*own).alias("_row"), F.col(left_key).alias("_key"), F.col("_effective_date").alias("_from"),
                        F.col("_end_date").alias("_to"))
    spans = spans.withColumn("_last", F.coalesce(F.col("_to"), F.lit(END_OF_TIME).cast("timestamp")) - F.expr("INTERVAL 1 MICROSECOND"))
    spans = spans.where(F.col("_last") >= F.col("_from"))
    met = history.asof_join(spans, as_of, ["_key"], "_from", ["no"], prefix="_a_")
    met = history.asof_join(met.drop("_a__effective_date", "_a__end_date"), as_of, ["_key"], "_last", ["no"], prefix="_b_")
    split = met.select("_row", "_key", "_from", "_to", F.explode(F.sequence(
        F.coalesce("_a_no", F.lit(0)).cast("long"), F.coalesce("_b_no", F.lit(0)).cast("long"))).alias("_no"))
    joined = split.join(points, ["_key", "_no"], "left")
    start = F.greatest("_from", "_t")
    end = F.least("_to", "_next")
    out = joined.select("_row.*", *[F.col(f"_v.{c}").alias(c) for c in columns],
                        start.alias("_effective_date"), end.alias("_end_date"))
    return out.withColumns({"_is_current": F.col("_end_date").isNull(),
                            "version_sk": hashing.surrogate_key([*version_keys, "_effective_date"])})
