"""Change attribution: which columns changed from version to version.

``version_changes`` compares each version of a history with the one before it
and gives a row for every column whose value differs.  Neighbours are found
over range slices (``operators.sequence``), so a key with very many versions
spreads over tasks; no version pairs are formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import sequence as seqops


def version_changes(history: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, _effective_date, column, old_value, new_value) of a type-2 history.

    Values are texts.  NULL is a value like any other, and a NULL key a key.
    A key's first version, and one that begins after a gap (the key was
    deleted in between), has no version to be compared with.
    """
    held = history.select(*keys, "_effective_date", F.struct("_end_date", *columns).alias("_v"))
    pairs = seqops.previous_values(held, keys, ["_effective_date"], ["_v"])
    sides = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_prev__v.{c}").cast("string").alias("old_value"),
                               F.col(f"_v.{c}").cast("string").alias("new_value")) for c in columns])
    return (pairs.where(F.col("_prev__v._end_date") == F.col("_effective_date"))
            .select(*keys, "_effective_date", F.inline(sides))
            .where(~F.col("old_value").eqNullSafe(F.col("new_value"))))


def changes_by_column(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(column, changes, keys_changed): how often each column changed, and of
    how many keys."""
    key = F.struct(*keys)
    return changes.groupBy("column").agg(F.count(F.lit(1)).alias("changes"), F.count_distinct(key).alias("keys_changed"))
