"""Hash expressions for change detection and surrogate keys.

Both are ``md5`` over the ``|``-joined text of the columns, evaluated by
Spark's generated code (no Python per row).  A NULL input is replaced by a
marker text so that a NULL still changes the hash.

Fixed values (must stay as they are for hashes to be comparable):
  separator ``|``; NULL marker ``NULL_VALUE`` for change hashes and ``NULL``
  for surrogate keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"
CHANGE_NULL = "NULL_VALUE"
KEY_NULL = "NULL"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_of(columns: Sequence, null_marker: str, collision_safe: bool = False) -> Column:
    """md5 hex of the joined text of ``columns``.

    ``collision_safe`` prefixes every field with its length (and writes NULL
    as a length of -1), so ``("a|b", "c")`` and ``("a", "b|c")`` differ and a
    NULL differs from the marker text.
    """
    if not columns:
        raise ValueError("at least one column is needed for a hash")
    parts = []
    for c in columns:
        txt = _as_col(c).cast("string")
        if collision_safe:
            parts.append(F.when(txt.isNull(), F.lit("-1:"))
                         .otherwise(F.concat(F.length(txt).cast("string"), F.lit(":"), txt)))
        else:
            parts.append(F.coalesce(txt, F.lit(null_marker)))
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def change_hash(columns: Sequence, collision_safe: bool = False) -> Column:
    return md5_of(columns, CHANGE_NULL, collision_safe)


def surrogate_key(columns: Sequence, collision_safe: bool = False) -> Column:
    return md5_of(columns, KEY_NULL, collision_safe)


@dataclass(frozen=True)
class Derived:
    """A hash column that follows from other columns of its row: stored tables
    and shuffles, whose larger part hashes would be, can do without it."""

    columns: tuple[str, ...]
    null_marker: str

    def of(self, column: Callable[[str], Column] = F.col) -> Column:
        return md5_of([column(c) for c in self.columns], self.null_marker)


def without(df: DataFrame, derived: Mapping[str, Derived]) -> DataFrame:
    """``df`` with texts NULL where they are as derived, other texts marked by
    ``=`` and a NULL of its own by ``-``; ``restored`` is the way back."""
    return df.withColumns({
        c: F.when(F.col(c).eqNullSafe(d.of()), F.lit(None)).otherwise(F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")))
        for c, d in _present(df, derived).items()})


def restored(df: DataFrame, derived: Mapping[str, Derived]) -> DataFrame:
    return df.withColumns({
        c: F.when(F.col(c).isNull(), d.of()).when(F.col(c) != "-", F.substring(c, 2, 2**31 - 1))
        for c, d in _present(df, derived).items()})


def _present(df: DataFrame, derived: Mapping[str, Derived]) -> dict[str, Derived]:
    kinds = dict(df.dtypes)
    return {c: d for c, d in derived.items() if kinds.get(c) == "string" and all(x in kinds for x in d.columns)}


#: Hash columns of the model that travel as bytes.
HASHES = ("_change_hash", "fact_sales_sk")
_HEX, _TEXT = bytearray(b"\x01"), bytearray(b"\x00")


def _pack(c: str) -> Column:
    return F.when(F.col(c).rlike("^[0-9a-f]{32}\\z"), F.concat(F.lit(_HEX), F.unhex(c))).otherwise(
        F.concat(F.lit(_TEXT), F.col(c).cast("binary")))


def _unpack(c: str) -> Column:
    rest = F.substring(c, 2, 2**31 - 1)
    return F.when(F.substring(c, 1, 1) == F.lit(_HEX), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def packed_during(df: DataFrame, step: Callable[[DataFrame], DataFrame], columns: Sequence[str] = HASHES) -> DataFrame:
    """``step(df)``, a shuffle or join, with text columns as bytes meanwhile: an
    md5's 32 hex digits, which shuffle codecs leave as they are, take 17; other
    texts are kept and take one more."""
    texts = [c for c, kind in df.dtypes if c in columns and kind == "string"]
    return step(df.withColumns({c: _pack(c) for c in texts})).withColumns({c: _unpack(c) for c in texts})
