"""Arrow batch helpers shared by the operators that work inside tasks.

Every operator reads the UTF-8 bytes of a text column straight from the Arrow
buffers.  Batches are cut into pieces of a few MB of whole texts, so the numpy
work arrays of a task stay small whatever the number of rows in a batch; one
text longer than a piece is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.session import ship_package

#: Maps A-Z to a-z and leaves every other byte alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Lower-cases A-Z and turns every byte that is no part of a word of letters,
#: digits and non-ASCII characters into a blank.
ALNUM_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))

PIECE_BYTES = 1 << 20


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of whole texts that hold about `limit` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def texts(column: pa.Array) -> Iterator[bytes]:
    """The texts of a column as UTF-8 bytes, one at a time."""
    data, off = text_buffers(column)
    raw = data.tobytes()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield raw[a:b]


def sum_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i+1]], 0 for an empty range.

    Each row is summed by itself (no running total over other rows), so a
    row's result does not depend on its neighbours in the batch.
    """
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float64, copy=False), offsets[full], axis=0)
    return out
