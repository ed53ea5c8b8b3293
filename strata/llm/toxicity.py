"""Counterfactual-regularised toxicity classifier (operator 3).

A logistic model over the words of a text and their beginnings (4 to 8 bytes),
each present or not.  Training minimises the logistic loss on labelled texts
plus a penalty on the squared change of a text's logit when its identity terms
are swapped for others of their group, so a neutral mention of a group cannot
carry weight, whatever company the group keeps in the labels.

Features are hashed to 2^`BITS` places; of these the model keeps the ones whose
rates in the two classes differ by `MIN_Z` standard errors, so a text's score
does not drift with its length.  The training set is a bounded sample: about
`max_rows` labelled rows, chosen by a hash of the id.  Their features are made
in tasks and only place numbers come to the driver; the model is a table of
2^BITS weights, whatever the data.  Scoring reads whole texts.

Null and empty texts have no features and get the score of the bias.  Without
labels of both classes every text gets the share of label 1 (0 without any).
Repeated rows keep a row each; a repeated label counts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.arrow import ALNUM_WORDS, map_batches, pieces, sum_by_row, text_buffers

BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
MIN_Z, MIN_DOCS = 5.0, 4
HASH = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)
#: Identity terms by group; a swap takes the next of the group.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("she", "he"), ("female", "male"),
    ("black", "white", "asian", "latino"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("immigrants", "natives"), ("immigrant", "native"), ("old", "young"), ("disabled", "abled"),
    ("african", "european", "american", "arab", "chinese", "indian", "mexican"),
)
SWAP = {a.encode(): b.encode() for g in IDENTITY for a, b in zip(g, (*g[1:], g[0]))}
TABLE = np.frombuffer(ALNUM_WORDS, np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place) of all words and beginnings, with repeats."""
    low = TABLE[data]
    low = np.concatenate((low, np.full(8, 32, np.uint8)))
    word = low != 32
    word[-8:] = False
    inside = np.zeros(len(low), bool)
    inside[1:] = word[:-1]
    inside[offsets[1:-1]] = False  # a text's first byte begins a word
    start = np.flatnonzero(word & ~inside)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none
    stop = np.flatnonzero(~word | ~inside)  # where a word may end: next start or blank
    end = stop[np.searchsorted(stop, start, "right")]
    doc = np.searchsorted(offsets, start, "right") - 1
    # The hash of a word is a difference of running sums, moved to power 0.
    power = _powers(len(low))
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low.astype(np.uint64) * power[0][:len(low)])))
    whole = (run[end] - run[start]) * power[1][start]
    view = np.ndarray((len(low) - 7,), "<u8", buffer=low, strides=(1,))
    head, length = view[start], end - start
    docs, places = [doc], [_place(whole ^ HASH)]
    for k in PREFIXES:
        long = np.flatnonzero(length >= k)
        beginning = head[long] & np.uint64((1 << (8 * k)) - 1) if k < 8 else head[long]
        docs.append(doc[long])
        places.append(_place(beginning + np.uint64(k * int(ODD) % (1 << 64))))
    return np.concatenate(docs), np.concatenate(places)


def _place(x: np.ndarray) -> np.ndarray:
    x = x * HASH
    x ^= x >> np.uint64(31)
    return ((x * ODD) >> np.uint64(64 - BITS)).astype(np.int64)


_power_cache: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if not _power_cache or len(_power_cache[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
        _power_cache[:] = [np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, x, np.uint64))))
                           for x in (ODD, inverse)]
    return _power_cache[0], _power_cache[1]


def swap_identity(text: bytes) -> bytes | None:
    """The text with every identity term swapped, or None if it has none."""
    words = text.translate(ALNUM_WORDS).split()
    swapped = [SWAP.get(w, w) for w in words]
    return b" ".join(swapped) if swapped != words else None


@dataclass
class Model:
    weights: np.ndarray  # float32 of 2^BITS
    bias: float

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, place = features(data, offsets)
        hit = np.flatnonzero(self.weights[place])
        once = np.unique(doc[hit] << np.int64(BITS) | place[hit])
        rows, at = once >> BITS, once & ((1 << BITS) - 1)
        ends = np.searchsorted(rows, np.arange(len(offsets)))
        return self.bias + sum_by_row(self.weights[at], ends)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[np.ndarray], swapped: list[np.ndarray | None], labels: np.ndarray, penalty: float = 1.0,
        ridge: float = 1e-4, rounds: int = 400) -> Model:
    """Weights from the places of each text, of its swapped form (or None), and labels."""
    y = np.asarray(labels, np.float64)
    weights = np.zeros(1 << BITS, np.float32)
    if len(y) == 0 or y.min() == y.max():
        share = y.mean() if len(y) else 0.0
        return Model(weights, 40.0 if share == 1 else -40.0)
    counts = np.zeros((2, 1 << BITS))
    for label in (0, 1):
        mine = np.flatnonzero(y == label)
        for i in range(0, len(mine), 256):  # a few texts at a time
            counts[label] += np.bincount(np.concatenate([rows[k] for k in mine[i:i + 256]]), minlength=1 << BITS)
    zeros, ones = counts
    n1, n0 = y.sum(), (1 - y).sum()
    pooled = (ones + zeros + 1) / len(y)
    z = (ones / n1 - zeros / n0) / np.sqrt(pooled * np.maximum(1 - pooled, 1 / len(y)) * (1 / n1 + 1 / n0))
    kept = np.flatnonzero((np.abs(z) >= MIN_Z) & (ones + zeros >= MIN_DOCS))
    number = np.full(1 << BITS, -1)
    number[kept] = np.arange(len(kept))

    def sparse(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = [number[t] for t in texts]
        at = [a[a >= 0] for a in at]
        own = np.repeat(np.arange(len(at)), [len(a) for a in at])
        return own, np.concatenate(at) if at else np.zeros(0, np.int64)

    x_row, x_col = sparse(rows)
    pairs = [(r, s) for r, s in zip(rows, swapped) if s is not None]
    a_row, a_col = sparse([r for r, _ in pairs])
    b_row, b_col = sparse([s for _, s in pairs])
    dot = lambda row, col, w, n: np.bincount(row, weights=w[col], minlength=n)
    w, b = np.zeros(len(kept)), float(np.log(n1 / n0))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, rounds + 1):
        off = sigmoid(b + dot(x_row, x_col, w, len(y))) - y
        grad = np.bincount(x_col, weights=off[x_row], minlength=len(kept)) / len(y) + ridge * w
        if pairs:
            change = dot(a_row, a_col, w, len(pairs)) - dot(b_row, b_col, w, len(pairs))
            grad += 2 * penalty / len(pairs) * (np.bincount(a_col, weights=change[a_row], minlength=len(kept))
                                                - np.bincount(b_col, weights=change[b_row], minlength=len(kept)))
        g = np.append(grad, off.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    weights[kept] = w
    return Model(weights, float(b))


def _places(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return np.unique(features(data, np.array([0, len(data)]))[1])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = 8000, penalty: float = 1.0) -> Model:
    """Model from labelled rows (null labels are left out)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y is not null")
    n = known.count()
    spread = 1 << 30
    part = known.where(F.pmod(F.xxhash64("id"), F.lit(spread)) < int(min(1.0, max_rows / max(1, n)) * spread))
    # The sample is bounded by max_rows, so it may go to every task.
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(part), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            other = [swap_identity(t) for t in texts]
            pack = lambda t: None if t is None else _places(t).astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([pack(t) for t in texts], pa.binary()),
                 pa.array([pack(t) for t in other], pa.binary())], names=["y", "places", "swapped"])

    rows, swapped, y = [], [], []
    for r in map_batches(sample.select("y", "text"), run, "y int, places binary, swapped binary").toLocalIterator():
        y.append(r.y)
        rows.append(np.frombuffer(bytes(r.places), "<i4"))
        swapped.append(None if r.swapped is None else np.frombuffer(bytes(r.swapped), "<i4"))
    return fit(rows, swapped, np.array(y), penalty)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows of `docs` without the text, with score and predicted."""
    own = [c for c in docs.columns if c not in ("score", "predicted", text_col)]
    rows = docs.select(F.struct(*own).alias("row"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            out = np.zeros(batch.num_rows)
            for i, j in pieces(off):
                out[i:j] = sigmoid(shared.value.logits(data[off[i]:off[j]], off[i:j + 1] - off[i]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out), pa.array((out >= 0.5).astype(np.int32))], names=["row", "score", "predicted"])

    kind = rows.schema["row"].dataType.simpleString()
    return map_batches(rows, run, f"row {kind}, score double, predicted int").select("row.*", "score", "predicted")
