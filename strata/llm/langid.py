"""Language identification by prediction by partial matching (operator 8).

For each language a variable-order context tree over bytes is learned: for
every context of 0 to `order` bytes, how often each byte followed it.  A byte
seen in its context costs -log2(c / (n + d)) bits (c: its count, n: all counts
there, d: distinct bytes there); one not seen costs the escape, -log2(d / (n + d)),
and is coded in the context that is one byte shorter; a context never seen
costs nothing and is passed over; below order 0 a byte costs 8 bits.  The
statistics are frozen, so a text's code length is a sum over its positions
that depends on `order` + 1 bytes each, and the language with the shortest
code wins.

Frozen trees become hash tables from byte strings to the code lengths in all
languages at once, and a task looks all positions of its texts up together.

Learning uses a bounded sample: for each label its distinct texts in the order
of a hash, until `sample_bytes` are reached (the text that reaches them
included, so every label that has a text has one in the sample).  A text longer
than `max_text_bytes` takes part with that many bytes, in `RANGES` ranges that
a hash places over the whole text.  Scoring reads whole texts.

A null text, or one without a letter, is `und` with score 0, and so is every
text if there are no labelled rows.  Ties go to the first label in order.
Labels that are null are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.arrow import map_batches, pieces, sum_by_row, text_buffers
from strata.session import materialize

UNDETERMINED = "und"
#: Ranges that a long text is learned from.
RANGES = 10
HASH = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that begin no ASCII letter and no longer character.
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def grams(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """At each position the last `size` bytes as a number (zeros before a text)."""
    code = data.astype(np.uint64)
    for back in range(1, size):
        code[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * back)
    starts, ends = offsets[:-1], offsets[1:]
    for k in range(size - 1):  # the first positions see no earlier text
        at = starts[starts + k < ends] + k
        code[at] &= np.uint64((1 << (8 * (k + 1))) - 1)
    return code


class Table:
    """Open-addressing hash table from 64-bit keys to rows of a matrix."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.rows = rows
        self.slot_key = np.zeros(1 << self.bits, np.uint64)
        self.slot_row = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.slot_row[at] < 0)
            _, one = np.unique(at[free], return_index=True)  # one newcomer to a slot
            win = free[one]
            self.slot_key[at[win]], self.slot_row[at[win]] = keys[left[win]], left[win]
            lose = np.ones(len(left), bool)
            lose[win] = False
            left, at = left[lose], (at[lose] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * HASH) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where it is absent."""
        at = self._slot(keys)
        row = self.slot_row[at]
        bad = np.flatnonzero((row >= 0) & (self.slot_key[at] != keys))
        at = at[bad]
        while len(bad):
            at = (at + 1) & ((1 << self.bits) - 1)
            row[bad] = self.slot_row[at]
            on = (row[bad] >= 0) & (self.slot_key[at] != keys[bad])
            bad, at = bad[on], at[on]
        return row


class Model:
    """Frozen context trees of all languages."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = 4):
        self.labels = sorted(samples)
        self.order = order
        n = len(self.labels)
        texts = [samples[x] for x in self.labels]
        buffers = [(np.frombuffer(b"".join(t), np.uint8), np.cumsum([0, *map(len, t)])) for t in texts]
        lower_keys, lower = np.arange(256, dtype=np.uint64), np.full((256, n), 8.0)
        self.levels: list[tuple[Table, Table | None]] = []
        for k in range(order + 1):
            counts = [np.unique(grams(d, o, k + 1), return_counts=True) for d, o in buffers]
            seen = np.unique(np.concatenate([c[0] for c in counts])) if n else np.zeros(0, np.uint64)
            keys = np.arange(256, dtype=np.uint64) if k == 0 else seen
            # Code length one order down, then this order's escape or own code.
            shorter = keys & np.uint64((1 << (8 * k)) - 1) if k else keys
            cost = lower[np.searchsorted(lower_keys, shorter)].copy() if len(keys) else np.zeros((0, n))
            contexts = np.unique(seen >> np.uint64(8)) if k else np.zeros(1, np.uint64)
            escape = np.zeros((len(contexts), n))
            for j, (g, c) in enumerate(counts):
                if not len(g):
                    continue
                ctx, inverse = np.unique(g >> np.uint64(8) if k else np.zeros(len(g), np.uint64), return_inverse=True)
                total, distinct = np.bincount(inverse, weights=c), np.bincount(inverse)
                escape[np.searchsorted(contexts, ctx), j] = np.log2((total + distinct) / distinct)
                at = np.searchsorted(contexts, keys >> np.uint64(8) if k else np.zeros(len(keys), np.uint64))
                cost[:, j] += escape[np.minimum(at, len(contexts) - 1), j]
                cost[np.searchsorted(keys, g), j] = np.log2((total + distinct)[inverse] / c)
            self.levels.append((Table(keys, cost.astype(np.float32)),
                                Table(contexts, escape.astype(np.float32)) if k else None))
            lower_keys, lower = keys, cost

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        code = grams(data, offsets, self.order + 1)
        bits = np.zeros((len(code), len(self.labels)), np.float32)
        left = np.arange(len(code))
        for k in range(self.order, -1, -1):
            table, contexts = self.levels[k]
            key = code[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            row = table.find(key)
            if k == self.order:
                bits = table.rows[np.maximum(row, 0)] if len(table.rows) else bits
                missing = np.flatnonzero(row < 0)
                bits[missing] = 0
            else:
                hit = row >= 0
                bits[left[hit]] += table.rows[row[hit]]
                missing = np.flatnonzero(~hit)
            left = left[missing]
            if not len(left):
                break
            if contexts is not None and len(contexts.rows):
                row = contexts.find(key[missing] >> np.uint64(8))
                bits[left[row >= 0]] += contexts.rows[row[row >= 0]]
        return sum_by_row(bits, offsets)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter (of any script)."""
    out = sum_by_row(ASCII_LETTER[data], offsets) > 0
    for i in np.flatnonzero(~out & (sum_by_row(data >= 128, offsets) > 0)):
        out[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode())
    return out


def _last_hashes(texts: DataFrame, sample_bytes: int, max_text_bytes: int) -> dict[str, int]:
    """The last hash of each label's sample, from distinct (label, hash, size) rows.

    The first hashes come to the driver: so many that they are expected to hold
    the sample and 16 long texts more, and twice as many while they do not.
    """
    sizes = {r.label: r["size"] for r in texts.groupBy("label").agg(F.sum("size").alias("size")).collect()}
    last: dict[str, int] = {}
    wanted = sample_bytes + 16 * max_text_bytes
    while left := [x for x in sizes if x not in last]:
        bound = F.create_map(*[F.lit(y) for x in left
                               for y in (x, -(1 << 63) + min((1 << 64) - 1, (wanted << 64) // sizes[x]))])
        so_far = dict.fromkeys(left, 0)
        for r in sorted(texts.where(F.col("hash") <= bound[F.col("label")]).collect(), key=lambda r: r.hash):
            if r.label not in last:
                so_far[r.label] += r["size"]
                if so_far[r.label] >= min(sample_bytes, sizes[r.label]):
                    last[r.label] = r.hash
        wanted *= 2
    return last


def _ranges(max_text_bytes: int) -> Column:
    """The byte ranges of `text` that are learned from."""
    raw, step = F.col("text").cast("binary"), max(1, max_text_bytes // RANGES)
    stride = F.floor(F.octet_length("text") / RANGES).cast("int")
    return F.when(F.octet_length("text") <= max_text_bytes, F.array(raw)).otherwise(F.transform(
        F.sequence(F.lit(0), F.lit(RANGES - 1)), lambda i: F.substring(
            raw, (i * stride + F.pmod(F.xxhash64("text", i), F.greatest(stride - step + 1, F.lit(1))) + 1).cast("int"),
            F.lit(step))))


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", order: int = 4,
          sample_bytes: int = 400_000, max_text_bytes: int = 100_000) -> Model:
    """Context trees of the labels of `labelled`, from a bounded sample."""
    if not 1 <= order <= 7:
        raise ValueError("order must be 1 to 7")
    rows = (labelled.select(F.col(text_col).alias("text"), F.col(label_col).alias("label"))
            .where("label is not null and octet_length(text) > 0").withColumn("hash", F.xxhash64("text")))
    texts = materialize(rows.groupBy("label", "hash").agg(
        F.max(F.least(F.octet_length("text"), F.lit(max_text_bytes))).cast("long").alias("size")))
    last = _last_hashes(texts, sample_bytes, max_text_bytes)
    if not last:
        return Model({}, order)
    bound = F.create_map(*[F.lit(y) for x in last.items() for y in x])
    part = rows.where(F.col("hash") <= bound[F.col("label")]).select("label", "hash", _ranges(max_text_bytes).alias("ranges"))
    samples: dict[str, list[bytes]] = {}
    for r in part.dropDuplicates(["label", "hash"]).collect():
        samples.setdefault(r.label, []).extend(map(bytes, r.ranges))
    return Model({k: sorted(v) for k, v in samples.items()}, order)


ADDED = ["lang_pred", "score", "bits_per_byte"]


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs` with lang_pred, score and bits_per_byte.

    `score` is the winner's share of the posterior over the languages at equal
    priors; `bits_per_byte` its code length (null for `und`).  Columns of
    `docs` with these names are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct(*own).alias("row"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            best = np.full(batch.num_rows, -1)
            score, per_byte = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, j in pieces(off) if trees.labels else ():
                piece, cut = data[off[i]:off[j]], off[i:j + 1] - off[i]
                bits = trees.code_lengths(piece, cut)
                win = bits.argmin(axis=1)
                least = bits[np.arange(j - i), win]
                letter = has_letter(piece, cut)
                best[i:j] = np.where(letter, win, -1)
                score[i:j] = np.where(letter, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1), 0)
                per_byte[i:j] = least / np.maximum(1, np.diff(cut))
            names = [trees.labels[b] if b >= 0 else UNDETERMINED for b in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score),
                 pa.array(per_byte, mask=best < 0)], names=["row", *ADDED])

    kind = rows.schema["row"].dataType.simpleString()
    return map_batches(rows, run, f"row {kind}, lang_pred string, score double, bits_per_byte double").select("row.*", *ADDED)
