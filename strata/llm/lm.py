"""Language-model scores by logistic context mixing (operator 10).

The model predicts the bits of a text's UTF-8 bytes, and of an end mark after
them, most significant first.  Predictor k (0 to `ORDER`) sees the k bytes
before and the bits of the byte so far, and knows how often a 0 and a 1
followed there in all training texts.  Each prediction is stretched, the mixer
adds them up with weights chosen by two gates (the longest context that is well
known together with the bit's number; the byte before), and the squashed result
is refined by an adaptive probability map: per node of the byte's bits a curve
from probability to probability.

Strings.  All that a byte's prediction depends on is the string of `ORDER` + 1
bytes that it ends.  Texts are packed into shards with their distinct strings;
Spark adds up how often each occurs in training texts.  Strings are hashed to
tasks by the `LOW` + 1 bytes before their last one, so that a task has all
counts of the contexts from that length on, each context under its own bytes:
counts of different contexts never mix, and the tables grow with the corpus.
Shorter contexts (2^24 strings of `LOW` + 1 bytes at most) are summed up and
sent to all tasks.  A task holds the strings of a few such contexts at a time.

Learning.  Mixer and map learn from every byte of the training texts, with each
position's own contribution taken out of the counts first: all places of a
string look alike then, so a string counts as often as it occurs in different
training texts (of equal texts, one says how well the others are foretold).
The tasks that hold the strings add up what a Newton step of the weights and
the curves' means need, a table of fixed size.  There are two such steps, each
over every training byte: the first starts from weights and curves that know
nothing, the second refines what the first has found.  (`TUNE_ONE_IN` above 1
puts an online pass over that share of the texts' stretches, `tune_bytes` at
least, in the first one's place; trials of less than the whole only.)  Scoring
uses the frozen model, so a text's score is a function of the text: each
distinct string is scored once, its code length goes back to the shards that
hold it, however often, and a text's are added up.  Between shards and counts
strings travel packed, by buckets of their hash: about `BUCKET_STRINGS` a bucket,
and a string that all shards hold adds one a shard.

Base score: add-one unigram over lower-cased words and one end token a text.
Word counts cover all training texts.  Words that make up at least one in
`MAX_COMMON` of all tokens go to every task as a table (there can be
MAX_COMMON of them at most); all others are joined to their counts by a
shuffle, where by their rarity none is a hot key.  At the shuffle a word is
known by the 64-bit XXH64 of its bytes.

A null text is empty: an end mark and an end token.  Repeated rows keep a row
each.  Without training texts every bit costs one bit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.arrow import LOWER, PIECE_BYTES, map_batches, pieces, sum_by_row, text_buffers
from strata.llm.jaccard import FILTER_BITS, text_filter
from strata.llm.langid import grams
from strata.session import Staged, materialize, scratch_path

ORDER, LOW, END = 5, 2, 0xFF
_LOWER = np.frombuffer(LOWER, np.uint8)
BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
HASH, ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MAX_COMMON = 1_000_000
FLUSH = 400_000
DELTA, KNOWN, CLIP = 0.08, 3.0, 12.0
CURVE = 33
#: What holds back weights of which the texts say little, and a weight's largest move, in the Newton step.
RIDGE, MOVE = 1000.0, 0.5
#: Places that a start counts as at a point of a curve.
START = 50
#: Gates by known context; pairs of both gates.
GATES = (ORDER + 2) * 8
PAIRS = GATES * 256
#: The predictors' pairs, and the sums of a pair of gates: slope, curvature.
CROSS = np.triu_indices(ORDER + 1)
SUMS = ORDER + 1 + len(CROSS[0])
#: Bytes of a stretch, and the share of the training texts that mixer and map start from: all of them.
STRETCH, TUNE_ONE_IN = 2048, 1
#: The `LOW` + 1 bytes of a context.
MASK = np.uint64((1 << (8 * (LOW + 1))) - 1)
#: A shard's texts, and the strings a task works on at a time.
SHARD_BYTES, CHUNK = 16 << 20, 1 << 18
#: Strings of a bucket, over all shards, about.
BUCKET_STRINGS = 1 << 20


def with_end(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with the end mark after each."""
    return np.insert(data, offsets[1:], END), offsets + np.arange(len(offsets))


def nodes(code: np.ndarray) -> np.ndarray:
    """For the 8 bits of each string's last byte: the bits before, after a 1."""
    bit = np.arange(8, dtype=np.uint64)
    return (np.uint64(1) << bit) | ((code & np.uint64(0xFF))[:, None] >> (np.uint64(8) - bit))


def bits_of(code: np.ndarray) -> np.ndarray:
    return ((code & np.uint64(0xFF))[:, None] >> np.arange(7, -1, -1, dtype=np.uint64)).astype(np.int64) & 1


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def turned(code: np.ndarray) -> np.ndarray:
    """The strings with their contexts turned round, the byte before first."""
    out = code & np.uint64(0xFF)
    for k in range(1, ORDER + 1):
        out |= ((code >> np.uint64(8 * k)) & np.uint64(0xFF)) << np.uint64(8 * (ORDER + 1 - k))
    return out


def shortened(key: np.ndarray, k: int) -> np.ndarray:
    """Turned strings with the first k bytes of their contexts only."""
    return (key >> np.uint64(8 * (ORDER - k + 1)) << np.uint64(8)) | (key & np.uint64(0xFF))


def bit_counts(key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """[zeros, ones] after each context at the 8 nodes of its last byte, from
    the counts of distinct, sorted strings."""
    out = np.empty((2, len(key), 8), np.float32)
    for i in range(8 if len(key) else 0):
        prefix = key >> np.uint64(8 - i)
        first = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
        size = np.diff(np.append(first, len(key)))
        ones = np.add.reduceat(n * ((key >> np.uint64(7 - i)) & np.uint64(1)), first)
        out[1, :, i] = np.repeat(ones, size)
        out[0, :, i] = np.repeat(np.add.reduceat(n, first) - ones, size)
    return out


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their sums, place of each key)."""
    distinct, back = np.unique(key, return_inverse=True)
    return distinct, np.bincount(back, weights=n, minlength=len(distinct)), back


class Low:
    """Bit counts of contexts of up to `LOW` bytes."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        """`code` are strings of `LOW` + 1 bytes."""
        key = turned(code)
        self.tables = []
        for k in range(LOW + 1):
            distinct, total, _ = summed(shortened(key, k), n)
            self.tables.append((distinct, bit_counts(distinct, total)))


def all_counts(code: np.ndarray, n: np.ndarray, low: Low) -> np.ndarray:
    """[zeros, ones] of distinct strings by node and predictor: (2, strings, 8, ORDER + 1).

    The strings must be all those with their contexts of `LOW` + 1 bytes.
    """
    key = turned(code)
    out = np.empty((2, len(code), 8, ORDER + 1), np.float32)
    for k in range(ORDER + 1):
        if k <= LOW:
            keys, counts = low.tables[k]
            out[..., k] = counts[:, np.searchsorted(keys, shortened(key, k))]
        else:
            keys, total, back = summed(shortened(key, k), n)
            out[..., k] = bit_counts(keys, total)[:, back]
    return out


@dataclass
class Mixer:
    """The mixer's weights and the curves."""

    by_known: np.ndarray = field(default_factory=lambda: np.full((GATES, ORDER + 1), 0.3, np.float32))
    by_byte: np.ndarray = field(default_factory=lambda: np.zeros((256, ORDER + 1), np.float32))
    curve: np.ndarray = field(default_factory=lambda: np.tile(squash(np.linspace(-CLIP, CLIP, CURVE)), (256, 1)))
    trained: bool = False

    def inputs(self, code: np.ndarray, counts: np.ndarray, own: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(stretched predictions, gate by known context, byte before, node).

        `own`: take each position's own bit out of the counts.
        """
        n0, n1 = counts
        if own:
            bit = bits_of(code)[..., None].astype(np.float32)
            n0, n1 = np.maximum(n0 - (1 - bit), 0), np.maximum(n1 - bit, 0)
        x = np.clip(np.log((n1 + np.float32(DELTA)) / (n0 + np.float32(DELTA))), -CLIP, CLIP)
        well = n0 + n1 >= KNOWN
        known = np.zeros(well.shape[:2], np.int64)
        for k in range(ORDER + 1):
            known[well[..., k]] = k + 1
        gate = known * 8 + np.arange(8)
        before = ((code >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
        return x, gate, before, nodes(code).astype(np.int64)

    def mixed(self, x: np.ndarray, gate: np.ndarray, before: np.ndarray) -> np.ndarray:
        weights = self.by_known[gate] + self.by_byte[before][:, None]
        return np.clip(np.einsum("nbk,nbk->nb", x, weights), -CLIP, CLIP).astype(np.float64)

    def refined(self, mixed: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of a 1, left end of the curve's piece, share of its right end)."""
        place = (mixed + CLIP) * ((CURVE - 1) / (2 * CLIP))
        left = np.minimum(place.astype(np.int64), CURVE - 2)
        share = place - left
        curve = self.curve[node, left] * (1 - share) + self.curve[node, left + 1] * share
        p = 0.5 * (squash(mixed) + curve)
        return np.clip(p, 2.0 ** -18, 1 - 2.0 ** -18), left, share

    def code_lengths(self, code: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Bits of each string's last byte."""
        if not self.trained:
            return np.full(len(code), 8.0)
        out = np.empty(len(code))
        for i in range(0, len(code), 4096):
            part = code[i:i + 4096]
            x, gate, before, node = self.inputs(part, counts[:, i:i + 4096])
            p, _, _ = self.refined(self.mixed(x, gate, before), node)
            out[i:i + 4096] = -np.log2(np.where(bits_of(part) == 1, p, 1 - p).prod(axis=1))
        return out

    def learn_online(self, code: np.ndarray, counts: np.ndarray, place: np.ndarray, chunk: int = 128, rate: float = 0.005,
                     curve_rate: float = 0.02) -> None:
        """One pass over the strings in the order of the texts; `place` is where in `counts` theirs are."""
        for i in range(0, len(code), chunk):
            part = code[i:i + chunk]
            y = bits_of(part)
            x, gate, before, node = self.inputs(part, counts[:, place[i:i + chunk]], own=True)
            mixed = self.mixed(x, gate, before)
            p, left, share = self.refined(mixed, node)
            step = rate / (1 + i / 200_000) * (y - squash(mixed))[..., None] * x
            for table, key in ((self.by_known, gate), (self.by_byte, np.broadcast_to(before[:, None], gate.shape))):
                total = np.zeros_like(table)
                np.add.at(total, key, step)
                n = np.bincount(key.ravel(), minlength=len(table))
                table += (total / np.sqrt(np.maximum(n, 1))[:, None]).astype(np.float32)
            for at, part_share in ((left, 1 - share), (left + 1, share)):
                # Several bits of a chunk may move one point of a curve.
                n = np.zeros_like(self.curve)
                np.add.at(n, (node, at), curve_rate * part_share)
                move = np.zeros_like(self.curve)
                np.add.at(move, (node, at), curve_rate * part_share * (y - self.curve[node, at]))
                self.curve += move / np.maximum(1, n)
            self.trained = True

    def add_sums(self, total: np.ndarray, code: np.ndarray, counts: np.ndarray, n: np.ndarray) -> None:
        """Adds the bits of n places of each string to `total`, (SUMS, PAIRS + 256 * CURVE): by pair of gates
        slope and curvature of their likelihood, by point of a curve its places and the ones there."""
        for i in range(0, len(code), 8192):
            part, weight = code[i:i + 8192], n[i:i + 8192, None].astype(np.float64)
            y = bits_of(part)
            x, gate, before, node = self.inputs(part, counts[:, i:i + 8192], own=True)
            mixed = self.mixed(x, gate, before)
            _, left, share = self.refined(mixed, node)
            p, x, pair = squash(mixed), x.reshape(-1, ORDER + 1), (gate * 256 + before[:, None]).ravel()
            error, curvature = (weight * (y - p)).ravel(), (weight * p * (1 - p)).ravel()
            for k in range(ORDER + 1):
                total[k, :PAIRS] += np.bincount(pair, error * x[:, k], PAIRS)
            for k, (a, b) in enumerate(zip(*CROSS, strict=True), ORDER + 1):
                total[k, :PAIRS] += np.bincount(pair, curvature * x[:, a] * x[:, b], PAIRS)
            for at, part_share in ((left, 1 - share), (left + 1, share)):
                point, places = (node * CURVE + at).ravel(), (weight * part_share).ravel()
                total[0, PAIRS:] += np.bincount(point, places, 256 * CURVE)
                total[1, PAIRS:] += np.bincount(point, places * y.ravel(), 256 * CURVE)

    def begin(self, total: np.ndarray) -> None:
        """The first step, from the sums of a mixer that has learned nothing."""
        self._step(total)
        self.trained = True

    def move(self, total: np.ndarray) -> None:
        """The step after it, from the sums of the mixer as it is now."""
        self._step(total)

    def _step(self, total: np.ndarray) -> None:
        """One Newton step of all weights together, and the curves' means, from the sums of all strings."""
        k = ORDER + 1
        slope = total[:k, :PAIRS].T.reshape(GATES, 256, k)
        bend = np.zeros((PAIRS, k, k))
        bend[:, CROSS[0], CROSS[1]] = bend[:, CROSS[1], CROSS[0]] = total[k:, :PAIRS].T
        bend = bend.reshape(GATES, 256, k, k)
        whole = np.zeros((GATES + 256, k, GATES + 256, k))
        for table, blocks in ((np.arange(GATES), bend.sum(axis=1)), (GATES + np.arange(256), bend.sum(axis=0))):
            whole[table, :, table, :] = blocks
        whole[:GATES, :, GATES:] = bend.transpose(0, 2, 1, 3)
        whole[GATES:, :, :GATES] = bend.transpose(1, 2, 0, 3)
        whole = whole.reshape((GATES + 256) * k, -1) + RIDGE * np.eye((GATES + 256) * k)
        step = np.linalg.solve(whole, np.concatenate((slope.sum(axis=1), slope.sum(axis=0))).ravel())
        step = np.clip(step, -MOVE, MOVE).astype(np.float32).reshape(-1, k)
        self.by_known += step[:GATES]
        self.by_byte += step[GATES:]
        places, ones = total[:2, PAIRS:].reshape(2, 256, CURVE)
        self.curve = (START * self.curve + ones) / (START + places)


class Lookup:
    """Values of distinct keys, most of them by one step in a table; keys that lost
    their place to another have a table of their own."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(2 * max(1, len(keys)))))))
        self.slot = np.full(1 << (64 - int(self.shift)), np.uint64((1 << 64) - 1))
        self.cost = np.zeros(len(self.slot), values.dtype)
        at = ((keys * HASH) >> self.shift).astype(np.int64)
        self.slot[at], self.cost[at] = keys, values
        lost = np.flatnonzero(self.slot[at] != keys)
        self.lost = Lookup(keys[lost], values[lost]) if len(lost) else None

    def __getitem__(self, code: np.ndarray) -> np.ndarray:
        at = ((code * HASH) >> self.shift).astype(np.int64)
        out = self.cost[at]
        miss = np.flatnonzero(self.slot[at] != code)
        if len(miss):
            out[miss] = self.lost[code[miss]]
        return out


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def _distinct_strings(data: np.ndarray, off: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct strings and how often each occurs in texts not held out."""
    found, waiting = [], 0
    for i, j in pieces(off):
        code = grams(*with_end(data[off[i]:off[j]], off[i:j + 1] - off[i]), ORDER + 1)
        code = (code << np.uint64(1)) | np.repeat(held[i:j], np.diff(off[i:j + 1]) + 1).astype(np.uint64)
        code.sort()
        first = np.flatnonzero(np.concatenate(([True], code[1:] >> np.uint64(1) != code[:-1] >> np.uint64(1))))
        n = np.add.reduceat(1 - (code & np.uint64(1)).astype(np.int64), first)
        found.append((code[first] >> np.uint64(1), n))
        # Pieces share most of their strings: added up early they take less room.
        waiting += len(first)
        if waiting > len(found[0][0]):
            found, waiting = [added_up(*map(np.concatenate, zip(*found, strict=True)))], 0
    return added_up(*map(np.concatenate, zip(*found, strict=True)))


def added_up(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their sums, of keys in a few sorted runs."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n[order], first)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a shard of (row, text, held) rows: the texts, and their strings with counts."""
    shard = TaskContext.get().partitionId() << 32

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        rows, held = table.column(0).combine_chunks(), table.column(2).to_numpy().astype(bool)
        data, off = text_buffers(table.column(1))
        keys, n = _distinct_strings(data, off, held)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
             *(pa.array([_packed(x)], pa.binary()) for x in (data, off, np.diff(keys, prepend=np.uint64(0)), n)), pa.array([len(keys)])],
            names=["shard", "row", "data", "off", "strings", "n", "size"])

    parts, size = [], 0
    for b in batches:
        _, off = text_buffers(b.column(1))
        for i, j in pieces(off, SHARD_BYTES):
            if parts and size + off[j] - off[i] > SHARD_BYTES:
                yield packed(parts)
                parts, size, shard = [], 0, shard + 1
            parts.append(b.slice(i, j - i))
            size += off[j] - off[i]
    if parts:
        yield packed(parts)


def bucket_of(code: np.ndarray, buckets: int) -> np.ndarray:
    return (((code * HASH) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of a shard's strings."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        yield int(bucket[order[i]]), order[i:j]


def _dealt(buckets: int) -> Callable:
    """Task function: shards' (shard, strings, n) to packed (bucket, shard, strings, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, strings, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                keys, n = np.cumsum(_unpacked(strings, np.uint64), dtype=np.uint64), _unpacked(n, np.int64)
                rows = [(k, _packed(np.diff(keys[at], prepend=np.uint64(0))), _packed(n[at])) for k, at in by_bucket(keys, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()),
                     *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))], names=["bucket", "shard", "strings", "n"])

    return run


def dealt(shards: DataFrame, buckets: int) -> DataFrame:
    """(bucket, shard, strings, n): the shards' strings by the bucket of their hash."""
    return map_batches(shards.select("shard", "strings", "n"), _dealt(buckets), "bucket long, shard long, strings binary, n binary")


def string_counts(shards: DataFrame, buckets: int) -> DataFrame:
    """(string, n): how often each string of the shards occurs in training texts."""

    def run(bucket: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in bucket.column("strings").to_pylist()]
        keys, n = added_up(np.concatenate(keys), np.concatenate([_unpacked(x, np.int64) for x in bucket.column("n").to_pylist()]))
        return pa.table({"string": keys.view(np.int64), "n": n})

    return dealt(shards, buckets).select("bucket", "strings", "n").groupBy("bucket").applyInArrow(run, "string long, n long")


def bits_of_shards(shards: DataFrame, bits: DataFrame, buckets: int) -> DataFrame:
    """(shard, bucket, bits): the code lengths of a shard's strings of a bucket, packed in their order."""

    def run(strings: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("string")
        keys, values, out = known.column("string").to_numpy(), known.column("bits").to_numpy(), []
        for x in strings.column("strings").to_pylist():
            out.append(_packed(values[np.searchsorted(keys, np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64).view(np.int64))]))
        return pa.table({"shard": strings.column("shard"), "bucket": strings.column("bucket"), "bits": pa.array(out, pa.binary())})

    return (dealt(shards, buckets).select("bucket", "shard", "strings").groupBy("bucket").cogroup(bits.groupBy("bucket"))
            .applyInArrow(run, "shard long, bucket long, bits binary"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"lm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _by_context(function: Callable) -> Callable:
    """Task function: `function` of columns of whole contexts of `LOW` + 1 bytes, about `CHUNK` rows at a time.

    Rows (string, n, ...) must come in the order of these contexts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        state, limit = function(), CHUNK
        for b in batches:
            held.append(b)
            if sum(map(len, held)) < limit:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            context = (table.column(0).to_numpy() >> 8) & ((1 << (8 * (LOW + 1))) - 1)
            cut = int(np.searchsorted(context, context[-1]))
            held = table.slice(cut).to_batches()
            limit = CHUNK if cut else 2 * limit
            if cut:
                yield state(table.slice(0, cut))
        if held:
            yield state(pa.Table.from_batches(held).combine_chunks())

    return run


def whole_contexts(code: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole contexts of `LOW` + 1 bytes, of strings in their order."""
    if len(code):
        context = code >> np.uint64(8) & MASK
        starts = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        steps = np.searchsorted(starts, np.arange(0, len(code), max(1, CHUNK // 8)), "right") - 1
        cuts = np.unique(np.append(starts[steps], len(code))).tolist()
        yield from zip(cuts[:-1], cuts[1:], strict=True)


def _in_contexts(strings: DataFrame) -> DataFrame:
    context = F.shiftright("string", 8).bitwiseAND((1 << (8 * (LOW + 1))) - 1)
    return strings.repartition(context).sortWithinPartitions(context)


def low_counts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Strings of `LOW` + 1 bytes (2^24 at most) and their counts."""
    got = (counts.groupBy(F.col("string").bitwiseAND((1 << (8 * (LOW + 1))) - 1).alias("string"))
           .agg(F.sum("n").alias("n")).toPandas())
    return got["string"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.float64)


def _stretches(below: int) -> Callable:
    """Task function: (hash, text) to (key, strings) of the stretches with keys up to `below`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column(1))
            size = np.diff(off) + 1  # with the end mark
            n = -(-size // STRETCH)
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key = b.column(0).to_numpy().view(np.uint64)[row] + nth.astype(np.uint64) * ODD
            key ^= key >> np.uint64(29)
            key *= HASH
            key ^= key >> np.uint64(32)
            at, strings = np.flatnonzero(key <= np.uint64(below)), []
            for r, first in zip(row[at].tolist(), (nth[at] * STRETCH).tolist()):
                lead, stop = min(ORDER, first), min(first + STRETCH, int(size[r]))
                piece = data[off[r] + first - lead:off[r] + min(stop, int(size[r]) - 1)]
                if stop == size[r]:
                    piece = np.append(piece, np.uint8(END))
                strings.append(grams(piece, np.array([0, len(piece)]), ORDER + 1)[lead:].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), pa.array(strings, pa.binary())],
                                             names=["key", "strings"])

    return run


def _tune_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(task, string) of the stretches of a task."""
    for b in batches:
        strings = [np.frombuffer(x, np.uint64) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column(0).to_numpy(), list(map(len, strings)))),
             pa.array(np.concatenate([np.zeros(0, np.uint64), *strings]).view(np.int64))], names=["task", "string"])


def _tune(mixer: Mixer, texts: DataFrame, counts: DataFrame, strings: DataFrame, low: Broadcast, tune_bytes: int) -> None:
    """Mixer and map start to learn; `trained` stays False only if there are no texts."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0]
    if not size:
        return
    if TUNE_ONE_IN == 1:
        # From the predictors' mean, which is never surer than they are: a Newton step from too sure a mixer overshoots.
        mixer.by_known[:] = 1 / (ORDER + 1)
        mixer.begin(_sums(mixer, strings, low))
        return
    share = max(tune_bytes, size // TUNE_ONE_IN) / size
    hashed = texts.select(F.xxhash64("text").alias("hash"), "text")
    while True:  # copies count once, so a table of copies takes a larger share
        below = min((1 << 64) - 1, int(share * (1 << 64)))
        chosen = materialize(map_batches(hashed, _stretches(below), "key long, strings binary").dropDuplicates(["key"]), spark)
        got = (chosen.agg(F.sum(F.octet_length("strings").cast("long"))).first()[0] or 0) // 8
        if share >= 1 or (got and 2 * got >= tune_bytes):
            break
        share *= 8
    tasks = max(1, round(got / max(1, tune_bytes)))
    chosen = chosen.select(F.pmod("key", F.lit(tasks)).alias("task"), "strings", "key")
    wanted = materialize(map_batches(chosen, _tune_strings, "task long, string long").distinct(), spark)

    def features() -> Callable:
        shorter = Low(*low.value)

        def run(table: pa.Table) -> pa.RecordBatch:
            chosen_rows = np.flatnonzero(table.column(2).to_numpy(zero_copy_only=False).astype(bool))
            code = table.column(0).to_numpy().view(np.uint64)
            # Only contexts in which a wanted string lies are worked out.
            near = np.flatnonzero(np.isin(code >> np.uint64(8) & MASK, code[chosen_rows] >> np.uint64(8) & MASK))
            n, found = table.column(1).to_numpy(), []
            for i, j in whole_contexts(code[near]):
                at = near[i:j]
                counts = all_counts(code[at], n[at], shorter)
                first, last = np.searchsorted(chosen_rows, [at[0], at[-1] + 1])
                found += [x.tobytes() for x in counts[:, np.searchsorted(at, chosen_rows[first:last])].transpose(1, 0, 2, 3)]
            return pa.RecordBatch.from_arrays([table.column(0).take(pa.array(chosen_rows)).combine_chunks(),
                                               pa.array(found, pa.binary())], names=["string", "counts"])

        return run

    flagged = counts.join(wanted.select("string").distinct().withColumn("wanted", F.lit(True)), "string", "left")
    known = map_batches(_in_contexts(flagged.select("string", "n", F.coalesce("wanted", F.lit(False)).alias("wanted"))),
                        _by_context(features), "string long, counts binary")

    def run(stretches: pa.Table, strings: pa.Table) -> pa.Table:
        model = Mixer()
        code = np.frombuffer(b"".join(stretches.sort_by("key").column("strings").to_pylist()), np.uint64)
        keys, blobs = strings.column("string").to_numpy(), strings.column("counts").combine_chunks()
        size = 16 * (ORDER + 1)
        raw = np.frombuffer(blobs.buffers()[2], np.float32, len(blobs) * size, blobs.offset * size * 4).reshape(-1, 2, 8, ORDER + 1)
        order = np.argsort(keys)
        place = order[np.searchsorted(keys, code.view(np.int64), sorter=order)]
        model.learn_online(code, raw.transpose(1, 0, 2, 3), place)
        return pa.table({"n": [len(code)], "by_known": [model.by_known.tobytes()], "by_byte": [model.by_byte.tobytes()],
                         "curve": [model.curve.tobytes()]})

    learned = materialize(
        chosen.groupBy("task").cogroup(wanted.join(known, "string").groupBy("task"))
        .applyInArrow(run, "n long, by_known binary, by_byte binary, curve binary"), spark)
    sums = {name: np.zeros(getattr(mixer, name).shape) for name in ("by_known", "by_byte", "curve")}
    for r in learned.toLocalIterator():
        for name, total in sums.items():
            table = getattr(mixer, name)
            total += r.n / got * np.frombuffer(r[name], table.dtype).reshape(table.shape)
    for name, total in sums.items():
        setattr(mixer, name, total.astype(getattr(mixer, name).dtype))
    mixer.trained = True


def copied_texts(train: DataFrame) -> DataFrame:
    """(text, extra): each text that occurs more than once, and how often more.

    A bitmap of fixed size keeps most others out of the shuffle.
    """
    keyed = train.select(F.xxhash64("text").alias("text_hash"), "text")
    again = _stored(keyed.groupBy("text_hash").agg((F.count("*") - 1).alias("extra")).where("extra > 0"), "copies")
    sent = train.sparkSession.sparkContext.broadcast(text_filter(again))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(0).to_numpy() % FILTER_BITS
            yield b.filter(pa.array((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    return (map_batches(keyed, keep, "text_hash long, text string").groupBy("text_hash").agg(F.first("text").alias("text"))
            .join(again, "text_hash").select("text", "extra"))


def _copied_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(string, extra) of (text, extra) rows."""
    for b in batches:
        data, off = text_buffers(b.column(0))
        extra = b.column(1).to_numpy()
        for i, j in pieces(off):
            cut = off[i:j + 1] - off[i]
            string, n, _ = summed(grams(*with_end(data[off[i]:off[j]], cut), ORDER + 1), np.repeat(extra[i:j], np.diff(cut) + 1))
            yield pa.RecordBatch.from_arrays([pa.array(string.view(np.int64)), pa.array(n.astype(np.int64))], names=["string", "extra"])


def different_places(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(string, n, different): the training texts' strings, their places, and those in different texts."""
    extra = (map_batches(copied_texts(texts), _copied_strings, "string long, extra long")
             .groupBy("string").agg(F.sum("extra").alias("extra")))
    return (counts.where("n > 0").join(extra, "string", "left")
            .select("string", "n", (F.col("n") - F.coalesce("extra", F.lit(0))).alias("different")))


def _sums(mixer: Mixer, strings: DataFrame, low: Broadcast) -> np.ndarray:
    """What a Newton step needs, of every place of the different training texts, by the strings' counts."""
    names = [f"s{k}" for k in range(SUMS)]

    def sums() -> Callable:
        shorter = Low(*low.value)

        def run(table: pa.Table) -> pa.RecordBatch:
            code, n, different = table.column(0).to_numpy().view(np.uint64), *(table.column(k).to_numpy() for k in (1, 2))
            total = np.zeros((SUMS, PAIRS + 256 * CURVE))
            for i, j in whole_contexts(code):
                mixer.add_sums(total, code[i:j], all_counts(code[i:j], n[i:j], shorter), different[i:j])
            key = np.flatnonzero(total.any(axis=0))
            return pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, total[:, key])], names=["key", *names])

        return run

    found = (map_batches(_in_contexts(strings), _by_context(sums), ", ".join(["key long", *(f"{c} double" for c in names)]))
             .groupBy("key").agg(*(F.sum(c).alias(c) for c in names)).toPandas())
    total = np.zeros((SUMS, PAIRS + 256 * CURVE))
    total[:, found["key"].to_numpy(np.int64)] = found[names].to_numpy(np.float64).T
    return total


@dataclass
class Model:
    """The mixer, and the counts of short contexts, which every task needs."""

    mixer: Mixer
    low: Broadcast


def learn(counts: DataFrame, train: DataFrame, tune_bytes: int = 600_000) -> Model:
    """Model of the texts of `train`; `counts` are their strings, as by `string_counts`."""
    model = Model(Mixer(), counts.sparkSession.sparkContext.broadcast(low_counts(counts)))
    with Staged(counts.sparkSession) as staged:
        strings = staged.keep(different_places(train, counts))
        _tune(model.mixer, train, counts, strings, model.low, tune_bytes)
        if model.mixer.trained:
            model.mixer.move(_sums(model.mixer, strings, model.low))
    return model


def string_bits(counts: DataFrame, model: Model, buckets: int) -> DataFrame:
    """(bucket, string, bits): the code length of each string's last byte."""
    mixer, low = model.mixer, model.low

    def lengths() -> Callable:
        shorter = Low(*low.value)

        def run(table: pa.Table) -> pa.RecordBatch:
            code, n = table.column(0).to_numpy().view(np.uint64), table.column(1).to_numpy()
            bits = np.empty(len(code), np.float32)
            for i, j in whole_contexts(code):
                bits[i:j] = mixer.code_lengths(code[i:j], all_counts(code[i:j], n[i:j], shorter))
            return pa.RecordBatch.from_arrays([pa.array(bucket_of(code, buckets)), table.column(0).combine_chunks(), pa.array(bits)],
                                              names=["bucket", "string", "bits"])

        return run

    return map_batches(_in_contexts(counts.select("string", "n")), _by_context(lengths), "bucket long, string long, bits float")


def hash_of(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word)


def coded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words, place of each token among them, ends of
    the texts' tokens): lower-cased words, and the end token, the empty word,
    after each text's."""
    data = _LOWER[data]
    inside = ~BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges], last[edges - 1] = inside[edges], inside[edges - 1]
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - start
    n = np.searchsorted(start, offsets)
    # An end token is a word of no bytes.
    ends = n + np.arange(len(n))
    size = np.insert(size, n[1:], 0)
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [
        None, pa.py_buffer(np.concatenate(([0], np.cumsum(size))).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = words.dictionary_encode()
    hashes = np.array([hash_of(w) for w in coded.dictionary.to_pylist()], np.uint64).view(np.int64)
    return hashes, coded.indices.to_numpy(), ends


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_train, n_all) of a task; sums are passed on when they get long."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, train, every = (np.concatenate(x) for x in zip(*parts, strict=True))
        distinct, back = np.unique(word, return_inverse=True)
        return distinct, *(np.bincount(back, weights=x).astype(np.int64) for x in (train, every))

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, merged())), names=["word", "n_train", "n_all"])

    for b in batches:
        held = b.column(1).to_numpy(zero_copy_only=False)
        data, off = text_buffers(b.column(0))
        for i, j in pieces(off, 4 * PIECE_BYTES):
            hashes, code, ends = coded_words(data[off[i]:off[j]], off[i:j + 1] - off[i])
            learned = np.repeat(~held[i:j].astype(bool), np.diff(ends))
            parts.append((hashes, np.bincount(code, weights=learned, minlength=len(hashes)).astype(np.int64),
                          np.bincount(code, minlength=len(hashes))))
        if sum(len(p[0]) for p in parts) > 2 * FLUSH:
            parts = [merged()]
            if len(parts[0][0]) > FLUSH:
                yield batch()
                parts = []
    if parts:
        yield batch()


class Words:
    """Numbers of words: that of a common word, or -1 - place in `rare`."""

    def __init__(self, common: np.ndarray):
        self.order = np.argsort(common)
        self.common = common[self.order]
        self.rare = np.zeros(0, np.int64)

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each token, ends of the texts' tokens); `rare` are those of these texts."""
        hashes, code, ends = coded_words(data, offsets)
        number = -1 - np.arange(len(hashes))
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            found = self.common[at] == hashes
            number[found] = self.order[at[found]]
        self.rare = hashes
        return number[code], ends


ADDED = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


def score(docs: DataFrame, held_out: Column, text_col: str = "text", tune_bytes: int = 600_000,
          max_common: int = MAX_COMMON) -> DataFrame:
    """All rows of `docs` without the text, scored by models of the rest.

    `held_out` says which rows are not learned from.  Adds n_tokens, n_known,
    train_tokens, base_score, score (log10 of the text's probability under the
    mixing model) and bits_per_byte (total bits by bytes, the end mark
    included); columns of `docs` with these names are replaced.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in (*ADDED, text_col)]
    rows = docs.select(F.struct(*(own or [F.lit(0).alias("none")])).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    kind = rows.schema["row"].dataType
    binary = [T.StructField(c, T.BinaryType()) for c in ("data", "off", "strings", "n")]
    shards = materialize(map_batches(rows, _shards, T.StructType(
        [T.StructField("shard", T.LongType()), T.StructField("row", T.ArrayType(kind)), *binary, T.StructField("size", T.LongType())])), spark)
    buckets = 1 + (shards.agg(F.sum("size")).first()[0] or 0) // BUCKET_STRINGS
    of_strings = _stored(string_counts(shards, buckets), "strings")
    model = learn(of_strings, rows.where("not held").select("text"), tune_bytes)
    back = bits_of_shards(shards, string_bits(of_strings, model, buckets), buckets)

    counts = materialize(map_batches(rows.select("text", "held"), _count_words, "word long, n_train long, n_all long")
                         .groupBy("word").agg(F.sum("n_train").alias("c"), F.sum("n_all").alias("n_all")), spark)
    total = counts.agg(F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 0, 1)).alias("v"), F.sum("n_all").alias("n_all")).first()
    n_train, distinct, n_all = total.n or 0, total.v or 0, total.n_all or 0
    least = n_all / max_common
    common = counts.where(F.col("n_all") >= least).select("word", "c").toPandas()
    divisor = float(n_train + distinct + 1)
    shared = spark.sparkContext.broadcast((common["word"].to_numpy(), common["c"].to_numpy()))

    def run(shard: pa.Table, coded: pa.Table) -> pa.Table:
        common_words, common_counts = shared.value
        words, logs = Words(common_words), np.log10((common_counts + 1) / divisor)
        data, off, strings = (_unpacked(shard.column(c)[0].as_py(), t) for c, t in (("data", np.uint8), ("off", np.int64), ("strings", np.uint64)))
        keys, values = np.cumsum(strings, dtype=np.uint64), np.zeros(len(strings), np.float32)
        of_bucket = dict(zip(coded.column("bucket").to_pylist(), coded.column("bits").to_pylist(), strict=True))
        for k, at in by_bucket(keys, buckets):
            values[at] = _unpacked(of_bucket[k], np.float32)
        lookup = Lookup(keys, values)
        bits, n_tokens, n_known, base, rare = np.zeros(len(off) - 1), [], [], [], []
        for i, j in pieces(off, PIECE_BYTES // 4):
            piece, cut = data[off[i]:off[j]], off[i:j + 1] - off[i]
            marked, ends = with_end(piece, cut)
            bits[i:j] = sum_by_row(lookup[grams(marked, ends, ORDER + 1)], ends)
            number, word_ends = words.numbers(piece, cut)
            is_common, at = number >= 0, np.maximum(number, 0)
            n_tokens.append(np.diff(word_ends))
            n_known.append(sum_by_row(is_common & (common_counts[at] > 0) if len(common_counts) else is_common, word_ends).astype(np.int64))
            base.append(sum_by_row(np.where(is_common, logs[at], 0) if len(logs) else np.zeros(len(number)), word_ends))
            # Hashes of rare words, in order; a text's are cut out by their number.
            hashes = words.rare[-1 - number[~is_common]].astype("<i8")
            rare_ends = np.concatenate(([0], np.cumsum(~is_common)))[word_ends]
            raw = hashes.tobytes()
            rare += [raw[8 * x:8 * y] for x, y in zip(rare_ends[:-1].tolist(), rare_ends[1:].tolist())]
        n_tokens, n_known, base = (np.concatenate(x) for x in (n_tokens, n_known, base))
        return pa.table({"row": shard.column("row").combine_chunks().flatten(), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()), "base": pa.array(base, pa.float64()),
                         "rare": pa.array(rare, pa.binary()), "score": pa.array(-bits * np.log10(2)),
                         "bits_per_byte": pa.array(bits / np.maximum(1, np.diff(off)))})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.array([len(x) for x in b.column(1).to_pylist()]) // 8
            raw = np.frombuffer(b"".join(b.column(1).to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), size)), pa.array(raw)],
                                             names=["number", "word"])

    added = T.StructType.fromDDL("n_tokens long, n_known long, base double, rare binary, score double, bits_per_byte double")
    scored = materialize(
        shards.select("shard", "row", "data", "off", "strings").groupBy("shard").cogroup(back.groupBy("shard"))
        .applyInArrow(run, T.StructType([T.StructField("row", kind), *added.fields]))
        .withColumn("number", F.monotonically_increasing_id()), spark)
    rare_words = map_batches(scored.select("number", "rare").where("length(rare) > 0"), unpack, "number long, word long")
    rest = (rare_words.join(counts.where(F.col("n_all") < least).select("word", "c"), "word")
            .groupBy("number").agg(F.sum(F.log10((F.col("c") + 1) / F.lit(divisor))).alias("more"),
                                   F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("known_too")))
    out = scored.drop("rare").join(rest, "number", "left")
    return out.select(
        *(F.col("row").getField(c).alias(c) for c in own), "n_tokens", (F.col("n_known") + F.coalesce("known_too", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score", "bits_per_byte")
