"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 5).

Words are the runs of letters, digits and non-ASCII characters of the
lower-cased text.  Each run of `window` consecutive words of a benchmark item
is a pattern, and an item of fewer words (but not none) is one.  A document
word inside any occurrence of a pattern is hit.

Search: texts and patterns are written as words with one blank before, between
and after, so a pattern's bytes occur exactly where its words stand
consecutively.  Patterns are grouped by length.  For each group a shift table,
indexed by a hash of `BLOCK` bytes, says how far the search may move on from
the block at the cursor without missing a pattern.  Where it says zero, the
patterns whose prefix of the group's least length ends in that block (the
suffix-hash bucket) are compared with the text byte by byte.  A task runs many
cursors at once, one for each short stretch of its texts, with numpy.

The benchmark is cut into blocks of items of `block_bytes` each (measured, not
assumed).  One block's tables go to the tasks as a broadcast, which is bounded
by that parameter; more blocks are searched one after the other and their hits
are united by document.

Null texts have no words; items without words have no windows; a null item id
is ignored in `items`, but its hits count.  Rows of `docs` that are equal in
id and text get equal results.  An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.arrow import ALNUM_WORDS, map_batches, pieces, text_buffers

BLOCK = 8
TABLE_BITS = 18
STRETCH = 512
#: Least lengths of the groups of patterns; a text's stretch is searched once
#: for each group that has patterns.
CLASSES = (3, 8, 16, 32, 48, 64)
HASH = np.uint64(0x9E3779B97F4A7C15)


def normal(text: bytes) -> tuple[bytes, int]:
    """Words with a blank before, between and after; and their number."""
    words = text.translate(ALNUM_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" ", len(words)


def windows(text: bytes, window: int) -> set[bytes]:
    words = text.translate(ALNUM_WORDS).split()
    if not words:
        return set()
    return {b" " + b" ".join(words[i:i + window]) + b" " for i in range(max(1, len(words) - window + 1))}


def _blocks(data: np.ndarray, width: int) -> np.ndarray:
    """At every position, the next `width` bytes as one number (zero padded)."""
    padded = np.concatenate((data, np.zeros(BLOCK, np.uint8)))
    view = np.ndarray((len(data),), "<u8", buffer=padded, strides=(1,))
    return view if width == BLOCK else view & np.uint64((1 << (8 * width)) - 1)


def _slot(blocks: np.ndarray) -> np.ndarray:
    return ((blocks * HASH) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Group:
    """Shift table and suffix-hash buckets of patterns of similar length."""

    def __init__(self, patterns: list[bytes], numbers: list[int]):
        self.patterns, self.numbers = patterns, np.array(numbers, np.int64)
        self.least = least = min(map(len, patterns))
        self.width = width = min(BLOCK, least)
        self.shift = np.full(1 << TABLE_BITS, least - width + 1, np.int32)
        heads = np.frombuffer(b"".join(p[:least] for p in patterns), np.uint8).reshape(-1, least)
        for j in range(least - width + 1):
            block = np.zeros(len(patterns), np.uint64)
            for k in range(width):
                block |= heads[:, j + k].astype(np.uint64) << np.uint64(8 * k)
            slot = _slot(block)
            np.minimum.at(self.shift, slot, least - width - j)
        self.order = np.argsort(slot, kind="stable")  # of the last block: the suffix hash
        self.bucket = np.searchsorted(slot[self.order], np.arange((1 << TABLE_BITS) + 1))

    def search(self, raw: bytes, data: np.ndarray) -> tuple[list[int], list[int]]:
        """(positions, pattern numbers) of all occurrences."""
        blocks = _blocks(data, self.width)
        last = len(data) - self.least
        at: list[int] = []
        which: list[int] = []
        if last < 0:
            return at, which
        cursor = np.arange(0, last + 1, STRETCH)
        end = np.minimum(cursor + STRETCH, last + 1)
        tail = self.least - self.width
        while len(cursor):
            slot = _slot(blocks[cursor + tail])
            step = self.shift[slot]
            zero = np.flatnonzero(step == 0)
            if len(zero):
                self._verify(raw, cursor[zero], slot[zero], at, which)
            cursor = cursor + np.maximum(step, 1)
            on = cursor < end
            cursor, end = cursor[on], end[on]
        return at, which

    def _verify(self, raw: bytes, position: np.ndarray, slot: np.ndarray, at: list[int], which: list[int]) -> None:
        first, n = self.bucket[slot], self.bucket[slot + 1] - self.bucket[slot]
        for p, f, k in zip(position.tolist(), first.tolist(), n.tolist()):
            for o in self.order[f:f + k].tolist():
                if raw.startswith(self.patterns[o], p):
                    at.append(p)
                    which.append(int(self.numbers[o]))


class Searcher:
    """All windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        owners: dict[bytes, set] = {}
        for item, text in items:
            for p in windows(text, window):
                owners.setdefault(p, set()).add(item)
        self.owners = [sorted(i for i in o if i is not None) for o in owners.values()]
        self.words = np.array([p.count(b" ") - 1 for p in owners], np.int64)
        patterns = list(owners)
        self.groups = []
        for lo, hi in zip(CLASSES, (*CLASSES[1:], 1 << 62)):
            if mine := [k for k, p in enumerate(patterns) if lo <= len(p) < hi]:
                self.groups.append(Group([patterns[k] for k in mine], mine))

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[int]]]:
        """For each text: number of words, hit word ranges, item ids."""
        normals = [normal(t) for t in texts]
        raw = b"".join(n for n, _ in normals)
        data = np.frombuffer(raw, np.uint8)
        begin = np.cumsum([0, *(len(n) for n, _ in normals)])
        ranges: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        found = [g.search(raw, data) for g in self.groups]
        at = np.array([p for a, _ in found for p in a], np.int64)
        which = np.array([w for _, ws in found for w in ws], np.int64)
        if len(at):
            blank = np.cumsum(data == 32)
            doc = np.searchsorted(begin, at, "right") - 1
            start = blank[at] - blank[begin[doc]]
            order = np.lexsort((start, doc))
            for d, s, w in zip(doc[order].tolist(), start[order].tolist(), which[order].tolist()):
                e = s + int(self.words[w])
                mine = ranges[d]
                if mine and s <= mine[-1][1]:
                    mine[-1] = (mine[-1][0], max(e, mine[-1][1]))
                else:
                    mine.append((s, e))
                items[d].update(self.owners[w])
        return [n for _, n in normals], ranges, [sorted(i) for i in items]


def _union(ranges: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for s, e in sorted(ranges):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return total


HITS = "n_words long, n_hit long, hits array<struct<start:long,end:long>>, items array<long>"


def _scan(rows: DataFrame, searcher, extra: str) -> DataFrame:
    """Adds HITS to (row, text) rows; `searcher` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            words: list[int] = []
            ranges: list[list[tuple[int, int]]] = []
            items: list[list[int]] = []
            for i, j in pieces(off):
                raw = data[off[i]:off[j]].tobytes()
                cut = (off[i:j + 1] - off[i]).tolist()
                w, r, n = searcher.value.scan([raw[a:b] for a, b in zip(cut[:-1], cut[1:])])
                words += w
                ranges += r
                items += n
            hits = [[{"start": a, "end": b} for a, b in r] for r in ranges]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(map(_union, ranges), pa.int64()),
                 pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(items, pa.list_(pa.int64()))],
                names=["row", "n_words", "n_hit", "hits", "items"])

    return map_batches(rows, run, f"row {extra}, {HITS}")


def item_blocks(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[list]:
    """The benchmark's items in blocks of about `block_bytes` of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item"),
                             F.coalesce(text_col, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r.item, r.text.encode()) for r in part.toLocalIterator()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs` with n_words, n_hit, hits and items.

    `hits` are the maximal hit ranges [start, end) of word numbers, `items`
    the sorted ids of the items with occurring windows.  Columns of `docs`
    with these names are replaced.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "hits", "items"]
    own = [c for c in docs.columns if c not in added]
    row = F.struct(*own).alias("row")
    searchers = [spark.sparkContext.broadcast(Searcher(items, window))
                 for items in item_blocks(benchmark, block_bytes, item_col, item_text_col)]
    rows = docs.select(row, F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    if len(searchers) == 1:
        return _scan(rows, searchers[0], kind).select("row.*", *added)
    # More blocks: slim hits of each, united by the text's 128-bit key.
    keyed = rows.select("row", "text", F.struct(
        F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")).alias("key"))
    once = keyed.select("key", "text").dropDuplicates(["key"]).select(F.col("key").alias("row"), "text")
    parts = [_scan(once, s, "struct<a:bigint,b:bigint>") for s in searchers]
    both = reduce(DataFrame.union, parts).groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Merge sorted ranges: a range that begins inside the last one extends it.
    merged = F.aggregate(
        F.array_sort("hits"), F.slice("hits", 1, 0),
        lambda done, r: F.when(
            (F.size(done) > 0) & (r["start"] <= F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["end"], r["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(r))))
    both = both.withColumn("hits", F.when(F.size("hits") > 0, merged).otherwise(F.col("hits")))
    length = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    slim = both.select(F.col("row").alias("key"), "n_words", length.alias("n_hit"), "hits", "items")
    return keyed.join(slim, "key").select("row.*", *added)


def digest(items: list[int] | None) -> str:
    """Lowercase hex SHA-256 of the item ids, sorted as strings, comma-joined."""
    return hashlib.sha256(",".join(sorted(map(str, items or ()))).encode()).hexdigest()
