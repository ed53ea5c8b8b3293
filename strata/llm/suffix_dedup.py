"""Removal of repeated byte strings by bucket-pointer refinement (operator 1).

A byte goes if it lies in a string of `length` bytes that also starts earlier:
in a document with a smaller id, or earlier in the same document.

Bucket identifiers.  Every position starts in the bucket of its byte; a bucket
is refined by the identifier found at a later offset: id(2k)[p] is made of
id(k)[p] and id(k)[p+k], and so on, each round reusing the last, up to whole
strings.  Identifiers are 64-bit mixes instead of ranks, because equality is
all that is asked, and so every task refines its own documents without a word
to the others.

Sparse suffixes.  Only some positions are shuffled: every string of `length`
bytes is represented by its least gram (by identifier, leftmost of equals).
Equal strings have the same least gram at the same place, so they meet in that
gram's bucket.  Neighbouring strings mostly share their least gram; such a run
of strings is one *segment*, and its identifier is refined from the string
identifiers at its two ends, which overlap.

The rounds go through `GRAMS`: buckets of 32-byte grams first, one row per
segment.  Equal segments in one bucket: all but the first are repeats as a
whole.  Segments in a bucket that still holds different ones are cut into
shorter runs by the least gram of 72 and then of 92 bytes and dealt to buckets
again, and what is then still mixed goes into the last round string by string.

Each Arrow batch of documents settles its own repeats first: of equal
segments it sends only the earliest on, the others are repeats whatever else
there is.  So a passage shared by a third of all documents comes to one row a
batch at the shuffle.  Buckets are then read in sorted order as a stream; no
group is held in memory.  All rounds and the final cut join the documents by
the same keys, so Spark shuffles the texts once and reuses that exchange.

Documents are known by (id, 64-bit hash of the text), so any number of rows may
share an id, as all null ids do.  A null text is
empty; texts shorter than `length` have no repeats; a null id sorts first.
Rows that share an id are the same document as far as "earlier" goes, so two
equal rows of one id do not remove each other.  Identifiers are compared as
pairs (gram, segment) of 64 bits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.arrow import map_batches, pieces, text_buffers

#: Gram lengths of the rounds before whole strings.
GRAMS = (32, 72, 92)
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NULL_ID = -(1 << 63)

#: A row is (bucket, segment, id, tag, place); tag is the text's hash, place
#: packs the kind of row, `HASH_BITS` spare bits, the start and the run length,
#: from the top.
START_BITS, RUN_BITS, HASH_BITS = 30, 12, 20
SPAN_BITS = START_BITS + RUN_BITS
KIND_AT = SPAN_BITS + HASH_BITS
ROW = "bucket long, segment long, id long, tag long, place long"
BUCKETED, REPEAT, MIXED = 0, 1, 2
MAX_LENGTH = 1000
#: Neighbouring repeats are joined to runs of about this many strings.
LONG_RUN = 3000


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit identifier of the pair (a, b)."""
    x = a * MIX_A
    x ^= x >> np.uint64(29)
    x += b
    x *= MIX_B
    x ^= x >> np.uint64(32)
    return x


def identifiers(data: np.ndarray, widths: list[int]) -> list[np.ndarray]:
    """Bucket identifiers of the strings of each width, at all their starts."""
    level, width = (data.astype(np.uint64) + np.uint64(1)) * MIX_B, 1
    out: dict[int, np.ndarray] = {}
    refine = lambda x, d: _mix(x[:-d], x[d:]) if len(x) > d else x[:0]
    while True:
        for w in widths:
            if width <= w < 2 * width:
                out[w] = refine(level, w - width) if w > width else level
        if 2 * width > max(widths):
            return [out[w] for w in widths]
        level, width = refine(level, width), 2 * width


def least_gram(gram: np.ndarray, count: int) -> np.ndarray:
    """Position of the least of `count` neighbouring grams, for each start."""
    x = gram & np.uint64(0xFFFFFFFF00000000)
    x |= np.arange(len(x), dtype=np.uint64)
    width = 1
    least = lambda x, d: np.minimum(x[:-d], x[d:]) if len(x) > d else x[:0]
    while 2 * width <= count:
        x, width = least(x, width), 2 * width
    if count > width:
        x = least(x, count - width)
    return (x & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """All starts of whole strings inside the documents of a piece."""
    n = int(offsets[-1])
    ok = np.ones(max(0, n - length + 1), bool)
    for e in offsets[1:-1].tolist():
        ok[max(0, e - length + 1):e] = False
    return np.flatnonzero(ok)


def _pack(kind: int, spare: np.ndarray | int, start: np.ndarray, run: np.ndarray) -> np.ndarray:
    return (np.int64(kind) << KIND_AT) | (spare << SPAN_BITS) | (start << RUN_BITS) | run


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, run length) of packed places."""
    return (place >> RUN_BITS) & ((1 << START_BITS) - 1), place & ((1 << RUN_BITS) - 1)


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, at: np.ndarray | None = None):
    """Segments of a piece: (row, start in its text, run, gram, identifier).

    `at` limits them to some (sorted) starts of whole strings.
    """
    at = _starts(offsets, length) if at is None else at
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    grams, string = identifiers(data, [gram, length])
    least = least_gram(grams, length - gram + 1)[at]
    edge = np.flatnonzero((least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.concatenate(([0], edge + 1))
    last = np.concatenate((edge, [len(at) - 1]))
    lo, hi = at[first], at[last]
    ident = _mix(_mix(string[lo], string[hi]), (hi - lo).astype(np.uint64))
    row = np.searchsorted(offsets, lo, "right") - 1
    return (row, lo - offsets[row], hi - lo + 1, grams[least[first]].view(np.int64), ident.view(np.int64))


def _settle(bucket, segment, ident, tag, place) -> tuple[list[np.ndarray], np.ndarray]:
    """Of rows with equal (bucket, segment): the earliest, and the numbers of the rest."""
    span = place & ((1 << SPAN_BITS) - 1)
    order = np.lexsort((span, ident, segment, bucket))
    b, s, i, start = bucket[order], segment[order], ident[order], span[order] >> RUN_BITS
    new = np.ones(len(order), bool)
    new[1:] = (b[1:] != b[:-1]) | (s[1:] != s[:-1])
    # Rows of the first one's own id are not repeats of it, unless they start
    # later; equal rows of one id keep each other.
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    repeat = ~new & ((i != i[head]) | (start != start[head]))
    keep = order[~repeat]
    return [x[keep] for x in (bucket, segment, ident, tag, place)], order[repeat]


def _batch(bucket, segment, ident, tag, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (bucket, segment, ident, tag, place)],
                                      names=["bucket", "segment", "id", "tag", "place"])


def _as(kind: int, place: np.ndarray) -> np.ndarray:
    return (place & ((1 << KIND_AT) - 1)) | (np.int64(kind) << KIND_AT)


def _repeats(ident: np.ndarray, place: np.ndarray, tag: np.ndarray) -> pa.RecordBatch:
    """Repeats take no part in the buckets: they go with their document."""
    return _batch(ident, np.zeros(len(place), np.int64), ident, tag, _as(REPEAT, place))


def _joined_runs(ident: np.ndarray, place: np.ndarray, *tag: np.ndarray) -> tuple[np.ndarray, ...]:
    """Repeats of a batch with neighbouring runs of a text made one."""
    order = np.lexsort((place, *tag, ident))
    ident, place, *tag = (x[order] for x in (ident, place, *tag))
    start, run = unpack(place)
    text = place >> SPAN_BITS
    new = np.ones(len(place), bool)
    new[1:] = (ident[1:] != ident[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + run[:-1])
    for x in tag:
        new[1:] |= x[1:] != x[:-1]
    # Long joined runs are cut where they pass a multiple of LONG_RUN.
    total = np.cumsum(run)
    before = total - run
    base = before[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(new) else before
    part = (before - base) // LONG_RUN
    new[1:] |= part[1:] != part[:-1]
    first = np.flatnonzero(new)
    length = np.add.reduceat(run, first) if len(first) else run
    return ident[first], (place[first] & ~np.int64((1 << RUN_BITS) - 1)) | length, *(x[first] for x in tag)


def find_segments(length: int, gram: int, number: int) -> Callable:
    """Task function: (id, tag, row[, places]) batches to segment rows.

    `number` is the text's place in the row.  With `places` (the packed runs of strings to refine) only those strings
    count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, off = text_buffers(batch.column(2).field(number))
            listed = batch.column(3) if batch.num_columns > 3 else None
            rows = []
            for i, j in pieces(off):
                at = None
                if listed is not None:
                    own = listed.slice(i, j - i)
                    start, count = unpack(own.flatten().to_numpy())
                    doc = np.repeat(off[i:j] - off[i], own.value_lengths().to_numpy())
                    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at = np.unique(np.repeat(doc + start, count) + nth)
                row, start, n, g, ident = segments(data[off[i]:off[j]], off[i:j + 1] - off[i], length, gram, at)
                rows.append((g, ident, ids[i + row], tags[i + row], _pack(BUCKETED, 0, start, n)))
            if rows:
                columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
                kept, repeat = _settle(*columns)
                yield _batch(*kept)
                yield _repeats(*_joined_runs(columns[2][repeat], columns[4][repeat], columns[3][repeat]))

    return run


def read_buckets(mixed: bool) -> Callable:
    """Task function over rows sorted by (bucket, segment, id, start).

    Passes known repeats on, finds those of each (bucket, segment), and if
    `mixed` is set also gives the rows that stay in a bucket with more than
    one segment.  State from batch to batch: the last segment's first row, and
    whether its bucket is mixed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = (1 << SPAN_BITS) - 1
        held: list[np.ndarray] | None = None  # first rows of the last bucket, until it is known to be mixed
        head = None  # (bucket, segment, id, start) that began the last segment
        is_mixed = False
        for batch in batches:
            b, s, i, t, p = (c.to_numpy() for c in batch.columns)
            known = p >> KIND_AT == REPEAT
            if known.any():
                yield _repeats(i[known], p[known], t[known])
                b, s, i, t, p = (x[~known] for x in (b, s, i, t, p))
            if not len(b):
                continue
            start = (p & low) >> RUN_BITS
            new = np.ones(len(b), bool)
            new[1:] = (b[1:] != b[:-1]) | (s[1:] != s[:-1])
            if head is not None:
                new[0] = (b[0], s[0]) != head[:2]
            at = np.maximum.accumulate(np.where(new, np.arange(len(b)), -1))
            if at[0] < 0:  # the batch begins inside a segment
                lead = at < 0
                at[lead] = 0
                first_id = np.where(lead, head[2], i[at])
                first_start = np.where(lead, head[3], start[at])
            else:
                first_id, first_start = i[at], start[at]
            repeat = ~new & ((i != first_id) | (start != first_start))
            if repeat.any():
                yield _repeats(i[repeat], p[repeat], t[repeat])
            head = (b[-1], s[-1], first_id[-1], first_start[-1])
            if not mixed:
                continue
            # Buckets with more than one segment.
            edge = np.ones(len(b), bool)
            edge[1:] = b[1:] != b[:-1]
            joins = held is not None and b[0] == held[0][0]
            run_no = np.cumsum(edge) - 1
            segs = np.bincount(run_no, weights=new)
            many = segs > 1
            if joins:
                many[0] = is_mixed or segs[0] > 0
                if many[0] and not is_mixed:
                    yield _batch(*held[:4], _as(MIXED, held[4]))
            out = ~repeat & many[run_no]
            if out.any():
                yield _batch(b[out], s[out], i[out], t[out], _as(MIXED, p[out]))
            is_mixed = bool(many[-1])
            tail = (run_no == run_no[-1]) & ~repeat
            if is_mixed:
                held = [b[-1:], s[-1:], i[-1:], t[-1:], p[-1:]]
            elif joins and len(segs) == 1:
                held = [np.concatenate((h, x[tail])) for h, x in zip(held, (b, s, i, t, p), strict=True)]
            else:
                held = [x[tail] for x in (b, s, i, t, p)]

    return run


def _field(shift: int, bits: int) -> Column:
    return F.shiftright("place", shift).bitwiseAND((1 << bits) - 1)


def _read(rows: DataFrame, mixed: bool) -> DataFrame:
    """(id, tag, place, kind) of the repeats, and of what stays mixed."""
    ordered = rows.repartition("bucket").sortWithinPartitions(
        "bucket", "segment", "id", F.col("place").bitwiseAND((1 << SPAN_BITS) - 1))
    return map_batches(ordered, read_buckets(mixed), ROW).select(
        "id", "tag", "place", _field(KIND_AT, 2).alias("kind"))


def _by_text(found: DataFrame) -> DataFrame:
    return found.groupBy("id", "tag").agg(F.collect_list("place").alias("places"))


def repeated_runs(keyed: DataFrame, text_col: str, length: int) -> DataFrame:
    """(id, tag, places) of every text with repeated strings; `keyed` has (id, tag, row)."""
    if not 1 <= length <= MAX_LENGTH:
        raise ValueError(f"length must be 1 to {MAX_LENGTH}")
    number = keyed.schema["row"].dataType.fieldNames().index(text_col)
    found, rows = None, keyed
    for gram in [g for g in GRAMS if g < length] + [length]:
        last = gram == length
        read = _read(map_batches(rows, find_segments(length, gram, number), ROW), not last)
        repeats = read.where(F.col("kind") == REPEAT).select("id", "tag", "place")
        found = repeats if found is None else found.union(repeats)
        if not last:
            mixed = _by_text(read.where(F.col("kind") == MIXED))
            # Whole rows, so that this join's exchange is that of the final one.
            # In order, so a task that runs again after a lost executor deals the
            # same batches: what a batch settles by itself depends on its rows.
            rows = (keyed.join(mixed, ["id", "tag"]).select("id", "tag", "row", F.sort_array("places").alias("places"))
                    .sortWithinPartitions("id", "tag"))
    return _by_text(found)


def _keyed(docs: DataFrame, own: list[str], id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("tag"),
                       F.struct(*own).alias("row"))


def removed_spans(places: list[int] | None, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the strings that start at `places`."""
    if not places:
        return []
    start, run = unpack(np.array(places, np.int64))
    order = np.argsort(start)
    start, stop = start[order], np.maximum.accumulate((start + run - 1 + length)[order])
    gap = np.flatnonzero(start[1:] > stop[:-1]) + 1
    first = np.concatenate(([0], gap))
    last = np.concatenate((gap - 1, [len(start) - 1]))
    return list(zip(start[first].tolist(), stop[last].tolist()))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given byte ranges."""
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept)


def suffix_dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with removal results.

    Adds n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes) and
    `kept_text`: the remaining bytes as text, without the broken ends of
    characters that were cut through.  Columns of `docs` with these names are
    replaced.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    own = [c for c in docs.columns if c not in added]
    keyed = _keyed(docs, own, id_col, text_col)
    joined = keyed.join(repeated_runs(keyed, text_col, length), ["id", "tag"], "left").select("row", "places")
    kind, number = joined.schema["row"].dataType.simpleString(), own.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_buffers(batch.column(0).field(number))
            raw = data.tobytes()
            cols: list[list] = [[], [], [], [], []]
            for k, places in enumerate(batch.column(1).to_pylist()):
                t = raw[off[k]:off[k + 1]]
                spans = removed_spans(places, length)
                kept = cut(t, spans)
                for c, v in zip(cols, (len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                                       kept.decode("utf-8", "ignore")), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])],
                names=["row", *added])

    out = map_batches(joined, apply, f"row {kind}, n_bytes long, n_removed long, n_spans long, "
                                   "kept_sha256 string, kept_text string")
    return out.select("row.*", *added)
