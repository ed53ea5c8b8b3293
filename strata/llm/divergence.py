"""Source divergence audit by a token-start pointer sort (operator 13).

Pointers.  Every term (a run of letters and non-ASCII characters, A-Z
lower-cased) of a shard is a pointer to its start in the Arrow buffer.  The
pointers are put in order by multikey quicksort: a slice of pointers is parted
around a pivot of eight bytes at the slice's depth; what is smaller or larger
stays at that depth, what is equal goes on eight bytes deeper, and slices of
few pointers are finished by numpy's sorts.  Every step is stable and the
pointers start in the order of their (language, source) and document, so an
equal run yields the term, its occurrences in each source, and in how many
documents it stands, without another sort.

A shard is a few MB of whole texts.  A text longer than that is cut into
stretches between terms, whose counts are added up before its document is
counted once.

Statistics.  Per language the terms in `min_docs` or more of its documents are
kept.  Smoothed relative frequencies are integers (parts of `SCALE`, plus
one), their divergence is a sum of floored squares, all exact: products that
pass 64 bits are decimals.

* `pair`: every source against every other one of its language, over all kept
  terms.  Term vectors are keyed by (language, term), so a language that holds
  most rows spreads over all tasks; a task sums a matrix of sources a batch.
* `term`: the terms that a source uses more than its language does, the
  `top_terms` of largest value.

Nulls (text, language, source) count as ''; each row is a document, also when
rows repeat; a group without kept terms has pairs of value 0 only if its
language keeps none; other columns do not matter.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.arrow import map_batches, pieces, text_buffers
from strata.session import scratch_path

#: Lower-cases A-Z and turns every byte that is no part of a term into 0.
TERM_BYTES = np.frombuffer(bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)), np.uint8)

SHARD_BYTES = 4 << 20
#: Slices of up to so many pointers are finished by numpy's sorts.
SLICE = 1 << 13
SCALE = 1_000_000_000
#: Cells of a matrix (terms x sources) that a task holds at once.
CELLS = 1 << 20


class Pointers:
    """Term starts of a shard: places, lengths, and their bytes by depth."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """`data` holds whole texts (or stretches of one), one after the other."""
        self.bytes = np.concatenate((TERM_BYTES[data], np.zeros(8, np.uint8)))
        inside = self.bytes[:-8] != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) + 1 - self.start
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(self.start, offsets)))
        self._eight = np.ndarray(len(data) + 1, "<u8", self.bytes.tobytes(), strides=(1,))

    def key(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        """Bytes [depth, depth + 8) of the terms, zeros after their ends."""
        rest = self.length[pointers] - depth
        key = self._eight[np.minimum(self.start[pointers] + depth, len(self._eight) - 1)].byteswap()
        cut = np.clip(8 - rest, 0, 8)
        key &= np.where(cut < 8, np.uint64(0xFFFFFFFFFFFFFFFF) << (8 * (cut % 8)).astype(np.uint64), np.uint64(0))
        return key


def _finish(terms: Pointers, part: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A small slice in order, and the starts of its equal runs."""
    order = np.argsort(key, kind="stable")
    part, key = part[order], key[order]
    new = np.ones(len(part), bool)
    new[1:] = key[1:] != key[:-1]
    goes_on = key & np.uint64(0xFF) != 0
    while goes_on.any():
        run = np.cumsum(new) - 1
        at = np.flatnonzero(goes_on & (np.bincount(run)[run] > 1))
        if not len(at):
            break
        depth += 8
        key = terms.key(part[at], depth)
        order = np.lexsort((key, run[at]))
        part[at], key = part[at][order], key[order]
        same = run[at][1:] == run[at][:-1]
        new[at[1:]] |= same & (key[1:] != key[:-1])
        goes_on[:] = False
        goes_on[at] = key & np.uint64(0xFF) != 0
    return part, new


def multikey_quicksort(terms: Pointers, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers by term, stable, and the starts of runs of equal terms."""
    out, new = np.empty_like(order), np.zeros(len(order), bool)
    todo = [(0, order, terms.key(order, 0), 0)]
    while todo:
        at, part, key, depth = todo.pop()
        stop = at + len(part)
        if len(part) <= SLICE:
            if len(part):
                out[at:stop], new[at:stop] = _finish(terms, part, key, depth)
            continue
        probe = key[::len(key) // 63]
        pivot = np.partition(probe, len(probe) // 2)[len(probe) // 2]
        less, equal = key < pivot, key == pivot
        more = ~(less | equal)
        n_less, n_equal = int(less.sum()), int(equal.sum())
        todo.append((at, part[less], key[less], depth))
        todo.append((at + n_less + n_equal, part[more], key[more], depth))
        part, at = part[equal], at + n_less
        if int(pivot) & 0xFF:
            todo.append((at, part, terms.key(part, depth + 8), depth + 8))
        else:  # the term ends here: an equal run
            out[at:at + n_equal] = part
            new[at] = True
    return out, new


def _slices(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Strings data[start:start + length]."""
    off = np.concatenate(([0], np.cumsum(length)))
    place = np.arange(off[-1]) + np.repeat(start - off[:-1], length)
    return pa.Array.from_buffers(pa.large_utf8(), len(start),
                                 [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[place])])


def shard_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, occurrences, documents) of a shard; `group` numbers its texts' groups."""
    terms = Pointers(data, offsets)
    rank = np.empty(len(group), np.int64)
    rank[np.argsort(group, kind="stable")] = np.arange(len(group))
    order, new = multikey_quicksort(terms, np.argsort(rank[terms.doc], kind="stable"))
    doc = terms.doc[order]
    new_doc, new_cell = new.copy(), new.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    new_cell[1:] |= group[doc[1:]] != group[doc[:-1]]
    cell = np.flatnonzero(new_cell)
    head = order[cell]
    counts = np.diff(np.append(cell, len(order)))
    docs = np.add.reduceat(new_doc.astype(np.int64), cell) if len(cell) else counts
    return _slices(terms.bytes, terms.start[head], terms.length[head]), group[doc[cell]], counts, docs


def _stretches(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in stretches of about `limit` bytes that cut no term."""
    at = 0
    while at < len(data):
        stop = at + limit
        while stop < len(data) and TERM_BYTES[data[stop]]:
            gaps = np.flatnonzero(TERM_BYTES[data[stop:stop + limit]] == 0)
            stop += int(gaps[0]) if len(gaps) else limit
        yield data[at:stop]
        at = stop


def long_text_counts(data: np.ndarray, limit: int) -> tuple[pa.Array, np.ndarray]:
    """(term, occurrences) of one text, a stretch at a time."""
    total = None
    for part in _stretches(data, limit):
        term, _, count, _ = shard_counts(part, np.array([0, len(part)]), np.zeros(1, np.int64))
        new = pa.table({"term": term, "n": pa.array(count)})
        total = new if total is None else pa.concat_tables([total, new]).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
    return total["term"].combine_chunks(), total["n"].to_numpy()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences, and documents that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], names=["lang", "source"])
            seen: dict[tuple, int] = {}
            group = np.array([seen.setdefault((x["lang"], x["source"]), len(seen)) for x in names.to_pylist()])
            langs, sources = (pa.array([k[i] for k in seen], pa.string()) for i in (0, 1))
            data, off = text_buffers(batch.column(2))
            for i, j in pieces(off, shard_bytes):
                part, ends = data[off[i]:off[j]], off[i:j + 1] - off[i]
                if len(part) > shard_bytes and j == i + 1:
                    term, count = long_text_counts(part, shard_bytes)
                    of, n_docs = np.full(len(term), group[i]), np.ones(len(term), np.int64)
                else:
                    term, of, count, n_docs = shard_counts(part, ends, group[i:j])
                if len(term):
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(of)), sources.take(pa.array(of)), term.cast(pa.string()),
                         pa.array(count.astype(np.int64)), pa.array(n_docs.astype(np.int64))],
                        names=["lang", "source", "term", "n", "n_docs"])

    slim = docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source"), F.col(text_col))
    return (map_batches(slim, run, "lang string, source string, term string, n long, n_docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def pair_sums(vectors: DataFrame) -> DataFrame:
    """(lang, a, b, value): summed divergence of source a from b, by number.

    `vectors` has (lang, no, p, zero): for each term the sources that hold it
    with their frequencies, and the frequency that each source of the language
    gives a term it does not hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            code = lang.indices.to_numpy()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                at = np.flatnonzero(code == k)
                zero = np.array(batch.column(3)[int(at[0])].as_py(), np.int64)
                total = np.zeros((len(zero), len(zero)), np.int64)
                step = max(1, CELLS // len(zero))
                for i in range(0, len(at), step):
                    rows = pa.array(at[i:i + step])
                    no, p = batch.column(1).take(rows), batch.column(2).take(rows)
                    dense = np.tile(zero, (len(rows), 1))
                    dense[np.repeat(np.arange(len(rows)), no.value_lengths().to_numpy()), no.flatten().to_numpy()] = p.flatten().to_numpy()
                    for a in range(len(zero)):
                        d = dense[:, a:a + 1] - dense
                        total[a] += (d * d // dense).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(zero), pa.string()), pa.array(np.arange(len(zero))),
                     pa.array(list(total), pa.list_(pa.int64()))], names=["lang", "a", "row"])

    summed = map_batches(vectors, run, "lang string, a long, row array<long>")
    return (summed.select("lang", "a", F.posexplode("row").alias("b", "value"))
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def _frequency(count: str, size: str, terms: str) -> Column:
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0))) div CAST({size} + {terms} AS DECIMAL(20,0))")


def divergence(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, lang_col: str = "lang",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) as described above."""
    spark = docs.sparkSession
    by_lang = Window.partitionBy("lang").orderBy("source")
    groups = (docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source")).distinct()
              .withColumn("no", F.row_number().over(by_lang) - 1))
    path = scratch_path(spark, "divergence-groups")
    groups.write.parquet(path)
    groups = spark.read.parquet(path)
    path = scratch_path(spark, "divergence-terms")
    (term_counts(docs, lang_col, source_col, text_col).join(groups, ["lang", "source"])
     .groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"),
                                  F.collect_list(F.struct("no", "n")).alias("cells"))
     .where(F.col("n_docs") >= min_docs).write.parquet(path))
    kept = spark.read.parquet(path)

    sizes = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", "c.no").agg(F.sum("c.n").alias("size"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_size"))
    sized = (groups.join(sizes, ["lang", "no"], "left").join(terms, "lang", "left")
             .na.fill(0, ["size", "v", "lang_size"]))
    langs = sized.groupBy("lang", "v", "lang_size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("no", "size"))), lambda x: x["size"]).alias("sizes"),
        F.transform(F.array_sort(F.collect_list(F.struct("no", "source"))), lambda x: x["source"]).alias("sources"))
    path = scratch_path(spark, "divergence-langs")
    langs.write.parquet(path)
    langs = spark.read.parquet(path)

    placed = kept.join(langs, "lang")
    own = F.expr(f"transform(cells, c -> struct(CAST(c.no AS BIGINT) AS no, 1 + (CAST({SCALE} AS DECIMAL(10,0)) * "
                 "CAST(c.n + 1 AS DECIMAL(20,0))) div CAST(sizes[c.no] + v AS DECIMAL(20,0)) AS p))")
    zero = F.expr(f"transform(sizes, s -> 1 + CAST({SCALE} AS BIGINT) div (s + v))")
    vectors = placed.select("lang", own.alias("own"), zero.alias("zero")).select("lang", "own.no", "own.p", "zero")
    sides = langs.select("lang", F.posexplode("sources").alias("a", "source"), "sources")
    pairs = (sides.select("lang", "a", "source", F.posexplode("sources").alias("b", "item")).where("a != b")
             .join(pair_sums(vectors), ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")))

    q = _frequency("n", "lang_size", "v")
    above = (placed.select("lang", "term", "sources", q.alias("q"), F.explode(own).alias("c"))
             .select("lang", F.expr("sources[c.no]").alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"),
                     F.col("c.p").alias("p"), "q").where("p > q")
             .select("lang", "source", "part", "item", F.expr("(p - q) * (p - q) div q").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    top = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)
