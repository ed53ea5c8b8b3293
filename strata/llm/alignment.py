"""Alignment of two tokenizers over the same bytes (operator 12).

Side A is a byte-level BPE and encodes a blank and the text; side B is a piece
model that adds the blank itself.  Both sides' tokens cover the same bytes.

Per piece of whole texts (a few MB) pandas `merge_asof`, keyed by document,
finds for each token start the other side's token that covers it, in both
directions; the union of both is every overlapping pair of tokens, since two
ranges that overlap do so from the later of their starts on.  Places where
tokens of both sides end cut a document into groups.

Encoding.  A text is encoded in words: neither side joins bytes across a
single blank between two characters that are no white space (the pattern of
side A starts a token there, and no piece of side B holds a blank after another
character; both are checked when a vocabulary is loaded), so the tokens of a
text are those of its words, and each distinct word of a shard is encoded once.
A shard is several pieces, which bound the memory of a task.

Counts over the corpus.  `links` is one row a shard: the documents' own
figures, the shard's distinct linked id pairs with the number of documents that
hold each, and what each document holds of them, compressed.  It is written
once.  Pair counts are summed over shards, the highest count of each A id is
found, and both go back to the shards as arrays in the shard's order of pairs.
Neither a pair nor a document's links are ever sent anywhere as a row of their
own, so a pair held by every document costs one row a shard.

Nulls, empty texts and texts whose joined token bytes differ on either side
have no tokens: zeros and ''.  Repeated rows, also of one id, are documents of
their own.  Other columns do not matter.  A text longer than a piece is a
piece by itself.  An empty table gives an empty result.

Both vocabulary files must be readable at their path on every executor.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.arrow import map_batches, pieces, text_buffers
from strata.session import scratch_path

PIECE_BYTES = 2 << 20
#: A shard's texts; the more, the fewer rows go to the corpus counts.
SHARD_BYTES = 24 << 20
#: Distinct words that are encoded at once.
WORDS = 20_000
BLANK = 32
#: Printable ASCII; with the letters of two bytes that begin with LATIN these
#: are the characters beside a blank at which words are cut.
GRAPH = np.array([0x21 <= b <= 0x7E for b in range(256)])
LATIN = 0xC3


class Side:
    """One vocabulary: encodes words, knows the bytes of its ids."""

    def __init__(self, encode, pieces_of: list[bytes]):
        self.encode = encode
        self.offsets = np.cumsum([0] + [len(p) for p in pieces_of])
        self.bytes = np.frombuffer(b"".join(pieces_of) + b"\0", np.uint8)
        names = [str(i).encode() for i in range(len(pieces_of))]
        self.name_length = np.array([len(n) for n in names])
        width = int(self.name_length.max()) + 1
        self.names = np.frombuffer(b"".join(n.ljust(width, b"\0") for n in names), np.uint8).reshape(-1, width)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.offsets[ids + 1] - self.offsets[ids]

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of tokens."""
        length = self.lengths(ids)
        stop = np.cumsum(length)
        return self.bytes[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.offsets[ids] - stop + length, length)]


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from
    U+0100 on, in order.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@functools.cache
def byte_side(path: str) -> Side:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    kind = str(tokenizer.pre_tokenizer)
    if not kind.startswith("ByteLevel(") or "use_regex=False" in kind:
        raise ValueError(f"side A must cut texts by the byte-level pattern, not by {kind}")
    names, special = byte_alphabet(), {i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    spelled = [b"" if i in special else bytes(names[c] for c in e) for i, e in enumerate(entries)]
    return Side(lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)], spelled)


@functools.cache
def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = [bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i)
               else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
    for piece in spelled:
        if b" " in piece.lstrip(b" "):
            raise ValueError(f"a piece may not hold a blank after another character: {piece!r}")
    return Side(lambda words: model.encode([w[1:] for w in words], num_threads=1), spelled)


def _blank_first(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a blank before each."""
    return np.insert(data, offsets[:-1], BLANK), offsets + np.arange(len(offsets))


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the words of blank-led texts: each text's start, and each
    single blank between characters that are no white space."""
    begins = np.zeros(len(data), bool)
    at = np.flatnonzero(data == BLANK)
    at = at[(at > 1) & (at < len(data) - 1)]
    before = GRAPH[data[at - 1]] | ((data[at - 1] >= 0x80) & (data[at - 2] == LATIN))
    begins[at[before & (GRAPH[data[at + 1]] | (data[at + 1] == LATIN))]] = True
    begins[offsets[:-1]] = True
    return np.flatnonzero(begins)


class Encoded:
    """The words of some blank-led texts and the ids of each distinct one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sides: tuple[Side, Side]):
        self.starts = word_starts(data, offsets)
        words = pa.Array.from_buffers(pa.large_utf8(), len(self.starts), [
            None, pa.py_buffer(np.append(self.starts, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        self.nth = words.indices.to_numpy()
        self.coded = []
        for side in sides:
            ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for i in range(0, len(words.dictionary), WORDS):
                found = side.encode(words.dictionary.slice(i, WORDS).to_pylist())
                counts.append(np.fromiter(map(len, found), np.int64, len(found)))
                ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(counts[-1].sum())))
            count = np.concatenate(counts)
            self.coded.append((np.concatenate(ids), np.cumsum(count) - count, count))

    def tokens(self, side: int, words: slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all these words one after the other, number of each word's)."""
        ids, first, count = self.coded[side]
        first, count = first[self.nth[words]], count[self.nth[words]]
        stop = np.cumsum(count)
        return ids[np.arange(int(stop[-1])) + np.repeat(first - stop + count, count)], count


def tokens(data: np.ndarray, offsets: np.ndarray, sides: tuple[Side, Side], encoded: Encoded | None = None,
           at: int = 0) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(doc, id, start, end) of each side's tokens, places in `data`.

    Documents whose tokens do not spell their bytes on either side are left
    out on both.  `encoded` are the words of the data that `data` stands in, at
    place `at`.
    """
    encoded = encoded or Encoded(data, offsets, sides)
    words = slice(*np.searchsorted(encoded.starts, [at, at + len(data)]).tolist())
    doc_of_word = np.searchsorted(offsets, encoded.starts[words] - at, "right") - 1
    sizes = np.diff(offsets)
    whole = sizes > 1
    found = []
    for k, side in enumerate(sides):
        ids, count = encoded.tokens(k, words)
        doc, length = np.repeat(doc_of_word, count), side.lengths(ids)
        whole &= np.bincount(doc, weights=length, minlength=len(sizes)).astype(np.int64) == sizes
        found.append((ids, doc, length))
    for side, (ids, doc, _) in zip(sides, found, strict=True):
        expected = data if whole.all() else data[np.repeat(whole, sizes)]
        spelled = side.spell(ids if whole.all() else ids[whole[doc]])
        wrong = np.flatnonzero(spelled != expected)
        if len(wrong):
            whole[np.searchsorted(np.cumsum(sizes * whole), wrong, "right")] = False
    frames = []
    for ids, doc, length in found:
        if not whole.all():
            keep = whole[doc]
            ids, doc, length = ids[keep], doc[keep], length[keep]
        # Texts that were left out have no tokens to move the places along.
        skipped = np.cumsum(np.where(whole, 0, sizes))
        end = np.cumsum(length) + skipped[doc]
        frames.append(pd.DataFrame({"doc": doc, "id": ids, "start": end - length, "end": end}))
    return frames[0], frames[1]


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """(a, b): row numbers of all overlapping tokens, each pair once."""
    if not len(a):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    side = {"a": a[["doc", "start"]].assign(a=np.arange(len(a))), "b": b[["doc", "start"]].assign(b=np.arange(len(b)))}
    into_b = pd.merge_asof(side["a"], side["b"], on="start", by="doc")
    into_a = pd.merge_asof(side["b"], side["a"], on="start", by="doc")
    # Tokens that begin at the same place are found from both sides.
    both = into_a["a"].to_numpy()
    again = a["start"].to_numpy()[both] == b["start"].to_numpy()
    return pd.concat([into_b[["a", "b"]], into_a.loc[~again, ["a", "b"]]], ignore_index=True)


def group_texts(a: pd.DataFrame, b: pd.DataFrame, sides: tuple[Side, Side], n_docs: int) -> tuple[np.ndarray, list[bytes]]:
    """(number of groups, `a1,a2|b1;a3|b2,b3`) of each document."""
    cuts = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    last = np.searchsorted(cuts, a["end"].to_numpy())
    n_groups = np.bincount(a["doc"].to_numpy()[np.searchsorted(a["end"].to_numpy(), cuts)], minlength=n_docs)
    group = np.concatenate((last, np.searchsorted(cuts, b["end"].to_numpy())))
    is_b = np.concatenate((np.zeros(len(a), np.int64), np.ones(len(b), np.int64)))
    doc = np.concatenate((a["doc"].to_numpy(), b["doc"].to_numpy()))
    order = np.argsort(2 * group + is_b, kind="stable")
    group, is_b, doc = group[order], is_b[order], doc[order]
    width = max(s.names.shape[1] for s in sides)
    name, length = np.zeros((len(order), width), np.uint8), np.zeros(len(order), np.int64)
    ids = np.concatenate((a["id"].to_numpy(), b["id"].to_numpy()))[order]
    for k, side in enumerate(sides):
        at = np.flatnonzero(is_b == k)
        name[at, :side.names.shape[1]] = side.names[ids[at]]
        length[at] = side.name_length[ids[at]]
    mark = np.full(len(order), ord(","), np.uint8)
    mark[:-1][is_b[1:] > is_b[:-1]] = ord("|")
    mark[:-1][group[1:] != group[:-1]] = ord(";")
    ends = np.ones(len(order), bool)
    ends[:-1] = doc[1:] != doc[:-1]
    mark[ends] = 0
    name[np.arange(len(order)), length] = mark
    text = name[name != 0].tobytes()
    size = np.bincount(doc, weights=length + (mark != 0), minlength=n_docs).astype(np.int64)
    stop = np.cumsum(size)
    return n_groups, [text[e - n:e] for n, e in zip(size.tolist(), stop.tolist())]


def _packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype(np.uint32).tobytes() for x in arrays))


def _unpacked(blob: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint32).astype(np.int64)


def piece_links(data: np.ndarray, offsets: np.ndarray, sides: tuple[Side, Side], encoded: Encoded | None = None,
                at: int = 0) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Figures of the blank-led texts of a piece, and what each holds of the id pairs.

    Gives [n_a, n_b, n_groups, n_links], the hashes, the distinct linked pairs
    (A id * 2^32 + B id), and for each text and pair in order: text * number
    of pairs + pair, and how often.
    """
    n = len(offsets) - 1
    a, b = tokens(data, offsets, sides, encoded, at)
    pair = overlaps(a, b)
    n_groups, texts = group_texts(a, b, sides, n)
    doc = a["doc"].to_numpy()[pair["a"]]
    coded = pa.array((a["id"].to_numpy(np.int64)[pair["a"]] << 32) | b["id"].to_numpy()[pair["b"]]).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    held, times = np.unique(doc * max(1, len(distinct)) + coded.indices.to_numpy(), return_counts=True)
    figures = [np.bincount(a["doc"], minlength=n), np.bincount(b["doc"], minlength=n), n_groups, np.bincount(doc, minlength=n)]
    return figures, [hashlib.sha256(t).hexdigest() if t else "" for t in texts], distinct, held, times


def _shard(ids: pa.Array, parts: list[tuple]) -> list[pa.Array]:
    """Columns of one shard's row, of the results of its pieces."""
    figures = [np.concatenate(x).astype(np.int64) for x in zip(*(p[0] for p in parts), strict=True)]
    hashes = [h for p in parts for h in p[1]]
    pairs = np.unique(np.concatenate([p[2] for p in parts]))
    per_doc, held, times = [], [], []
    for f, _, distinct, code, n in parts:
        size = max(1, len(distinct))
        per_doc.append(np.bincount(code // size, minlength=len(f[0])))
        held.append(np.searchsorted(pairs, distinct)[code % size] if len(distinct) else code)
        times.append(n)
    held = np.concatenate(held)
    docs = pa.StructArray.from_arrays(
        [ids, *map(pa.array, figures), pa.array(hashes, pa.string())],
        names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), docs),
            pa.array([pairs], pa.list_(pa.int64())),
            pa.array([np.bincount(held, minlength=len(pairs))], pa.list_(pa.int64())),
            pa.array([_packed(np.concatenate(per_doc), held, np.concatenate(times))], pa.binary())]


def links(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          shard_bytes: int = SHARD_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row a shard: (shard, docs, pairs, held_by, held).

    `pairs` are the shard's distinct linked id pairs (A id * 2^32 + B id),
    `held_by` the number of its documents with each; `held` packs the number of
    pairs of each document, then their places in `pairs`, then how often each
    is linked there.  A shard's number is that of its task and its place in it,
    so all rows of a table must come from one job.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = byte_side(path_a), piece_side(path_b)
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            for i, j in pieces(off, shard_bytes):
                led, to = _blank_first(data[off[i]:off[j]], off[i:j + 1] - off[i])
                encoded = Encoded(led, to, sides)
                parts = [piece_links(led[to[k]:to[m]], to[k:m + 1] - to[k], sides, encoded, int(to[k]))
                         for k, m in pieces(to, piece_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array([shard]), *_shard(batch.column(0).slice(i, j - i), parts)],
                                                 names=["shard", "docs", "pairs", "held_by", "held"])
                shard += 1

    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                       f"shard long, docs array<struct<id:{kind},n_a:long,n_b:long,n_groups:long,n_links:long,"
                       "groups_sha256:string>>, pairs array<long>, held_by array<long>, held binary")


def pair_counts(shards: DataFrame) -> DataFrame:
    """(pair, n, is_best): documents that hold a pair, and whether no pair of
    the same A id is held by more."""
    counts = (shards.select(F.explode(F.arrays_zip("pairs", "held_by")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held_by").alias("n"))
              .withColumn("a", F.shiftright("pair", 32)))
    best = counts.groupBy("a").agg(F.max("n").alias("best"))
    return counts.join(best, "a").select("pair", "n", (F.col("n") == F.col("best")).alias("is_best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          shard_bytes: int = SHARD_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment-shards")
    links(docs, path_a, path_b, id_col, text_col, shard_bytes, piece_bytes).write.parquet(path)
    shards = spark.read.parquet(path)
    wanted = shards.select("shard", F.posexplode("pairs").alias("place", "pair"))
    back = (wanted.join(pair_counts(shards), "pair").groupBy("shard")
            .agg(F.array_sort(F.collect_list(F.struct("place", "n", "is_best"))).alias("counts"))
            .select("shard", "counts.n", "counts.is_best"))
    joined = shards.select("shard", "docs", "held").join(back, "shard", "left").select("docs", "held", "n", "is_best")
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                figures = batch.column(0).slice(k, 1).flatten()
                flat = _unpacked(batch.column(1)[k].as_py())
                n_docs = len(figures)
                rows = (len(flat) - n_docs) // 2
                doc = np.repeat(np.arange(n_docs), flat[:n_docs])
                pair, times = flat[n_docs:n_docs + rows], flat[n_docs + rows:]
                n = batch.column(2).slice(k, 1).flatten().to_numpy()
                best = batch.column(3).slice(k, 1).flatten().to_numpy(zero_copy_only=False)
                n_best, total = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
                np.add.at(n_best, doc, times * best[pair] if rows else 0)
                np.add.at(total, doc, times * n[pair] if rows else 0)
                yield pa.RecordBatch.from_arrays(
                    [*figures.flatten()[:5], pa.array(n_best), pa.array(total), figures.flatten()[5]],
                    names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return map_batches(joined, run, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                    "n_best long, count_sum long, groups_sha256 string")
