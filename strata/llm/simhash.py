"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 6).

Fingerprints: words are the runs of non-blank characters of the lower-cased
text, shingles are `shingle_words` consecutive words joined by a blank (every
repeat counts; a shorter text is one shingle, a text without words has
fingerprint zero).  A bit is 1 if it is set in more than half of the shingles'
XXH64 values (seed 42).

Links: two fingerprints link at `max_distance` or fewer differing bits.  The
shuffle key is a *variant*: a fingerprint with some bits flipped.  If every
fingerprint emits all variants within half the distance (one side rounded up,
the other down), two linked fingerprints meet in a variant, and two that meet
are linked.  Three things keep that small:

* only distinct fingerprints take part, so a group of copies of any size is
  one fingerprint;
* first the same idea is run on the two 32-bit halves: of `d` differing bits
  one half has `d // 2` at most, so a fingerprint none of whose halves is met
  by another's half-ball has no partner and emits nothing more;
* an odd distance needs the larger ball on one side only, and two
  fingerprints at an odd distance have different parity, so only those of even
  parity emit it.

At a variant every member links to the least member of the smaller ball (a
star), never to all others: at most C(64, r) members can meet there, and the
star keeps all of them connected.  Each link is verified by its bit distance.
Components come from least-root propagation with pointer jumping over the links
of distinct fingerprints, checkpointed in the shared folder.

Nulls and empty texts have fingerprint zero and form one group.  Repeated
rows keep one output row each.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.arrow import LOWER, map_batches, texts
from strata.session import materialize


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    from xxhash import xxh64_digest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        return int.from_bytes(xxh64_digest(line, 42), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle_words] + 1))
    hashes = b"".join([xxh64_digest(line[a:b], 42)
                       for a, b in zip(starts.tolist(), ends[shingle_words - 1:].tolist())])
    total = np.zeros(64, np.int64)
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for i in range(0, len(raw), 65536):
        total += np.unpackbits(raw[i:i + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(id, text_hash, fp) of (id, text_hash, text) rows; fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle_words) for t in texts(batch.column(2))),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["id", "text_hash", "fp"])

    kind = dict(docs.dtypes)["id"]
    return map_batches(docs, run, f"id {kind}, text_hash long, fp long")


def flips(bits: range, radius: int) -> np.ndarray:
    """XOR masks of exactly `radius` of the given bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(bits, radius)], np.uint64)


def _ball(radius: int, bits: range = range(64)) -> np.ndarray:
    return np.concatenate([flips(bits, r) for r in range(radius + 1)])


def half_ball_survivors(distinct: DataFrame, max_distance: int) -> DataFrame:
    """Fingerprints of which one half is met by another fingerprint's half.

    A pair within the distance differs in `max_distance // 2` bits at most in
    one of its halves.  Each fingerprint emits the ball of that radius around
    both halves and survives if another one emits its own half.
    """
    radius = max_distance // 2
    ball = _ball(radius, range(32)).astype(np.int64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fps), 2048):
                part = fps[i:i + 2048]
                halves = [(part >> np.uint64(32)).astype(np.int64),
                          (part & np.uint64(0xFFFFFFFF)).astype(np.int64) | (1 << 32)]
                keys = np.concatenate([(h[:, None] ^ ball).ravel() for h in halves])
                yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])

    met = (map_batches(distinct, emit, "key long").groupBy("key").agg(F.count("*").alias("n"))
           .where("n > 1").select("key"))
    centres = distinct.select("fp", F.explode(F.array(
        F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF).bitwiseOR(1 << 32))).alias("key"))
    return centres.join(met, "key", "left_semi").select("fp").distinct()


def ball_links(survivors: DataFrame, max_distance: int) -> DataFrame:
    """Star links (a < b) between distinct fingerprints within the distance."""
    small, large = max_distance // 2, max_distance - max_distance // 2
    inner, outer = _ball(small), _ball(large)[len(_ball(small)):]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            even = np.bitwise_count(fps) % 2 == 0
            for mine, masks, is_inner in ((fps, inner, True), (fps[even], outer, False)):
                step = max(1, 200_000 // max(1, len(masks)))
                for i in range(0, len(mine) if len(masks) else 0, step):
                    part = mine[i:i + step]
                    variants = (part[:, None] ^ masks).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(variants), pa.array(np.repeat(part, len(masks)).view(np.int64)),
                         pa.array(np.full(len(variants), is_inner))],
                        names=["variant", "fp", "is_inner"])

    met = map_batches(survivors, emit, "variant long, fp long, is_inner boolean")
    hub = F.min(F.when(F.col("is_inner"), F.col("fp"))).over(Window.partitionBy("variant"))
    return (met.select("fp", hub.alias("hub")).where("hub is not null and hub != fp")
            .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """(fp, root): the least fingerprint of each linked fingerprint's component.

    Each round a fingerprint takes the least root among itself and its
    neighbours, then the root of that root (pointer jumping), until nothing
    changes.
    """
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), spark)
    state = materialize(both.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("near"))
                        .select("fp", F.least("fp", "near").alias("root")), spark)
    while True:
        near = (both.join(state.withColumnRenamed("fp", "b"), "b")
                .groupBy(F.col("a").alias("fp")).agg(F.min("root").alias("near")))
        hop = (state.join(near, "fp")
               .select("fp", F.col("root").alias("old"), F.least("root", "near").alias("root")))
        jump = state.select(F.col("fp").alias("root"), F.col("root").alias("further"))
        new = materialize(hop.join(jump, "root").select("fp", "old", F.least("root", "further").alias("root")), spark)
        state = new.select("fp", "root")
        if new.where("root < old").limit(1).count() == 0:
            return state


def _grouped(docs: DataFrame, max_distance: int, shingle_words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, fp, root, component_id) of every row, checkpointed."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    fps = materialize(fingerprints(keyed, shingle_words), spark)
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("first")), spark)
    survivors = materialize(half_ball_survivors(distinct.select("fp"), max_distance), spark)
    links = materialize(ball_links(survivors, max_distance), spark)
    rooted = materialize(distinct.join(components(links, spark), "fp", "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")), spark)
    names = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), spark)
    of_fp = materialize(rooted.join(names, "root").select("fp", "root", "component_id"), spark)
    return fps.join(of_fp, "fp")


def simhash_groups(docs: DataFrame, max_distance: int = 3, shingle_words: int = 3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint hex, component_id): one row per row of `docs`."""
    return _grouped(docs, max_distance, shingle_words, id_col, text_col).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, max_distance: int = 3, shingle_words: int = 3,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near-duplicates.

    Of every group the row with the smallest id stays; of rows that share that
    id, the one with the smallest hash of its text, and of equal rows one.
    """
    groups = _grouped(docs, max_distance, shingle_words, id_col, text_col)
    keep = materialize(groups.groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("k"))
                       .select("k.id", "k.text_hash"), docs.sparkSession)
    # One struct as key (its nulls are equal): the join's exchange also serves
    # the last step, so the texts are shuffled once.
    kind = dict(docs.dtypes)[id_col]
    key = F.struct("id", "text_hash").cast(f"struct<id:{kind},text_hash:bigint>").alias("key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    return (rows.select("row", key).join(keep.select(key), "key", "left_semi")
            .dropDuplicates(["key"]).select("row.*"))
