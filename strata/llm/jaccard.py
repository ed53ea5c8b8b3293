"""N-gram Jaccard join through a token-group matrix (operator 11).

A document's set are its distinct `shingle_words`-word shingles (XXH64 of the
words, mixed to 64 bits); a shorter text is one shingle, a text without words
has none and links with nothing.  Sets link when their Jaccard similarity is at
least `percent` / 100.  Equal sets are one set from the start, so a group of
copies of any size is one.

Order.  All sets list their tokens in one order: by value, but tokens that many
sets hold come last, the most frequent at the very end (`frequent_tokens`: the
`HEAVY` most frequent, a table of fixed size, counted over all sets).  Two sets
that link share a token among the first few of each; how few follows from their
sizes.  Only those first tokens are rows.

Matrix.  The join goes through groups of similar sets:

1. At each token the sets of one size class meet the one in their middle, whose
   tokens are the most widely held (a star).  Verified stars make preliminary components.
2. The sets of a component are dealt to groups of about `GROUP` members; a set
   without a link is a group by itself.  A column of the matrix is a group: the
   first tokens of its members, and the union of all their tokens, kept as codes
   of two bytes (four in long sets): equal tokens have equal codes, so a bound by
   codes holds.
3. A query set meets the groups of other components by its first tokens.  Of
   two components only the smaller one's sets query.  How many first tokens
   two linked sets share at least follows from their sizes too, so groups with
   fewer in common with the query are left at once; for the others the overlap
   of the query with the group's union bounds its overlap with every member.
   Only groups that reach what a link needs are opened, and their members
   compared one by one.

Components are the smallest ids reachable over the verified links.  Links inside
a preliminary component need no check of their own, so copies with few changes,
however many, cost a star and not all their pairs, and no link between different
components is lost.

Each row of the input keeps its row.  Nulls are empty texts; a null id takes no
part in the smallest id unless there is no other; other columns do not matter;
an empty table gives an empty result.  A long text's set is one row of eight
bytes a token.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.arrow import LOWER, map_batches, pieces, text_buffers
from strata.llm.simhash import components
from strata.llm.suffix_dedup import _mix
from strata.session import Staged, scratch_path

#: Entries of the table of frequent tokens (16 bytes each, sent to all tasks).
HEAVY = 1 << 16
#: Sets of a batch that hold a token, from which on it is counted.
OFTEN = 16
#: Members of a group, about.
GROUP = 32
PIECE_BYTES = 8 << 20
#: Size of the filter of texts to be read again.
FILTER_BITS = 1 << 24
#: Longer sets have codes of four bytes, others of two.
LONG_SET = 4096
_LOWER = np.frombuffer(LOWER, np.uint8)
BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def token_sets(data: np.ndarray, offsets: np.ndarray, shingle_words: int) -> list[np.ndarray]:
    """The set of each text: its distinct tokens by value."""
    from xxhash import xxh64_intdigest

    data = _LOWER[data]
    inside = ~BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges], last[edges - 1] = inside[edges], inside[edges - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        return [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    # The words as strings: bytes between them are left out.
    off = np.concatenate(([0], np.cumsum(stop - start)))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))]).dictionary_encode()
    code = np.array([xxh64_intdigest(w, 42) for w in words.dictionary.to_pylist()], np.uint64)[words.indices.to_numpy()]
    shingle, width = code, 1
    for _ in range(shingle_words - 1):
        # Each step adds the next word to all shingles that go on in the data.
        shingle, width = _mix(shingle[:-1], code[width:]), width + 1
    out = []
    for a, b in zip(*(x.tolist() for x in (lambda p: (p[:-1], p[1:]))(np.searchsorted(start, offsets)))):
        if b - a >= shingle_words:
            out.append(np.unique(shingle[a:b - shingle_words + 1]))
        elif b > a:
            whole = code[a:a + 1]
            for k in range(a + 1, b):
                whole = _mix(whole, code[k:k + 1])
            out.append(_mix(whole, np.array([b - a], np.uint64)))
        else:
            out.append(code[:0])
    return out


def set_id(tokens: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(tokens.tobytes(), 7)).view(np.int64)) if len(tokens) else 0


def _sets_of(column: pa.Array, shingle_words: int) -> Iterator[np.ndarray]:
    data, off = text_buffers(column)
    for i, j in pieces(off, PIECE_BYTES):
        yield from token_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], shingle_words)


def frequent_tokens(docs: DataFrame, shingle_words: int, often: int = OFTEN) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that most sets hold, by value, and their place in the order.

    Every batch counts its distinct sets' tokens and sends those that `often`
    or more hold; the `HEAVY` with the largest sums are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct = {s.tobytes(): s for s in _sets_of(batch.column(0), shingle_words)}
            if distinct:
                token, n = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                kept = n >= often
                yield pa.RecordBatch.from_arrays([pa.array(token[kept].view(np.int64)), pa.array(n[kept])], names=["token", "n"])

    top = (map_batches(docs.select("text"), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(HEAVY).toPandas())
    token = top["token"].to_numpy(np.int64).view(np.uint64)[::-1]
    by_value = np.argsort(token)
    return token[by_value], by_value


def first_tokens(tokens: np.ndarray, percent: int, heavy: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The tokens, first in the order, of which a linked set shares one at least."""
    n = len(tokens)
    if not n:
        return tokens
    count = n - -(-percent * n // 100) + 1
    if not len(heavy):
        return tokens[:count]
    at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
    is_heavy = heavy[at] == tokens
    rare = tokens[~is_heavy]
    if len(rare) >= count:
        return rare[:count]
    often = tokens[is_heavy]
    return np.concatenate((rare, often[np.argsort(place[at[is_heavy]])]))[:count]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))


def _write(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"jaccard-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def described(keyed: DataFrame, shingle_words: int, percent: int, often: int = OFTEN) -> DataFrame:
    """(id, text_hash, n, set, first): the size, id and first tokens of each row's set."""
    heavy, place = frequent_tokens(keyed, shingle_words, often)
    sent = keyed.sparkSession.sparkContext.broadcast((heavy, place))
    kind = dict(keyed.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sent.value
        for batch in batches:
            n, sets, first, seen = [], [], [], set()
            for s in _sets_of(batch.column(2), shingle_words):
                n.append(len(s))
                sets.append(set_id(s))
                # A set's tokens are sent once a batch.
                first.append(None if sets[-1] in seen else first_tokens(s, percent, *order).view(np.int64))
                seen.add(sets[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sets, pa.int64()),
                 pa.array(first, pa.list_(pa.int64()))], names=["id", "text_hash", "n", "set", "first"])

    return map_batches(keyed, run, f"id {kind}, text_hash long, n long, set long, first array<long>")


def text_filter(chosen: DataFrame) -> np.ndarray:
    """A bitmap of `FILTER_BITS` bits with those of the texts' hashes set."""
    place = F.pmod(F.col("text_hash"), F.lit(FILTER_BITS)) + 1  # buckets count from one
    rows = (chosen.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * 4096
        out[at:at + 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def full_sets(staged: Staged, keyed: DataFrame, sets: DataFrame, wanted: DataFrame, shingle_words: int, coded: bool = False) -> DataFrame:
    """(set, tokens): all tokens of the sets in `wanted`, as bytes, or their codes.

    `sets` has (set, text_hash) rows.  One text of each set counts; a bitmap of
    fixed size keeps most others from being read.  Sets and not texts are shuffled.
    """
    chosen = staged.keep(sets.select("set", "text_hash").join(wanted.select("set").distinct(), "set", "left_semi")
                         .groupBy("set").agg(F.min("text_hash").alias("text_hash")).select("text_hash"))
    sent = keyed.sparkSession.sparkContext.broadcast(text_filter(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            text_hash, first = np.unique(batch.column(0).to_numpy(), return_index=True)  # copies of a batch are read once
            at = text_hash % FILTER_BITS
            texts = batch.take(pa.array(first[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]))
            every = list(_sets_of(texts.column(1), shingle_words))
            yield pa.RecordBatch.from_arrays([texts.column(0), pa.array([set_id(s) for s in every], pa.int64()),
                                              pa.array([codes(s) if coded else s.tobytes() for s in every], pa.binary())],
                                             names=["text_hash", "set", "tokens"])

    rows = map_batches(keyed.select("text_hash", "text"), run, "text_hash long, set long, tokens binary")
    return staged.keep(rows.groupBy("text_hash").agg(F.first(F.struct("set", "tokens")).alias("of"))
                       .join(chosen, "text_hash", "left_semi").select("of.*"))


def codes(tokens: np.ndarray) -> bytes:
    """The tokens' upper 2 bytes, of long sets 4, in order, after their number of bytes."""
    wide = len(tokens) > LONG_SET
    return bytes([4 if wide else 2]) + (tokens >> np.uint64(32 if wide else 48)).astype(np.uint32 if wide else np.uint16).tobytes()


def _codes(data: bytes, width: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint32 if data[0] == 4 else np.uint16, offset=1)
    return out >> 16 if width < data[0] else out


def overlap_bound(a: bytes, b: bytes) -> int:
    """So many tokens of `a` at most are among those of `b`, by their codes."""
    width = min(a[0], b[0])
    a, b = _codes(a, width), _codes(b, width)
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


def _overlap(a: bytes, b: bytes) -> int:
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)) if len(a) else 0


def _links(percent: int) -> Callable:
    """Task function: (a, b, tokens of a, tokens of b) to verified links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (2, 3))
            ok = []
            for x, y in zip(a, b, strict=True):
                both = _overlap(x, y)
                ok.append(100 * both >= percent * (len(x) // 8 + len(y) // 8 - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of linked sets."""
    with_b = pairs.join(tokens.select(F.col("set").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    full = with_b.join(tokens.select(F.col("set").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    return map_batches(full.select("a", "b", "tokens_a", "tokens_b"), _links(percent), "a long, b long")


def _fit(n: Column, m: Column, percent: int) -> Column:
    """Sets of these sizes can link."""
    return (100 * F.least(n, m)) >= percent * F.greatest(n, m)


def _shared_least(n: Column, low: Column, high: Column, percent: int) -> Column:
    """So many first tokens are shared at least by linked sets of n and of low to high tokens.

    Up to the end of the first tokens of one of the two, that one misses no more
    tokens than its size exceeds the least overlap.  (One less, for rounding.)
    """
    low, high = F.greatest(low, F.ceil(n * percent / 100)), F.least(high, F.floor(n * 100 / F.lit(percent)))
    overlap = lambda m: F.floor((n + m) * percent / F.lit(100 + percent))
    return F.greatest(F.lit(1), F.least(overlap(low) - F.ceil(n * percent / 100), overlap(high) - F.ceil(high * percent / 100)))


def group_unions(coded: DataFrame, members: DataFrame) -> DataFrame:
    """(group, union): the matrix's columns, the joined codes of each group's members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unions = []
            for sets in batch.column(1).to_pylist():
                width = min(s[0] for s in sets)
                unions.append(bytes([width]) + np.unique(np.concatenate([_codes(s, width) for s in sets]))
                              .astype(np.uint32 if width == 4 else np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(unions, pa.binary())], names=["group", "union"])

    rows = coded.join(members, "set").groupBy("group").agg(F.collect_list("tokens").alias("tokens"))
    return map_batches(rows, run, "group long, union binary")


def qualifying(pairs: DataFrame, coded: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The rows (a, group) of (a, group, q, low) whose bound allows a link.

    A member of `low` tokens or more links with a query of q only if they share
    percent / (100 + percent) of the sum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, low, queries, unions = (batch.column(k).to_pylist() for k in (2, 3, 4, 5))
            ok = [(100 + percent) * overlap_bound(x, u) >= percent * (n + max(m, -(-percent * n // 100)))
                  for n, m, x, u in zip(q, low, queries, unions, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "group"]).filter(pa.array(ok, pa.bool_()))

    rows = (pairs.join(coded.select(F.col("set").alias("a"), "tokens"), "a")
            .join(group_unions(coded, members), "group").select("a", "group", "q", "low", "tokens", "union"))
    return map_batches(rows, run, "a long, group long")


def matrix_candidates(staged: Staged, shared: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """(a, group): queries and groups of larger components with enough first tokens in common.

    `shared` are the rows (token, set, n) of tokens that more sets hold,
    `grouped` (set, comp, size, group); of components of one size the one with
    the smaller id counts as the larger.
    """
    rows = shared.join(grouped, "set")
    mixed = rows.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("token")
    rows = staged.keep(rows.join(mixed, "token", "left_semi"))
    columns = rows.groupBy("token", "group", "comp", "size").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    queries = rows.select("token", F.col("set").alias("a"), F.col("comp").alias("own"), F.col("size").alias("own_size"), F.col("n").alias("q"))
    larger = (F.col("size") > F.col("own_size")) | ((F.col("size") == F.col("own_size")) & (F.col("comp") < F.col("own")))
    fits = _fit(F.col("q"), F.least(F.greatest("q", "low"), F.col("high")), percent)
    # Members at a token may be some of a group's: the widest range decides.
    return (queries.join(columns, "token").where(larger & fits)
            .groupBy("a", "group", "q").agg(F.count("*").alias("common"), F.min("low").alias("low"), F.max("high").alias("high"))
            .where(F.col("common") >= _shared_least(F.col("q"), F.col("low"), F.col("high"), percent)).select("a", "group", "q", "low"))


def shared_tokens(staged: Staged, keyed: DataFrame, percent: int, shingle_words: int, often: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, n, set) of each row, and (token, set, n, holders) of first tokens that more sets hold."""
    with Staged(keyed.sparkSession) as step:
        full = step.keep(described(keyed, shingle_words, percent, often))
        sets = _write(full.select("id", "text_hash", "n", "set"), "sets")
        rows = (full.where("n > 0").select("set", "n", F.explode("first").alias("token"))
                .repartition("token").dropDuplicates(["token", "set"]))
        holders = F.count("*").over(Window.partitionBy("token"))
        return sets, staged.keep(rows.withColumn("holders", holders).where("holders > 1"))


def star_links(staged: Staged, keyed: DataFrame, sets: DataFrame, shared: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """(a, b): sets and the middle ones of their stars, verified."""
    size_class = F.floor(F.log(F.col("n")) / F.lit(float(np.log(100 / percent)) if percent < 100 else 1.0))
    # The set with the largest share of widely held tokens is nearest to all
    # the others that hold them.
    middle = shared.groupBy("set", "n").agg(F.sum(F.log("holders")).alias("held")).select("set", (F.col("held") / F.col("n")).alias("middle"))
    hub = F.max(F.struct("middle", "set", "n")).over(Window.partitionBy("token", "class"))
    placed = shared.select("token", "set", "n", size_class.alias("class")).join(middle, "set").withColumn("hub", hub)

    n, m = F.col("n"), F.col("m")
    # At some tokens another set is the first: half of what is shared will do.
    stars = (placed.where(F.col("hub.set") != F.col("set"))
             .groupBy(F.col("set").alias("a"), F.col("hub.set").alias("group"), "n", F.col("hub.n").alias("m")).agg(F.count("*").alias("common"))
             .where(_fit(n, m, percent) & (2 * F.col("common") >= _shared_least(n, m, m, percent)))
             .select("a", "group", n.alias("q"), m.alias("low")))
    with Staged(keyed.sparkSession) as step:
        stars = step.keep(stars)
        hubs = stars.select(F.col("group").alias("set")).distinct().withColumn("group", F.col("set"))
        coded = full_sets(step, keyed, sets, hubs.select("set").union(stars.select("a")), shingle_words, coded=True)
        near = step.keep(qualifying(stars, coded, hubs, percent).withColumnRenamed("group", "b"))
        return checked(staged, keyed, sets, near, percent, shingle_words)


def checked(staged: Staged, keyed: DataFrame, sets: DataFrame, pairs: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """The pairs (a, b) of linked sets, by all their tokens."""
    with Staged(keyed.sparkSession) as step:
        tokens = full_sets(step, keyed, sets, pairs.select(F.col("a").alias("set")).union(pairs.select("b")), shingle_words)
        return staged.keep(verified(pairs, tokens, percent))


def matrix_links(staged: Staged, keyed: DataFrame, sets: DataFrame, shared: DataFrame, of_set: DataFrame, percent: int,
                 shingle_words: int) -> DataFrame:
    """(a, b): the links between sets of different preliminary components; `of_set` are (set, comp, size, group)."""
    spark = keyed.sparkSession
    with Staged(spark) as step:
        with Staged(spark) as first:
            queries = step.keep(matrix_candidates(first, shared.select("token", "set", "n"), of_set, percent))
        met = step.keep(of_set.select("set", "group").join(queries.select("group").distinct(), "group", "left_semi"))
        with Staged(spark) as second:
            coded = full_sets(second, keyed, sets, met.select("set").union(queries.select("a")), shingle_words, coded=True)
            opened = step.keep(qualifying(queries, coded, met, percent).join(met.withColumnRenamed("set", "b"), "group").select("a", "b"))
        return checked(staged, keyed, sets, opened, percent, shingle_words)


def jaccard_groups(docs: DataFrame, percent: int = 85, shingle_words: int = 4, id_col: str = "doc_id",
                   text_col: str = "text", often: int = OFTEN, group_size: int = GROUP) -> DataFrame:
    """(id, n_shingles, component_id): one row per row of `docs`."""
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    with Staged(spark) as staged:
        sets, shared = shared_tokens(staged, keyed, percent, shingle_words, often)
        near = star_links(staged, keyed, sets, shared, percent, shingle_words)
        found = components(near, spark).select(F.col("fp").alias("set"), F.col("root").alias("comp"))
        sizes = found.groupBy("comp").agg(F.count("*").alias("size"))
        bucket = F.pmod(F.xxhash64("set"), F.coalesce(F.ceil(F.col("size") / F.lit(group_size)), F.lit(1)))
        of_set = _write(shared.select("set").distinct().join(found.join(sizes, "comp"), "set", "left").select(
            "set", F.coalesce("comp", "set").alias("comp"), F.coalesce("size", F.lit(1)).alias("size"),
            F.xxhash64(F.coalesce("comp", "set"), bucket).alias("group")), "groups")
        far = matrix_links(staged, keyed, sets, shared, of_set, percent, shingle_words)

        # An edge between two preliminary components joins their roots.
        root = of_set.select("set", "comp")
        between = (far.join(root.withColumnsRenamed({"set": "a", "comp": "x"}), "a").join(root.withColumnsRenamed({"set": "b", "comp": "y"}), "b")
                   .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        merged = components(between, spark).select(F.col("fp").alias("comp"), F.col("root").alias("whole"))
    final = root.join(merged, "comp", "left").select("set", F.coalesce("whole", "comp").alias("comp"))
    named = (sets.where("n > 0").groupBy("set").agg(F.min("id").alias("least"))
             .join(final, "set", "left").withColumn("comp", F.coalesce("comp", "set")))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_doc = named.join(names, "comp").select("set", "component_id")
    return (sets.join(of_doc, "set", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
