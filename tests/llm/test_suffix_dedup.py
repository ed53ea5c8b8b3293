import hashlib
import random

import pytest

from strata.llm import suffix_dedup as sd

LENGTH = 40


def brute(docs, length):
    """{(id, text): (n_removed, n_spans, sha)}; docs in id order."""
    first, out = {}, []
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            first.setdefault(b[s:s + length], (i, s))
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (i, s):
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    passages = [" ".join(word() for _ in range(r.randint(5, 40))) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < .4 else " ".join(word() for _ in range(r.randint(1, 30)))
                 for _ in range(r.randint(0, 6))]
        docs.append((i, r.choice([" ", "\n", ""]).join(parts)))
    docs += [(60 + i, docs[r.randrange(60)][1]) for i in range(10)]
    docs += [(80, "a" * 300), (81, "a" * 39), (82, "ab" * 200), (83, ""), (84, None), (85, "é" * 100)]
    edited = list(docs[3][1] + passages[0] + passages[1])
    edited[len(edited) // 2] = "X"
    docs += [(86, "".join(edited)), (87, docs[3][1] + passages[0] + passages[1])]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 5), (3, 7)])
def test_equals_brute_force(spark, seed, parts):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    assert got(sd.suffix_dedup(df, LENGTH)) == brute(docs, LENGTH)


def test_small_pieces_and_batches(spark, monkeypatch):
    docs = corpus(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
        assert got(sd.suffix_dedup(df, LENGTH)) == brute(docs, LENGTH)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_contract_length_and_kept_text(spark):
    r = random.Random(5)
    p = "".join(r.choice("abcdefghij klmn") for _ in range(130))
    docs = [(1, "x" + p + "y"), (2, p), (3, "ü" + p[:99]), (4, "q" * 20 + p[:100] + "end")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in sd.suffix_dedup(df).collect()}
    assert [out[i].n_removed for i in (1, 2, 3, 4)] == [0, 130, 0, 100]
    assert out[4].kept_text == "q" * 20 + "end" and out[2].kept_text == ""


def test_equal_ids_null_ids_extra_columns_and_empty_table(spark):
    t = "the quick brown fox jumps over the lazy dog again and again today"
    rows = [(5, t, 1, "a"), (5, t, 1, "b"), (None, t, 2, "c"), (7, t, 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long, n_bytes string")
    out = sd.suffix_dedup(df, LENGTH)
    assert out.columns == ["doc_id", "text", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    assert sorted((str(r.doc_id), r.n_removed) for r in out.collect()) == [
        ("5", len(t)), ("5", len(t)), ("7", len(t)), ("None", 0)]
    two = sd.suffix_dedup(df.where("doc_id = 5"), LENGTH)
    assert [r.n_removed for r in two.collect()] == [0, 0]
    assert sd.suffix_dedup(df.limit(0), LENGTH).collect() == []


def test_many_texts_without_an_id(spark):
    r = random.Random(11)
    word = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    passages = [word(90) for _ in range(5)]
    docs = [(None, word(r.randint(0, 250)) + (r.choice(passages) if k % 2 else "") + word(r.randint(0, 90)))
            for k in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = [(-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
            for r in sd.suffix_dedup(df, LENGTH).collect()]
    # Rows of one id are one document: a string is kept at its least start.
    first, want = {}, []
    for _, t in docs:
        for s in range(len(t) - LENGTH + 1):
            g = t[s:s + LENGTH]
            first[g] = min(first.get(g, s), s)
    for _, t in docs:
        gone = {k for s in range(len(t) - LENGTH + 1) if first[t[s:s + LENGTH]] < s for k in range(s, s + LENGTH)}
        kept = "".join(c for k, c in enumerate(t) if k not in gone)
        spans = sum(k - 1 not in gone for k in gone)
        want.append((-1, len(t), len(gone), spans, hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(rows) == sorted(want)


def test_long_text(spark):
    r = random.Random(9)
    t = "".join(r.choice("abcdefgh ") for _ in range(300_000))
    docs = [(1, t), (2, t[1000:250_000]), (3, t[:500] + "Z" + t[:150_000])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(sd.suffix_dedup(df, 100)) == brute(docs, 100)


def test_joined_runs():
    import numpy as np
    r = random.Random(6)
    want, ident, place = set(), [], []
    for doc in range(5):
        at = 0
        for _ in range(400):
            at += r.choice([0, 0, 0, 7])
            n = r.randint(1, 69)
            want.update((doc, s) for s in range(at, at + n))
            ident.append(doc)
            place.append(sd._pack(sd.REPEAT, np.int64(doc * 3), np.int64(at), np.int64(n)))
            at += n
    order = list(range(len(ident)))
    r.shuffle(order)
    ids, places = sd._joined_runs(np.array(ident)[order], np.array(place, np.int64)[order])
    start, run = sd.unpack(places)
    assert run.max() < 1 << sd.RUN_BITS and len(ids) < len(ident) / 2
    assert {(i, s) for i, a, n in zip(ids.tolist(), start.tolist(), run.tolist()) for s in range(a, a + n)} == want
    assert run.sum() == len(want)
