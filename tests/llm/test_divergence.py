"""Pointer sort against sorted(), and the audit against a plain version."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import divergence as dv
from strata.llm.arrow import text_buffers
from tests.conftest import rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, min_docs=3, top=200):
    """docs: (text, lang, source) rows."""
    docs = [(TERM.findall(lower(t)), g or "", s or "") for t, g, s in docs]
    out = []
    for lang in {g for _, g, _ in docs}:
        df = Counter(t for w, g, _ in docs if g == lang for t in set(w))
        kept = {t for t, n in df.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for w, g, s in docs:
            if g == lang:
                counts[s].update(t for t in w if t in kept)
                counts[s] = counts[s]
        whole = sum(counts.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        for s, c in counts.items():
            pairs = [(sum((p(c, t) - p(o, t)) ** 2 // p(o, t) for t in kept), b) for b, o in counts.items() if b != s]
            terms = [((p(c, t) - p(whole, t)) ** 2 // p(whole, t), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                for k, (v, i) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]):
                    out.append((lang, s, part, i, v, k + 1))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, lang string, source string"


def run(spark, docs, **kw):
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], SCHEMA)
    return rows(dv.divergence(df, **kw), "lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("slice_size", [1, 7, 1 << 13])
def test_quicksort_is_stable_and_finds_equal_runs(monkeypatch, slice_size):
    monkeypatch.setattr(dv, "SLICE", max(slice_size, 64))
    rng = np.random.default_rng(3)
    words = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefgh" * 3, "abcdefgh" * 3 + "x", "äöü", "日本", "zz" * 40]
    words += ["".join(rng.choice(list("abc"), rng.integers(1, 12))) for _ in range(50)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(40)]
    data = "".join(texts).encode()
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    terms = dv.Pointers(np.frombuffer(data, np.uint8), off)
    spelled = [data[a:a + n] for a, n in zip(terms.start.tolist(), terms.length.tolist())]
    assert spelled == [m.encode() for t in texts for m in TERM.findall(t)]
    order, new = dv.multikey_quicksort(terms, np.arange(len(spelled)))
    assert order.tolist() == sorted(range(len(spelled)), key=lambda k: (spelled[k], k))
    got = [spelled[k] for k in order]
    assert new.tolist() == [k == 0 or got[k] != got[k - 1] for k in range(len(got))]


def test_odd_rows(spark):
    docs = [(None, "en", "a"), ("", "en", "a"), ("The the THE cat", "en", "a"), ("the cat sat", "en", "b"),
            ("the cat sat", "en", "b"), ("dog cat", "en", None), ("1 2 3 --", "de", "x"), ("", "de", "y"),
            ("Ärger ärger Ärger", None, "x"), ("Ärger", None, "y"), ("Ärger", None, None), ("solo solo solo", "fr", "only")]
    assert run(spark, docs) == plain(docs)
    assert run(spark, docs, min_docs=1, top_terms=1) == plain(docs, 1, 1)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_long_text_in_stretches_counts_once(spark):
    text = " ".join(["alpha", "beta", "gamma" * 30, "δέλτα"] * 300)
    docs = [(text, "en", "a"), ("alpha gamma beta", "en", "b"), ("alpha " + "gamma" * 30, "en", "b")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], SCHEMA).coalesce(1)
    counts = lambda size: rows(dv.term_counts(df, shard_bytes=size))
    assert counts(1000) == counts(1 << 22)
    data, _ = text_buffers(__import__("pyarrow").array([text]))
    assert b"".join(bytes(p) for p in dv._stretches(data, 100)) == text.encode()


def test_hot_source_and_extra_columns(spark):
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    docs = [(" ".join(rng.choice(words, 20)), "en", "hot" if k % 3 else f"s{k % 7}") for k in range(300)]
    df = spark.createDataFrame([(i, *d, "x", 1) for i, d in enumerate(docs)], SCHEMA + ", term string, n int")
    assert rows(dv.divergence(df), "lang", "source", "part", "item", "value", "rank") == plain(docs)
