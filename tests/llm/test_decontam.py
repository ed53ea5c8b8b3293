import random

import pytest
import regex

from strata.llm import decontam as dc

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(window, len(v))
            for s in range(len(v) - n + 1 if v else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[s:s + n]:
                        hit.update(range(p, p + n))
                        found.add(item)
        out.append((i, len(w), len(hit), sorted(f for f in found if f is not None)))
    return sorted(out, key=repr)


def make(seed):
    r = random.Random(seed)
    voc = ["a", "Ab", "the", "é1", "x9", "wort", "longerword", "of", "über"]
    sent = lambda n: r.choice([" ", ", ", "-", "\n"]).join(r.choice(voc) for _ in range(n))
    items = [(k, sent(r.choice([1, 2, 4, 5, 9, 12, 20]))) for k in range(14)]
    items += [(50, ""), (51, "..."), (None, sent(6)), (52, items[3][1]), (53, "a")]
    docs = [(i, ". ".join(r.choice([sent(r.randint(1, 30)), r.choice(items)[1].upper()]) for _ in range(r.randint(0, 5))))
            for i in range(40)]
    docs += [(100, None), (101, ""), (102, "§§"), (103, items[5][1]), (103, items[5][1])]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 40), (3, 1 << 20)])
def test_equals_brute_force(spark, seed, block):
    docs, items = make(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = dc.decontaminate(d, b, window=5, block_bytes=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()), key=repr)
    assert got == brute(docs, items, 5)
    for r in out.collect():
        assert sum(h.end - h.start for h in r.hits) == r.n_hit


def test_scan_against_plain_search_with_small_pieces():
    docs, items = make(7)
    enc = lambda t: (t or "").encode()
    s = dc.Searcher([(i, enc(t)) for i, t in items], 3)
    n, ranges, found = s.scan([enc(t) for _, t in docs])
    got = sorted(((i, a, dc._union(b), c) for (i, _), a, b, c in zip(docs, n, ranges, found)), key=repr)
    assert got == brute(docs, items, 3)


def test_empty_tables_and_clashing_columns(spark):
    d = spark.createDataFrame([(1, "one two", "x")], "doc_id long, text string, items string")
    b = spark.createDataFrame([], "item_id long, text string")
    out = dc.decontaminate(d, b)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "hits", "items"]
    assert out.first().asDict() == {"doc_id": 1, "text": "one two", "n_words": 2, "n_hit": 0, "hits": [], "items": []}
    assert dc.decontaminate(d.limit(0), b).collect() == []
