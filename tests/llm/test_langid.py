import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import langid


def brute(samples, order, text):
    """Code length of a text by walking the contexts of a plain dictionary."""
    tree = defaultdict(Counter)
    for t in samples:
        t = b"\0" * order + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                tree[t[i - k:i]][t[i]] += 1
    bits, t = 0.0, b"\0" * order + text
    for i in range(order, len(t)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8
                break
            c = tree.get(t[i - k:i])
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if t[i] in c:
                bits -= math.log2(c[t[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
    return bits


@pytest.mark.parametrize("order", [1, 2, 4])
def test_code_lengths_equal_a_plain_tree(order):
    r = random.Random(order)
    text = lambda a, n: "".join(r.choice(a) for _ in range(n)).encode()
    samples = {"x": [text("abc ", 200), text("abc ", 3)], "y": [text("aéß ", 150), b"q"], "z": [text("01", 30)]}
    model = langid.Model(samples, order)
    tests = [text("abcéß01 ", n) for n in (0, 1, 2, 3, 5, 17, 60)] + ["漢字 abc".encode(), b"a" * 50]
    off = np.cumsum([0, *map(len, tests)])
    got = model.code_lengths(np.frombuffer(b"".join(tests), np.uint8), off)
    want = [[brute(samples[k], order, t) for k in model.labels] for t in tests]
    np.testing.assert_allclose(got, want, rtol=1e-4)


def test_identify_whole_texts_and_odd_rows(spark):
    r = random.Random(1)
    voc = {"en": ["the", "house", "is", "red"], "de": ["das", "Haus", "ist", "schön"]}
    say = lambda k, n: " ".join(r.choice(voc[k]) for _ in range(n))
    rows = [(i, say(k, 30), k) for i in range(40) for k in ("en", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.labels == ["de", "en"]
    odd = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, "123 !?", "c"), (4, "ö", "d"), (5, say("en", 40000), "e"),
         (6, say("de", 3), None), (6, say("de", 3), None), (7, "…—", "f")], "doc_id long, text string, score string")
    out = langid.identify(odd, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "bits_per_byte"]
    got = sorted((x.doc_id, x.lang_pred) for x in out.collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "en"), (6, "de"), (6, "de"), (7, "und")]
    for x in out.collect():
        assert 0 <= x.score <= 1 and (x.score == 0) == (x.lang_pred == "und")


def test_labels_with_long_texts_or_many_copies_stay(spark, monkeypatch):
    r = random.Random(3)
    say = lambda a, n: " ".join("".join(r.choice(a) for _ in range(4)) for _ in range(n))
    rows = [(say("abcd", 15_000) + " " + say("mnop", 15_000), "long")]
    others = [say("efgh", 400) for _ in range(4)]
    rows += [(others[0], "copies")] * 5000 + [(t, "copies") for t in others[1:]]
    rows += [(say("ijkl", 400), "many") for _ in range(600)]
    learned = {}
    monkeypatch.setattr(langid, "Model", lambda samples, order: learned.update(samples) or "model")
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert langid.learn(docs) == "model"
    assert sorted(learned) == ["copies", "long", "many"]
    assert sorted(learned["copies"]) == sorted(t.encode() for t in others)
    whole, parts = rows[0][0].encode(), learned["long"]
    assert len(parts) == langid.RANGES and sum(map(len, parts)) == 100_000 and all(x in whole for x in parts)
    assert any(b"a" in x for x in parts) and any(b"m" in x for x in parts)
    size = sum(map(len, learned["many"]))
    assert 400_000 <= size < 402_000


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "text string, lang string")
    model = langid.learn(none)
    docs = spark.createDataFrame([("abc",)], "text string")
    assert langid.identify(docs, model).first().lang_pred == "und"
    assert langid.identify(docs.limit(0), model).collect() == []
