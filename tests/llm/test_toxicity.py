import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import toxicity as tx


def sentence(r, n=30):
    return " ".join("".join(r.choice("abcdefgé") for _ in range(r.randint(1, 7))) for _ in range(n))


def plain(texts):
    """Sets of (text, feature) from Python strings."""
    out = set()
    for i, t in enumerate(texts):
        for w in t.translate(tx.ALNUM_WORDS).split():
            out.add((i, b"w" + w))
            out.update((i, w[:k]) for k in tx.PREFIXES if len(w) >= k)
    return out


def test_features_are_words_and_beginnings():
    r = random.Random(1)
    texts = [sentence(r, n).encode() for n in (0, 1, 20, 3, 50)] + [b"", b"...", b"abcdefghij", "Éa-b1 Zz".encode()]
    off = np.cumsum([0, *map(len, texts)])
    doc, place = tx.features(np.frombuffer(b"".join(texts), np.uint8), off)
    want = plain(texts)
    assert len({*zip(doc.tolist(), place.tolist())}) == len(want)
    # The same features in another batch have the same places.
    again = tx.features(np.frombuffer(b"zz " + texts[2], np.uint8), np.array([0, 3, 3 + len(texts[2])]))
    assert sorted(again[1][again[0] == 1]) == sorted(place[doc == 2])


def test_counterfactual_penalty_takes_weight_from_identity_terms():
    r = random.Random(3)
    texts, y = [], []
    for i in range(1200):
        toxic = i % 3 == 0
        t = sentence(r)
        if toxic:
            t += " scumbag"
        if r.random() < (.7 if toxic else .1):
            t += " muslim"
        texts.append(t.encode())
        y.append(int(toxic and r.random() < .95))
    rows = [tx._places(t) for t in texts]
    swapped = [None if (s := tx.swap_identity(t)) is None else tx._places(s) for t in texts]
    neutral = np.frombuffer(b"a muslim neighbour", np.uint8)
    off = np.array([0, len(neutral)])
    plain_, fair = tx.fit(rows, swapped, np.array(y), penalty=0.0), tx.fit(rows, swapped, np.array(y), penalty=10.0)
    base = np.frombuffer(b"a neighbour", np.uint8)
    lift = [m.logits(neutral, off)[0] - m.logits(base, np.array([0, len(base)]))[0] for m in (plain_, fair)]
    assert abs(lift[1]) < 0.25 * abs(lift[0])
    bad = np.frombuffer(b"you scumbag", np.uint8)
    assert tx.sigmoid(fair.logits(bad, np.array([0, len(bad)])))[0] > 0.5


def test_held_out_accuracy_and_odd_rows(spark):
    r = random.Random(5)
    rows = [(i, sentence(r) + (" " + r.choice(["idiot", "scum", "MORON!"]) if i % 4 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400)] + [(401, None)], "doc_id long, toxic int")
    model = tx.learn(docs, labels)
    out = tx.score(docs.union(spark.createDataFrame([(900, None, ""), (901, "", ""), (901, "", "")], docs.schema)), model)
    assert out.columns == ["doc_id", "score", "predicted"]
    got = [(x.doc_id, x.predicted) for x in out.collect()]
    held = [(i, p) for i, p in got if 400 <= i < 600]
    assert all(p == int(i % 4 == 0) for i, p in held) and len(held) == 200
    assert [p for i, p in got if i >= 900] == [0, 0, 0]


def test_no_labels_one_class_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x y"), (2, "z")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in tx.score(docs, tx.learn(docs, none)).collect()] == [0, 0]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [r.predicted for r in tx.score(docs, tx.learn(docs, ones)).collect()] == [1, 1]
    assert tx.score(docs.limit(0), tx.learn(docs, ones)).collect() == []
