import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lm
from strata.llm.langid import grams


def text(r, n):
    return r.choice([" ", "\n"]).join(r.choice(["the", "house", "Red", "isé", "x%d" % r.randint(0, 30)]) for _ in range(n))


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


@pytest.mark.parametrize("max_common", [lm.MAX_COMMON, 20, 1])
def test_base_score_equals_brute_force(spark, max_common):
    r = random.Random(max_common)
    rows = [(i, text(r, r.randint(0, 40)), i % 3 == 0) for i in range(60)]
    rows += [(70, None, False), (71, "", True), (72, "unseen words here", True), (73, rows[1][1], False), (73, rows[1][1], False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").withColumn("score", F.lit("x")).repartition(3)
    out = lm.score(df, F.col("held"), tune_bytes=2000, max_common=max_common)
    assert out.columns == ["doc_id", "held", *lm.ADDED]
    c = Counter(w for _, t, h in rows if not h for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)),
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t, _ in rows)
    got = out.collect()
    assert sorted((x.doc_id, x.n_tokens, x.n_known, round(x.base_score, 6)) for x in got) == want
    assert all(x.train_tokens == n and x.score < 0 for x in got)


def marked(t):
    return t.encode() + bytes([lm.END])


def contexts(b, i):
    """(order, context, node, bit) of the 8 bits of byte i of b, for every predictor."""
    padded = bytes(lm.ORDER) + b
    for bit in range(8):
        node = (1 << bit) | (b[i] >> (8 - bit))
        yield [((k, padded[i + lm.ORDER - k:i + lm.ORDER], node), (b[i] >> (7 - bit)) & 1) for k in range(lm.ORDER + 1)]


def plain_counts(docs):
    out = {}
    for t in docs:
        b = marked(t)
        for i in range(len(b)):
            for bits in contexts(b, i):
                for key, bit in bits:
                    out.setdefault(key, [0, 0])[bit] += 1
    return out


class Plain:
    """The mixer bit by bit, in plain numbers."""

    def __init__(self, mixer):
        self.by_known, self.by_byte, self.curve = (x.astype(float) for x in (mixer.by_known, mixer.by_byte, mixer.curve))

    def step(self, bits, number, before, counts, own):
        x, known = [], 0
        for k, (key, bit) in enumerate(bits):
            n = list(counts.get(key, [0, 0]))
            n[bit] -= own
            x.append(max(-lm.CLIP, min(lm.CLIP, math.log((n[1] + lm.DELTA) / (n[0] + lm.DELTA)))))
            known = k + 1 if sum(n) >= lm.KNOWN else known
        gate, node = known * 8 + number, bits[0][0][2]
        mixed = max(-lm.CLIP, min(lm.CLIP, sum(v * (self.by_known[gate, k] + self.by_byte[before, k]) for k, v in enumerate(x))))
        place = (mixed + lm.CLIP) * (lm.CURVE - 1) / (2 * lm.CLIP)
        left = min(int(place), lm.CURVE - 2)
        share = place - left
        curve = self.curve[node, left] * (1 - share) + self.curve[node, left + 1] * share
        squashed = 1 / (1 + math.exp(-mixed))
        return x, gate, node, squashed, max(2 ** -18, min(1 - 2 ** -18, (squashed + curve) / 2)), left, share

    def bits(self, t, counts):
        b, total = marked(t), 0.0
        for i in range(len(b)):
            for number, bits in enumerate(contexts(b, i)):
                p = self.step(bits, number, b[i - 1] if i else 0, counts, 0)[4]
                total -= math.log2(p if bits[0][1] else 1 - p)
        return total

    def learn(self, docs, counts, chunk=128, rate=0.005, curve_rate=0.02):
        every = [(b, i) for b in map(marked, docs) for i in range(len(b))]
        for first in range(0, len(every), chunk):
            moves, points = {}, ({}, {})  # left ends move first, then right ends
            for b, i in every[first:first + chunk]:
                before = b[i - 1] if i else 0
                for number, bits in enumerate(contexts(b, i)):
                    x, gate, node, squashed, _, left, share = self.step(bits, number, before, counts, 1)
                    y = bits[0][1]
                    for table, key in (("by_known", gate), ("by_byte", before)):
                        moves.setdefault((table, key), []).append([rate / (1 + first / 200_000) * (y - squashed) * v for v in x])
                    for side, part in ((0, 1 - share), (1, share)):
                        points[side].setdefault((node, left + side), []).append((curve_rate * part, y))
            for (table, key), steps in moves.items():
                getattr(self, table)[key] += np.sum(steps, axis=0) / math.sqrt(len(steps))
            for side in points:
                for at, steps in side.items():
                    self.curve[at] += sum(r * (y - self.curve[at]) for r, y in steps) / max(1, sum(r for r, _ in steps))


def codes_of(docs):
    raw = [t.encode() for t in docs]
    return grams(*lm.with_end(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])), lm.ORDER + 1)


def counts_of(code):
    """(distinct strings, their bit counts)."""
    distinct, n = np.unique(code, return_counts=True)
    short, total = np.unique(distinct & np.uint64((1 << 8 * (lm.LOW + 1)) - 1), return_inverse=True)
    return distinct, lm.all_counts(distinct, n, lm.Low(short, np.bincount(total, weights=n)))


def test_counts_are_those_of_every_context_and_learning_is_plain():
    r = random.Random(2)
    docs = [text(r, 12) for _ in range(6)] + ["", "é", "漢字 é"]
    want, code = plain_counts(docs), codes_of(docs)
    distinct, counts = counts_of(code)
    place = {int(c): i for i, c in enumerate(distinct)}
    for t in docs:
        b = marked(t)
        for i in range(len(b)):
            at = place[int.from_bytes(b[max(0, i - lm.ORDER):i + 1], "big")]
            for number, bits in enumerate(contexts(b, i)):
                assert [counts[:, at, number, k].tolist() for k in range(lm.ORDER + 1)] == [want[key] for key, _ in bits]
    mixer = lm.Mixer()
    plain = Plain(mixer)
    mixer.learn_online(code, counts, np.searchsorted(distinct, code))
    plain.learn(docs, want)
    for name in ("by_known", "by_byte", "curve"):
        np.testing.assert_allclose(getattr(mixer, name), getattr(plain, name), atol=2e-4)


@pytest.mark.parametrize("chunk", [lm.CHUNK, 64])
def test_score_equals_plain_bit_by_bit(spark, monkeypatch, chunk):
    """Counts from all training texts, every bit of every text, whatever the shards and slices."""
    r = random.Random(chunk)
    monkeypatch.setattr(lm, "CHUNK", chunk)
    rows = [(i, text(r, r.randint(0, 25)), i % 4 == 0) for i in range(40)]
    rows += [(50, None, False), (51, "", True), (52, "Überraschung 漢字", True), (53, rows[1][1], False), (53, rows[1][1], False)]
    models, learn = [], lm.learn
    monkeypatch.setattr(lm, "learn", lambda *a: models.append(learn(*a)) or models[0])
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(5)
    got = {x.doc_id: x for x in lm.score(df, F.col("held"), tune_bytes=2000).collect()}
    counts, plain = plain_counts([t or "" for _, t, h in rows if not h]), Plain(models[0].mixer)
    assert models[0].mixer.trained
    for i, t, _ in rows:
        bits = plain.bits(t or "", counts)
        assert got[i].score == pytest.approx(-bits * math.log10(2), rel=1e-4)
        assert got[i].bits_per_byte == pytest.approx(bits / max(1, len((t or "").encode())), rel=1e-4)


def test_counts_of_many_contexts_are_kept_apart():
    """More contexts of full length than 2^21: each has its own counts."""
    r = np.random.default_rng(3)
    code = np.unique(r.integers(0, 1 << 48, 2_300_000, dtype=np.uint64) & np.uint64(0xFFFFFF000FFF))
    key = np.sort(lm.turned(code))
    n = r.integers(1, 9, len(key)).astype(float)
    assert len(np.unique(key >> np.uint64(8))) > 1 << 21
    counts = lm.bit_counts(key, n)
    context, back = np.unique(key >> np.uint64(8), return_inverse=True)
    np.testing.assert_array_equal(counts[:, :, 0].sum(axis=0), np.bincount(back, weights=n)[back])
    alone = np.bincount(back)[back] == 1
    bits = lm.bits_of(key)
    assert alone.mean() > 0.9
    np.testing.assert_array_equal(counts[1][alone], (bits * n[:, None])[alone])
    np.testing.assert_array_equal(counts[0][alone], ((1 - bits) * n[:, None])[alone])


def test_probabilities_add_up_and_lookup_is_exact():
    r = random.Random(4)
    code = codes_of([text(r, 200) for _ in range(20)])
    distinct, counts = counts_of(code)
    mixer = lm.Mixer()
    mixer.learn_online(code, counts, np.searchsorted(distinct, code))
    every = np.unique(np.concatenate([code, *((np.uint64(c) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
                                              for c in (0, 0x20746865, 0x68652068, 0xFFFFFFFF))]))
    n = np.zeros(len(every))
    n[np.searchsorted(every, distinct)] = np.unique(code, return_counts=True)[1]
    short, back = np.unique(every & np.uint64((1 << 8 * (lm.LOW + 1)) - 1), return_inverse=True)
    bits = mixer.code_lengths(every, lm.all_counts(every, n, lm.Low(short, np.bincount(back, weights=n))))
    for context in (0, 0x20746865, 0x68652068, 0xFFFFFFFF):
        assert abs(np.exp2(-bits[every >> np.uint64(8) == context]).sum() - 1) < 1e-6
    lookup = lm.Lookup(every, bits)
    np.testing.assert_array_equal(lookup[code], bits[np.searchsorted(every, code)])


@pytest.mark.parametrize("copies,tune_bytes", [(1, 2000), (1, 50_000), (500, 1000)])
def test_long_or_copied_texts_alone_train_the_mixer(spark, copies, tune_bytes):
    r = random.Random(5)
    train = text(r, 15_000 if copies == 1 else 100).replace("\n", " ")
    new = text(r, 100).replace("\n", " ")
    rows = [(i, train, False) for i in range(copies)] + [(-1, new, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    got = {x.doc_id: x.bits_per_byte for x in lm.score(df, F.col("held"), tune_bytes=tune_bytes).collect()}
    assert got[-1] < 3.0


def test_tuning_grows_with_the_texts(spark, monkeypatch):
    r = random.Random(6)
    df = spark.createDataFrame([(text(r, 300),) for _ in range(200)], "text string").repartition(3)
    shapes = []
    monkeypatch.setattr(lm, "TUNE_ONE_IN", 4)
    asked = lm._stretches
    monkeypatch.setattr(lm, "_stretches", lambda below: shapes.append(below / 2 ** 64) or asked(below))
    lm.score(df, F.lit(False), tune_bytes=10_000).collect()
    assert shapes[0] == pytest.approx(0.25, rel=1e-3)


@pytest.mark.parametrize("tune_bytes", [200, 20_000])
def test_weights_and_curves_learn_from_every_training_byte(spark, monkeypatch, tune_bytes):
    """What is learned from are all bits of all different training texts, however few the online pass takes."""
    r = random.Random(8)
    rows = [(i, text(r, r.randint(0, 25)), i % 4 == 0) for i in range(40)] + [(50, None, False), (51, "copy é", False), (52, "copy é", False)]
    seen, move = [], lm.Mixer.move

    def moved(mixer, total):
        seen.append((Plain(mixer), total))
        move(mixer, total)

    monkeypatch.setattr(lm.Mixer, "move", moved)
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(5)
    lm.score(df, F.col("held"), tune_bytes=tune_bytes)
    docs = [t or "" for _, t, h in rows if not h]
    counts, size = plain_counts(docs), sum(len(marked(t)) for t in set(docs))
    (plain, total), = seen
    want = np.zeros_like(total)
    for b in map(marked, set(docs)):
        for i in range(len(b)):
            for number, bits in enumerate(contexts(b, i)):
                before, y = b[i - 1] if i else 0, bits[0][1]
                x, gate, node, p, _, left, share = plain.step(bits, number, before, counts, 1)
                sums = [(y - p) * v for v in x] + [p * (1 - p) * x[j] * x[k] for j in range(len(x)) for k in range(j, len(x))]
                want[:, gate * 256 + before] += sums
                for at, part in ((left, 1 - share), (left + 1, share)):
                    want[:2, lm.PAIRS + node * lm.CURVE + at] += part, part * y
    np.testing.assert_allclose(total, want, rtol=1e-3, atol=2e-2)
    assert total[0, lm.PAIRS:].sum() == pytest.approx(8 * size)


def test_the_start_too_takes_every_training_byte(spark, monkeypatch):
    """No stretch is chosen: the sums of both steps are over all places of the different texts."""
    r = random.Random(9)
    rows = [(i, text(r, 300), i % 4 == 0) for i in range(40)] + [(50, "copy é", False), (51, "copy é", False)]
    places = []
    for name in ("begin", "move"):
        step = getattr(lm.Mixer, name, None)
        monkeypatch.setattr(lm.Mixer, name, lambda self, total, step=step: places.append(total[0, lm.PAIRS:].sum()) or step(self, total), raising=False)
    monkeypatch.setattr(lm, "_stretches", lambda below: pytest.fail("a share of the texts"))
    lm.score(spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(5), F.col("held"), tune_bytes=200)
    size = sum(len(marked(t)) for t in {t for _, t, h in rows if not h})
    assert places == [pytest.approx(8 * size)] * 2


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abc", True)], "doc_id long, text string, held boolean")
    x = lm.score(df, F.col("held")).first()
    assert (x.n_tokens, x.n_known, x.train_tokens, x.base_score) == (2, 0, 0, 0.0)
    assert abs(x.score + 32 * math.log10(2)) < 1e-9
    assert lm.score(df.limit(0), F.col("held")).collect() == []
