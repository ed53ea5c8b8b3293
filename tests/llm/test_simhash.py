import random

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash as sh

WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    sh_ = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh_]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(ids, fps, distance):
    """Smallest id reachable, by comparing all pairs."""
    label = list(ids)
    while True:
        new = [min(label[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= distance) for i in range(len(fps))]
        if new == label:
            return label
        label = new


def test_fingerprints():
    r = random.Random(3)
    for n in (0, 1, 2, 3, 4, 9, 200):
        t = r.choice([" ", "\n\t", "\x0b"]).join(r.choice(["Aé", "b", "Zz", "…", "x y"]) for _ in range(n))
        assert sh.fingerprint(t.encode()) == plain(t)


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_groups_equal_brute_force_on_planted_fingerprints(spark, distance, monkeypatch):
    r = random.Random(distance)
    fps = [r.getrandbits(64) for _ in range(60)]
    for _ in range(400):  # chains and clusters around earlier ones
        f = r.choice(fps)
        for b in r.sample(range(64), r.randint(0, distance + 2)):
            f ^= 1 << b
        fps.append(f)
    ids = list(range(len(fps)))
    r.shuffle(ids)
    known = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in zip(ids, fps)], "id long, fp long")
    monkeypatch.setattr(sh, "fingerprints", lambda keyed, n: known.withColumn("text_hash", F.lit(0)))
    docs = spark.createDataFrame([(0, "")], "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.simhash_groups(docs, distance).collect()}
    want = closure(ids, fps, distance)
    assert got == {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, want)}


def test_texts_nulls_copies_and_dedup(spark):
    r = random.Random(8)
    base = [" ".join(r.choice("abcdefghij") + str(r.randint(0, 50)) for _ in range(120)) for _ in range(4)]
    rows = [(i, base[i % 4] if i % 3 else base[i % 4] + f" tail{i}") for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \n"), (None, "alone in the world"), (53, "ab"), (54, "AB"), (54, "AB"), (1, rows[1][1])]
    docs = spark.createDataFrame([(*x, "x") for x in rows], "doc_id long, text string, fp string")
    fps = [plain(t) for _, t in rows]
    want = closure([-1 if i is None else i for i, _ in rows], fps, 3)
    got = sh.simhash_groups(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, -1 if r.component_id is None else r.component_id)
                  for r in got) == sorted((-1 if i is None else i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want))
    kept = sh.simhash_dedup(docs)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(set(want))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sh.simhash_groups(docs).collect() == []
    assert sh.simhash_dedup(docs).collect() == []
