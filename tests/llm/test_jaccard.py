"""Token-group matrix against all pairs of plain sets."""

import re
from pathlib import Path

import duckdb
import numpy as np
import pytest

from strata.llm import jaccard as jc
from strata.llm import queries
from strata.session import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def plain(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    by_size = sorted((i for i in range(len(docs)) if sets[i]), key=lambda i: len(sets[i]))
    for n, i in enumerate(by_size):
        for j in by_size[n + 1:]:
            if 100 * len(sets[i]) < percent * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(docs):
        known = names.get(find(i))
        names[find(i)] = d if known is None else known if d is None else min(known, d)
    return sorted(((d, len(sets[i]), names[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def run(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in jc.jaccard_groups(df, **kw).collect()), key=repr)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "One  TWO\n"), (5, "two one"), (6, "one two three four"),
       (None, "one two three four"), (None, "only me"), (7, "a b c d e"), (8, "a b c d e"), (8, "a b c d e f"), (9, "\x00 é"),
       (10, "x " * 5000), (11, "x " * 4000 + "y")]


def near_copies(seed, families=6, copies=14):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefg"), 4))
    passage = [word() for _ in range(30)]
    docs = []
    for _ in range(families):
        base = [word() for _ in range(int(rng.integers(20, 120)))]
        if rng.random() < 0.7:
            base[5:5] = passage
        for _ in range(copies):
            text = list(base)
            for _ in range(int(rng.integers(0, 5))):
                k = int(rng.integers(0, len(text)))
                if rng.random() < 0.5:
                    text[k] = word()
                else:
                    text[k:k] = [word()] * int(rng.integers(1, 6))
            docs.append(" ".join(text))
    return [(int(i) + 100, t) for i, t in enumerate(rng.permutation(docs))]


def test_odd_texts(spark):
    assert run(spark, ODD) == plain(ODD)


@pytest.mark.parametrize("seed,often,group_size", [(1, 16, 32), (2, 2, 2), (3, 5, 1), (4, 3, 4)])
def test_all_links_are_found(spark, seed, often, group_size):
    docs = near_copies(seed) + ODD
    want = plain(docs)
    assert run(spark, docs, often=often, group_size=group_size) == want
    assert len({c for _, _, c in want}) < len(docs) - 20


def test_other_bounds(spark):
    docs = near_copies(7, 4, 10)
    for percent in (50, 100):
        assert run(spark, docs, percent=percent, often=3, group_size=3) == plain(docs, percent)


def test_no_rows_and_extra_columns(spark):
    df = spark.createDataFrame([(*d, 1, "x") for d in ODD], "doc_id long, text string, n int, tokens string")
    assert jc.jaccard_groups(df.limit(0)).collect() == []
    assert sorted((tuple(r) for r in jc.jaccard_groups(df).collect()), key=repr) == plain(ODD)


def test_first_tokens_follow_one_order():
    heavy, place = np.array([3, 7, 9], np.uint64), np.array([2, 0, 1])
    tokens = np.array([1, 3, 5, 7, 9, 11], np.uint64)
    assert jc.first_tokens(tokens, 1, heavy, place).tolist() == [1, 5, 11, 7, 9, 3]
    assert jc.first_tokens(tokens, 50, heavy, place).tolist() == [1, 5, 11, 7]


def test_query_equals_plain(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM read_parquet('/root/testdata/sf0.01/documents.parquet')").fetchall()
    got = sorted((tuple(r) for r in queries.op11_jaccard(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == plain(docs)


def test_tables_of_finished_steps_are_gone(spark):
    root = Path(shared_dir(spark), "strata")
    before = set(root.iterdir()) if root.exists() else set()
    df = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    out = jc.jaccard_groups(df)
    assert sorted(p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before) == ["jaccard-groups", "jaccard-sets"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(ODD)
