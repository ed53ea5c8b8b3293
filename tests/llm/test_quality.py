import random
import re
from collections import Counter

import pytest

from strata.llm import quality


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(win)
    hit = {j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def make(seed):
    r = random.Random(seed)
    say = lambda n: r.choice([" ", "\n", " \t", "\x0b"]).join(r.choice(["a", "bé", "c#", "<d>", "漢"]) for _ in range(n))
    texts = [say(r.randint(0, 60)) for _ in range(60)]
    texts += [say(12) + "\n" + say(3) + "\n" + texts[i] + " " + texts[i] for i in range(20)]
    texts += ["", None, " \n ", "x " * 8, "x " * 9, "x " * 500, "one\r\ntwo\r\none\r\n", "a b c"]
    return [(i, t, r.choice(["h1", "h2", None])) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_features(spark, seed):
    rows = make(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in quality.features(df).collect()}
    assert got == {i: plain(t) for i, t, _ in rows}


def test_host_verdicts(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    noisy = clean.replace(" ", " ### ")
    rows = [(i, clean if i % 10 else noisy, "good") for i in range(100)]
    rows += [(200 + i, noisy if i % 10 else clean, "bad") for i in range(100)]
    rows += [(400, noisy, "tiny"), (401, clean, None), (402, None, "bad"), (402, None, "bad")]
    df = spark.createDataFrame([(*x, "y") for x in rows], "doc_id long, text string, source string, kept string")
    out = quality.judge(df)
    assert "text" not in out.columns and out.columns.count("kept") == 1
    got = {r.doc_id: r.kept for r in out.collect()}
    assert all(got[i] for i in range(100))
    assert [i for i in range(200, 300) if got[i]] == [i for i in range(200, 300) if i % 10 == 0]
    assert got[401] and not got[402] and out.count() == len(rows)


def test_same_rate_everywhere_and_empty_table(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(1, clean, "a"), (2, clean, "b")], "doc_id long, text string, source string")
    assert all(r.kept for r in quality.judge(df).collect())
    assert quality.judge(df.limit(0)).collect() == []


def test_native_plan(spark):
    df = spark.createDataFrame(make(1), "doc_id long, text string, source string")
    plan = quality.features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
