import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import mixing

LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"a": 3, "b": 1, "z": 0}, "lang": {"en": 2}, "source": {"s0": 5, "s1": 0}}


def share(children, budget):
    """{child: tokens} by filling children one after the other; children: {name: (cap, weight)}."""
    out, open_ = {n: 0 for n in children}, {n: c for n, c in children.items() if c[1] > 0}
    left = budget
    while open_:
        w = sum(x[1] for x in open_.values())
        full = [n for n, (cap, weight) in open_.items() if cap * w <= weight * left]
        if not full:
            for n, (_, weight) in open_.items():
                out[n] = weight * left // w
            break
        first = min(full, key=lambda n: (open_[n][0] / open_[n][1], n))
        out[first] = open_.pop(first)[0]
        left -= out[first]
    return out


def brute(rows, budget, epochs, seed):
    tokens = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    leaves = defaultdict(list)
    for i, t, *path in rows:
        leaves[tuple(x or "" for x in path)].append((i, tokens(t)))
    cap = {p: epochs * sum(n for _, n in docs) for p, docs in leaves.items()}
    below = lambda prefix: sum(c for p, c in cap.items() if p[:len(prefix)] == prefix)
    budgets = {(): min(budget, below(()))}
    for k in range(3):
        for prefix in [b for b in budgets if len(b) == k]:
            names = {p[k] for p in cap if p[:k] == prefix}
            kids = {n: (below((*prefix, n)), WEIGHTS[LEVELS[k]].get(n, 1)) for n in names}
            for n, b in share(kids, budgets[prefix]).items():
                budgets[(*prefix, n)] = b
    out = []
    for p, docs in leaves.items():
        n, b = sum(x for _, x in docs), budgets[p]
        whole = b // n if n else 0
        rest = b - whole * n
        place = lambda i: hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}".encode()).hexdigest()  # noqa: B023, E731
        total, taken = 0, set()
        for h in sorted({place(i) for i, _ in docs}):
            total += sum(x for i, x in docs if place(i) == h)
            if rest > 0 and total <= rest:
                taken.add(h)
            else:
                break
        out += [(i, *p, x, whole + (place(i) in taken)) for i, x in docs if whole + (place(i) in taken) > 0]
    return sorted(out, key=repr), budgets


def corpus(seed):
    r = random.Random(seed)
    rows = [(i, " ".join("w" * r.randint(1, 5) for _ in range(r.randint(0, 30))), r.choice(["a", "b", "z", None]),
             r.choice(["en", "de", None]), r.choice(["s0", "s0", "s0", "s1", "s2", None])) for i in range(200)]
    return rows + [(300, None, "a", "en", "s0"), (301, "", "b", "de", "s2"), (302, "dup dup", "a", "en", "s0"),
                   (302, "dup dup", "a", "en", "s0"), (None, "no id here", "b", "en", "s2"), (303, "x " * 4000, "b", "en", "s2")]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*x, 1, "e") for x in rows],
                               "doc_id long, text string, domain string, lang string, source string, n_tokens int, epochs string")
    levels = {n: F.col(n) for n in LEVELS}
    return mixing.mix(df.repartition(4), levels, WEIGHTS, seed=7, **kw)


@pytest.mark.parametrize("seed,budget,epochs", [(1, 500, 4), (2, 3000, 1), (3, 9000, 2), (4, 10 ** 7, 3), (5, 0, 2)])
def test_equals_brute_force(spark, seed, budget, epochs):
    rows = corpus(seed)
    out = run(spark, rows, budget_tokens=budget, max_epochs=epochs)
    assert out.columns == ["doc_id", "text", *LEVELS, "n_tokens", "epochs"]
    got = sorted(((r.doc_id, r.domain, r.lang, r.source, r.n_tokens, r.epochs) for r in out.collect()), key=repr)
    want, budgets = brute(rows, budget, epochs, 7)
    assert got == want
    assert sum(r[4] * r[5] for r in got) <= budget
    for k in (1, 2):  # a short leaf's share goes to its siblings before it leaves the parent
        for p in [b for b in budgets if len(b) == k]:
            assert sum(v for q, v in budgets.items() if len(q) == k + 1 and q[:k] == p) <= budgets[p]


def test_shortage_stays_in_the_family(spark):
    rows = [(i, "w " * 10, "a", "en", "s0") for i in range(2)] + [(10 + i, "w " * 10, "a", "en", "s2") for i in range(50)]
    rows += [(100 + i, "w " * 10, "b", "en", "s2") for i in range(50)]
    out = run(spark, rows, budget_tokens=400, max_epochs=1).groupBy("domain", "source").agg(
        F.sum(F.col("n_tokens") * F.col("epochs")).alias("t")).collect()
    # a gets 3/4 of 400; s0 can use 20 of it, its sibling takes the rest.
    assert {(r.domain, r.source): r.t for r in out} == {("a", "s0"): 20, ("a", "s2"): 280, ("b", "s2"): 100}


def test_empty_table_and_pipeline_stage(spark):
    assert run(spark, corpus(1), budget_share=0.5).limit(0).collect() == []
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.mixture(spark, empty, "").collect() == []
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src1", 0), (2, "a b", "en", "other", 3)], empty.schema)
    assert {r.doc_id for r in corpus_pipeline.mixture(spark, odd, "").collect()} <= {None, 1, 2}


def test_native_plan(spark):
    plan = run(spark, corpus(1), budget_share=0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
