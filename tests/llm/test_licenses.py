import random

import pytest
import regex

from strata.llm import licenses as li

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    at = [(i, label) for p, label in li.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    places = [i for i, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))


def test_base_equals_brute_force():
    r = random.Random(4)
    voc = ["MIT", "license", "mit-license", "Apache", "general", "Public", "LICENSE,", "é", "word", "lesser", "mit", "gnu",
           "license!mit license", "xmit"]
    for n in (0, 1, 2, 5, 40, 40, 200):
        t = r.choice([" ", "\n", "--"]).join(r.choice(voc) for _ in range(n))
        s = li.scan(t.encode())
        assert (s["n_words"], s["n_base"], s["first_word"], s["last_word"], s["base_labels"]) == plain(t)
        assert set(filter(None, s["base_labels"].split(","))) <= set(s["labels"].split(",")) and 0 <= s["score"] <= 1


def reference(tokens):
    """Value by recursive descent: or < and < with."""
    def atom():
        if tokens and tokens[0] == "(":
            tokens.pop(0)
            v = either()
            assert tokens.pop(0) == ")"
            return v
        return li.permission(tokens.pop(0))

    def guarded():
        v = atom()
        while tokens and tokens[0] == "with":
            tokens.pop(0)
            atom()
            v = max(v, li.EXCEPTION)
        return v

    def both():
        v = guarded()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            v = min(v, guarded())
        return v

    def either():
        v = both()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            v = max(v, both())
        return v

    return either()


def test_expressions_equal_recursive_descent():
    r = random.Random(2)

    def make(depth):
        if depth == 0 or r.random() < .3:
            return r.choice(["MIT", "GPL-2.0-only", "Apache-2.0", "LGPL-2.1+", "X-1", "MPL-2.0"])
        a, b = make(depth - 1), make(depth - 1)
        op = r.choice([" AND ", " or ", " WITH "])
        return f"{a}{op}{b}" if op != " WITH " and r.random() < .5 else f"({a}){op}" + (b if op != " WITH " else "Some-exception")

    for _ in range(300):
        e = make(4)
        _, value = li.evaluate(li.postfix(e))
        assert value == reference(li.TOKEN.findall(e.lower())), e


@pytest.mark.parametrize("text,ids", [
    ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\nint x;", ["bsd-3-clause", "gpl-2.0-only", "mit"]),
    ("# spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0 */ code", ["gpl-2.0-only"]),
    ("SPDX-License-Identifier: MIT and then other words", ["mit", "then"]),
    ("SPDX-License-Identifier: MIT some other words", ["mit"]),
    ("SPDX-License-Identifier: (MIT OR", []), ("SPDX-License-Identifier: AND", []), ("SPDX License Identifier", [])])
def test_tags(text, ids):
    assert [x for x in li.scan(text.encode())["labels"].split(",") if x] == ids


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (3, "MIT License", "q"), (3, "MIT License", "q"),
                                (4, "w " * 50_000 + "The MIT license", None)], "doc_id long, text string, score string")
    out = li.scan_licenses(df)
    assert out.columns[:2] == ["doc_id", "n_words"] and out.columns.count("score") == 1
    got = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.labels) for r in out.collect())
    assert got == [(1, 0, 0, None, ""), (2, 0, 0, None, ""), (3, 2, 1, 0, "mit"), (3, 2, 1, 0, "mit"), (4, 50003, 1, 50001, "mit")]
    assert li.scan_licenses(df.limit(0)).collect() == []
