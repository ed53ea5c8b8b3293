"""License scans: Aho-Corasick notices and licence expressions (operator 2).

Texts are written as lower-cased words with single blanks; an Aho-Corasick
automaton finds every place where the words of a notice phrase, or of the
identifier tag, stand consecutively.  Where the tag occurs, the raw text after
it is read as a licence expression: a shunting-yard parser with the precedence
WITH over AND over OR turns it into postfix form, which is evaluated to the
licence ids and to a permission value: an id's own value, the smaller of two
joined by AND, the larger of two joined by OR, and a licence WITH an exception
is worth `EXCEPTION` at least.  A malformed expression is read as far as it is
well formed; with nothing well formed it is counted, and names no licence.

Score: 1 - 2^-k with k = places of notices + 2 for every expression that could
be read; 0 for a text with neither, near 1 for much evidence.

A null text is empty; repeated rows keep a row each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.arrow import ALNUM_WORDS, map_batches, texts

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases and their labels.
NOTICES = {
    "affero general public license": "agpl",
    "all rights reserved": "all-rights-reserved",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "creative commons": "cc",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "licensed under the apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "the unlicense": "unlicense",
}
#: Permission value of a licence id by how it begins; the
#: longest beginning that fits counts, and other ids are worth UNKNOWN.
PERMISSION = {
    "0bsd": 1.0, "apache": 1.0, "bsd": 1.0, "bsl": 1.0, "cc0": 1.0, "isc": 1.0, "mit": 1.0, "unlicense": 1.0, "zlib": 1.0,
    "cddl": 0.5, "epl": 0.5, "lgpl": 0.5, "mpl": 0.5,
    "agpl": 0.0, "cc-by-nc": 0.0, "gpl": 0.0,
}
UNKNOWN, EXCEPTION = 0.25, 0.5
TAG = "spdx license identifier"
TAGGED = re.compile(rb"spdx-license-identifier:([ \ta-z0-9.+:()\-]*)")
TOKEN = re.compile(r"[()]|[a-z0-9.+:\-]+")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str]:
    """Postfix form of the longest well-formed beginning ([] if there is none)."""
    done: list[str] = []  # postfix at the last place where all brackets were closed
    output: list[str] = []
    stack: list[str] = []
    operand_next = True

    def flush(above: int) -> None:
        while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= above:
            output.append(stack.pop())

    for token in TOKEN.findall(expression.lower()):
        if operand_next:
            if token == "(":
                stack.append(token)
                continue
            if token == ")" or token in PRECEDENCE:
                break
            output.append(token)
            operand_next = False
        elif token in PRECEDENCE:
            flush(PRECEDENCE[token])
            stack.append(token)
            operand_next = True
            continue
        elif token == ")":
            flush(0)
            if not stack:
                break
            stack.pop()
        else:
            break
        if "(" not in stack:
            done = output + stack[::-1]
    return done


def permission(name: str) -> float:
    fits = [b for b in PERMISSION if name.startswith(b)]
    return PERMISSION[max(fits, key=len)] if fits else UNKNOWN


def evaluate(rpn: list[str]) -> tuple[list[str], float]:
    """(licence ids, permission value) of a postfix expression."""
    stack: list[tuple[set[str], float]] = []
    for token in rpn:
        if token not in PRECEDENCE:
            stack.append(({token}, permission(token)))
            continue
        (ids2, v2), (ids1, v1) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((ids1, max(v1, EXCEPTION)))
        else:
            stack.append((ids1 | ids2, (max if token == "or" else min)(v1, v2)))
    ids, value = stack.pop()
    return sorted(ids), value


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Phrases with a blank at both ends; value: (label, is base, is tag)."""
    a = ahocorasick.Automaton()
    for phrase, label in (BASE | NOTICES).items():
        a.add_word(f" {phrase} ", (len(phrase) + 1, label, phrase in BASE))
    a.add_word(f" {TAG} ", (len(TAG) + 1, None, False))
    a.make_automaton()
    return a


def scan(text: bytes) -> dict:
    """All results for one text."""
    words = text.translate(ALNUM_WORDS).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base: list[int] = []
    base_labels: set[str] = set()
    labels: set[str] = set()
    notices, tagged = 0, False
    for end, (back, label, is_base) in automaton().iter(line):
        if label is None:
            tagged = True
            continue
        notices += 1
        labels.add(label)
        if is_base:
            base.append(end - back)
            base_labels.add(label)
    expressions, values, malformed = [], [], 0
    for match in TAGGED.finditer(text.lower()) if tagged else ():
        rpn = postfix(match[1].decode())
        if not rpn:
            malformed += 1
            continue
        ids, value = evaluate(rpn)
        expressions.append(" ".join(rpn))
        values.append(value)
        labels.update(ids)
    return {
        "n_words": len(words), "n_base": len(base), "n_notices": notices,
        "first_word": line.count(" ", 0, min(base)) if base else None,
        "last_word": line.count(" ", 0, max(base)) if base else None,
        "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)),
        "expressions": expressions, "n_malformed": malformed,
        "permission": min(values) if values else None,
        "score": 1 - 0.5 ** min(60, notices + 2 * len(expressions)),
    }


FIELDS = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("n_notices", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("expressions", pa.list_(pa.string())), ("n_malformed", pa.int64()), ("permission", pa.float64()),
    ("score", pa.float64())])
SCHEMA = ("n_words long, n_base long, n_notices long, first_word long, last_word long, base_labels string, "
          "labels string, expressions array<string>, n_malformed long, permission double, score double")


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows of `docs` without the text, with the results of `scan`.

    `expressions` are in postfix form, `permission` is the least value of
    them.  Columns of `docs` with the names of results are replaced.
    """
    own = [c for c in docs.columns if c not in (*FIELDS.names, text_col)]
    rows = docs.select(F.struct(*own).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([f[x.name] for f in found], x.type) for x in FIELDS]],
                names=["row", *FIELDS.names])

    kind = rows.schema["row"].dataType.simpleString()
    return map_batches(rows, run, f"row {kind}, {SCHEMA}").select("row.*", *FIELDS.names)
