"""The registered queries on the smallest tables."""

import importlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import queries, sql
from tests.llm.test_decontam import words as alnum_words
from tests.llm.test_licenses import plain as plain_licenses
from tests.llm.test_simhash import closure
from tests.llm.test_simhash import plain as plain_fingerprint
from tests.llm.test_suffix_dedup import brute as brute_repeats
from tools.compare import TABLES, canon

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def documents(con):
    return con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canon(df.columns, df.collect()) == canon(want.columns, want.fetchall())


def test_licenses(spark, documents):
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in queries.op2_licenses(spark, SF).collect()}
    assert got == {i: plain_licenses(t or "") for i, t in documents}


def test_simhash(spark, documents):
    fps = [plain_fingerprint(t) for _, t in documents]
    ids = [i for i, _ in documents]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, SF).collect()}
    assert got == {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, closure(ids, fps, 3))}


def test_toxicity_and_language_hold_out(spark, con):
    toxic = dict(con.sql("SELECT doc_id, toxic FROM read_parquet('/root/testdata/sf0.01/labels.parquet')").fetchall())
    rows = [r for r in queries.op3_toxicity(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) >= 0.9 * len(rows)
    lang = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in queries.op8_language(spark, SF).collect() if r.held_out]
    assert rows and sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_lm_scores_held_out_texts(spark, documents):
    rows = queries.op10_lm_score(spark, SF).collect()
    assert len(rows) == len(documents) and any(r.held_out for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.bits_per_byte for r in held) / len(held) < 4.0


def brute_pipeline(con, documents):
    docs = [(i, t) for i, t in documents if t and any(c.isalpha() for c in t)]
    first = closure([i for i, _ in docs], [plain_fingerprint(t) for _, t in docs], 3)
    docs = [d for d, c in zip(docs, first) if d[0] == c]
    gone, seen = [], {}
    for i, t in docs:
        b = t.encode()
        flags = bytearray(len(b))
        for s in range(len(b) - 99):
            if seen.setdefault(b[s:s + 100], (i, s)) != (i, s):
                flags[s:s + 100] = b"\1" * 100
        gone.append(bytes(c for c, f in zip(b, flags) if not f).decode("utf-8", "ignore"))
    docs = [(i, t) for (i, _), t in zip(docs, gone)]
    windows = set()
    for (t,) in con.sql("SELECT text FROM benchmark").fetchall():
        w = alnum_words(t)
        windows.update(tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9)))
    kept = []
    for i, t in docs:
        w = alnum_words(t)
        if not any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            kept.append((i, t))
    c = duckdb.connect()
    c.sql("CREATE TABLE kept (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO kept VALUES (?, ?)", kept)
    c.sql(f"CREATE VIEW documents AS SELECT k.doc_id, k.text, d.lang, d.source FROM kept k "
          f"JOIN read_parquet('{SF}/documents.parquet') d USING (doc_id)")
    picked = c.sql(sql.mix(queries.MIX_WEIGHTS, 0.6, 4, 42)).fetchall()
    texts = dict(kept)
    return sorted((r[0], texts[r[0]], r[5]) for r in picked)


def test_pipeline_equals_brute_force(spark, con, documents):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.text, r.epochs) for r in got.collect()) == brute_pipeline(con, documents)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "passages", "benchmark", "mixture"]


def test_stages_keep_the_columns_of_documents(spark):
    docs = queries.read(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src1", 0), (1, "", "en", "src1", 0),
                                 (2, "a word " * 60, "en", "src2", 420)], docs.schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for part in (odd, odd.limit(0), docs.limit(30)):
            out = stage(spark, part, SF)
            assert out.columns == docs.columns
            assert out.count() <= part.count()


def test_base_library_does_not_import_llm():
    top = os.path.dirname(os.path.dirname(importlib.import_module("strata.llm").__file__))
    for folder, _, names in os.walk(top):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "strata.llm" not in f.read()
    assert brute_repeats([(1, "x" * 250)], 100)[0][2] == 249
