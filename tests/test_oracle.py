"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle.queries import ORACLE as BASE_ORACLE
from strata.queries import QUERIES as BASE_QUERIES
from tools.compare import TABLES, canon

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
QUERIES = BASE_QUERIES
ORACLE = BASE_ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got_cols, got = df.columns, df.collect()
    res = con.sql(ORACLE[name])
    exp_cols, exp = res.columns, res.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert canon(got_cols, got) == canon(exp_cols, exp)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_sales" in df.columns
