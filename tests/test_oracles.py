"""Every core query against its SQL in DuckDB at the smallest scale."""

import duckdb
import pytest

import __spark_entry__
from textloom.plans.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else str(x) if isinstance(x, (list, dict)) else x


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_duckdb(spark, con, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got == want


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_the_rest_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0
