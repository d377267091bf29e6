import duckdb
import pytest

from textloom.llm.registry import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert sorted(tuple(r[i] for i in at) for r in rel.fetchall()) == sorted(tuple(r[c] for c in cols) for r in df.collect())
