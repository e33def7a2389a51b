"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from marketlens.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(want)


def test_every_operator_has_its_query():
    assert {n.split("_")[0] for n in QUERIES} == {*[f"op{i}" for i in range(1, 14)], "pipeline"}
