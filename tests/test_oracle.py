"""Differential check: every registered query against its DuckDB oracle on
sf0.001 (row count, column names, order-insensitive values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
from oracle.queries import SQL
from marketlens.plans.registry import QUERIES as REGISTERED

QUERIES = {n: f for n, f in E.queries().items() if n in REGISTERED}
ORACLE = {n: SQL[n] for n in QUERIES if n in SQL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert canon(got, df.columns) == canon(want, ocols)


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    r = df.collect()
    assert len(r) == 1 and r[0]["total_orders"] > 0
