"""Every query against its SQL counterpart in DuckDB, over the same Parquet files."""

from __future__ import annotations

import decimal

import duckdb
import pytest

from tarnhouse.catalogue.all_queries import ORACLE, QUERIES

from .conftest import plan

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Plan nodes that would gather everything in one task, pair everything with everything,
# or hand rows to Python.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "BatchEvalPython", "ArrowEvalPython"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    result = duck.execute(ORACLE[name])
    assert df.columns == [d[0] for d in result.description]
    got = sorted(tuple(map(normal, r)) for r in df.collect())
    want = sorted(tuple(map(normal, r)) for r in result.fetchall())
    assert got == want
    assert got
    text = plan(df)
    assert [node for node in UNWANTED if node in text] == []
