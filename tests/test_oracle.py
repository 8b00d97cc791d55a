"""Every registered query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import duckdb
import pytest

import registered
from __spark_entry__ import entry, oracle_sql, queries
from registered.common import TABLES

QUERIES, ORACLES = registered.queries(), registered.oracles()


@pytest.fixture(scope="module")
def duck(medium):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{medium}/{name}.parquet'")
    return con


def _rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, duck, medium):
    result = QUERIES[name](spark, medium)
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(names)
    want = _rows(expected.fetchall(), names)
    assert len(want) > 0
    assert _rows(result.collect(), result.columns) == want
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "NestedLoopJoin", "Python"))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
