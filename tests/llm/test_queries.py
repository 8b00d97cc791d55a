"""The registered queries against their SQL, and their columns."""

from __future__ import annotations

import duckdb
import pytest

from registered.common import TABLES
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(medium):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{medium}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, duck, medium):
    result = QUERIES[name](spark, medium)
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in expected.fetchall()), key=lambda r: repr(sorted(r.items())))
    got = sorted((r.asDict() for r in result.collect()), key=lambda r: repr(sorted(r.items())))
    assert want and got == want


def test_each_operator_has_a_query():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13
