"""Queries that SQL expresses, against their DuckDB text on the smallest tables."""

import pytest

from cirrus.llm import queries
from tools.oracle_check import compare, duck

from .conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, con, key):
    r = compare(spark, con, key, queries.QUERIES[key], queries.ORACLE_SQL[key], SF)
    assert r["status"] == "ok", r
