"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
KEYS = sorted(E.catalog.QUERIES)  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(E.oracle_sql()) >= set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF_SMALL)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "avg_temperature"]
    assert df.count() >= 0
