"""Every registered query against its DuckDB oracle (sf0.001), like the driver."""

import pytest

import __spark_entry__ as E
from flightlake.oracle import ORACLE
from flightlake.queries import QUERIES
from tools.oracle_check import compare, duck

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["OP_CARRIER", "Origin", "Dest"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    ok, msg = compare(name, QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert ok, msg
