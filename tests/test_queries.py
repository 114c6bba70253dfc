"""Every registered query against its SQL, on the smallest tables."""

import pytest

from compare import connect, difference

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_only_queries_have_sql():
    assert set(ORACLES) <= set(QUERIES)
