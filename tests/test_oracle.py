"""Every query with SQL gives the same rows as the SQL."""

import pytest

import __spark_entry__ as entry
from rollcall.plans import QUERIES
from compare import connect, difference

ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, con, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
