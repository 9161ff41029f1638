import pytest

from __spark_entry__ import entry, oracle_sql, queries
from paytrail.plans.queries import QUERIES
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    assert compare(spark, con, name, sf) is None


def test_entry_returns_rows(spark):
    assert entry(spark).limit(1).count() == 1
