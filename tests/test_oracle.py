"""Every registered query with an SQL equivalent gives the same rows."""

import pytest
from compare import connect, difference

from tillwise.oracles import oracle_sql
from tillwise.registry import queries

QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"rfm_clusters", "forecast_additive", "holdout_additive"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
