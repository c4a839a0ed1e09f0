"""Each registered query equals its plain SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from talktally import catalog, oracle
from tests.conftest import SF_DIR
from tests.oracle_check import difference, duck_connection

QUERIES = catalog.all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
