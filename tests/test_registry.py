"""Every registered query against its SQL counterpart, bit for bit."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from cartwright.plans import registry

QUERIES = {name: run for name, run in contract.queries().items() if name in registry.QUERIES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def tables():
    return compare.connect(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, tables, name):
    assert compare.differences(QUERIES[name](spark, SMALL), tables, SQL[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
