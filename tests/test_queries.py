"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from duck import assert_same, connect
from tallyloom.plans import registry

# The library's own; tests/llm has those of the subpackage that can be left out.
QUERIES = {name: q for name, q in contract.queries().items() if name in registry.QUERIES}
SQL = {name: q for name, q in contract.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def duck(sf01):
    con = connect(sf01)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, sf01, duck, name):
    n = assert_same(QUERIES[name](spark, sf01), duck, SQL[name])
    assert n > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 35
