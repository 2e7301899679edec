"""Every named query against its SQL twin."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from tallyrank.plans import oracle, registry

_QUERIES = registry.queries()
_SQL = oracle.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duckdb_tables(sf_dir)


def test_every_query_has_a_twin():
    assert set(_QUERIES) == set(_SQL)


@pytest.mark.parametrize("name", sorted(_SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare.differences(_QUERIES[name](spark, sf_dir), con, _SQL[name]) == []


def test_all_are_registered():
    assert set(_QUERIES) <= set(contract.queries())
    assert set(_SQL) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark, sf_dir):
    assert contract.entry(spark).count() > 0
