"""Every registered query runs; those with SQL equal it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare, connect

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(SQL))
def test_equals_sql(spark, sf_dir, connection, key):
    assert compare(QUERIES[key](spark, sf_dir), connection, SQL[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_model_query_has_rows(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, sf_dir):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["m"] == 1 and rows[0]["accuracy"] > 0.8
