"""Every registered query equals its DuckDB text."""

from __future__ import annotations

import pytest
from parity import difference, duck, oracle_rows, spark_rows

import __spark_entry__ as contract
from lendscope import registry

QUERIES, ORACLE = registry.all_queries(), registry.all_oracles()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal(spark, small, con, name):
    assert difference(spark_rows(QUERIES[name](spark, small)), oracle_rows(con, ORACLE[name])) == ""


def test_entry_is_one_row(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0].active_loan_count > 0
