"""Every query with a SQL counterpart, compared value by value on the small tables."""

from __future__ import annotations

import pytest
from check import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(name, spark, con, SF)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"column", "auc"}
