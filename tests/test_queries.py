"""Every query of the catalog against DuckDB on the smallest driver tables."""

import compare
import pytest

import __spark_entry__ as contract
from tradeloom.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == []


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
