"""Every named query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as contract
from opinara.plans.catalog import CATALOG
from opinara.plans.oracle import ORACLE
from tests.duck import connect, difference

QUERIES, SQL = CATALOG, ORACLE  # the text operators have tests of their own


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, sf, duck, name):
    assert difference(QUERIES[name](spark, sf), duck, SQL[name]) == ""


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 773
