"""Every registered query against its SQL twin on the smallest test data."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tidemart.testbed.registry import QUERIES
from tests.check import compare, connect
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# queries without a twin are compared with brute force in tests of their own
@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_every_retail_query_has_a_twin():
    assert QUERIES and QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["state", "revenue", "orders"] and df.count() == 15
