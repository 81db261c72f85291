"""Every named query against its SQL twin on the smallest tables."""

import pytest
from compare import difference, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries
from shelfspark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, queries()[name], oracle_sql()[name], SF) is None


def test_entry(spark):
    assert entry(spark).count() == 1
