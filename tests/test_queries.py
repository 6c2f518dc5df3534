"""Every query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from compare import assert_same, connect

from ledgersift.workload.oracle import ORACLE as SQL
from ledgersift.workload.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf["sf0.01"])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(name, spark, sf, con):
    assert assert_same(QUERIES[name](spark, sf["sf0.01"]), con, SQL[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
