"""Every registered query against its oracle on the smallest data set."""

import pytest

import __spark_entry__ as entry
from queries.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) < set(entry.queries())
