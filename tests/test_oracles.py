"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import differences, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query(spark, con, key):
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert entry.queries()[key](spark, SF).count() > 0
    else:
        problems = differences(spark, con, SF, entry.queries()[key], sql)
        assert problems == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
