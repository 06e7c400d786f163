"""Every driver query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from paceforge.workloads.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, tables, name):
    assert difference(entry.queries()[name](spark, SF_DIR), tables, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
