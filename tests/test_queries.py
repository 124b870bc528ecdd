"""Every registered query with a SQL counterpart gives the same rows, types and values."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con.execute(entry.oracle_sql()[name]).df()) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 8


def test_sql_belongs_to_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 91
