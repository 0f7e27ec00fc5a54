"""Every registered query at the smallest scale, against its SQL statement where there is one."""

import pytest

import __spark_entry__ as entry_points
from oracle import connection, differences

FOLDER = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(entry_points.queries()[name](spark, FOLDER), con, SQL[name]) == []


# the training-data queries have tests of their own
OWN = {n for n in entry_points.queries() if n == "pipeline" or n[:2] == "op" and n[2].isdigit()}


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(SQL) - OWN))
def test_query_returns_rows(spark, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(entry_points.queries())
