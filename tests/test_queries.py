"""Every registered query with SQL, on the smallest tables, next to DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, SF, QUERIES[name], SQL[name], con) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
