"""Every registered query against its SQL form on DuckDB."""

import os

import pytest

import __spark_entry__ as contract
import oracle

FOLDER = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")

SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    table = contract.entry(spark)
    assert table.count() > 0
    assert len(table.columns) == len(set(table.columns))
