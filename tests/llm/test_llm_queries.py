import oracle
import pytest
from conftest_llm import DATA, needs_data

import __spark_entry__ as contract
from wattweave.llm.queries import QUERIES, SQL


@needs_data()
@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert oracle.compare(QUERIES[name](spark, DATA), oracle.connect(DATA), SQL[name]) == []


@needs_data()
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry_has_the_queries():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
