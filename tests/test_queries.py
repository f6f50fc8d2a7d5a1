"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck, plan

FOLDER = "/root/testdata/sf0.001"
# the queries of the llm folder have tests of their own
QUERIES = {n: f for n, f in contract.queries().items() if n not in contract.EXTRA_QUERIES}
SQL = {n: s for n, s in contract.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def unwanted(df):
    """Operators of the plan that would not survive a large table."""
    text = plan(df)
    return [n for n in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas") if n in text]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    assert unwanted(df) == []
    assert differences(df, connection, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert unwanted(df) == []
    assert df.collect()


def test_entry(spark):
    assert contract.entry(spark).columns == ["author", "year", "avg_rating"]
