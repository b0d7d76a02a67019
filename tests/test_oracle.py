"""Every registered query on the smallest data set, against its SQL where it has one."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA
from tests.oracle import compare, connect
from tidemark.plans import catalog

UNWANTED = r"PythonEval|BatchEval|ArrowEval|MapInPandas|FlatMapGroups|CartesianProduct|NestedLoopJoin"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TESTDATA)
    ok, note = compare(df, duck, SQL[name])
    assert ok, note
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(UNWANTED, text), "Python or a cross join in the plan"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, TESTDATA).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and {"series_id", "d", "price_lag7"} <= set(df.columns)
