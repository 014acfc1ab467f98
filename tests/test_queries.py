"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as entry
from forecastops.plans.catalog import ORACLES as CORE_ORACLES
from forecastops.plans.catalog import QUERIES as CORE_QUERIES

from compare import connect, difference, duck_rows, spark_rows

QUERIES, ORACLES = CORE_QUERIES, CORE_ORACLES


@pytest.fixture(scope="module")
def sf():
    """The size at which every segment has enough rows for the SQL to be defined."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    # no plan pairs all rows of two sides, and none runs rows through Python one by one
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    got = spark_rows(df)
    if name in ORACLES:
        assert difference(got, duck_rows(con, ORACLES[name])) is None
    else:
        assert got[1]


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert not entry.entry(spark).isEmpty()
