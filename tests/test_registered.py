"""Every registered query on the smallest tables: its plan, and its rows against its SQL (as the check tool compares)."""

import pytest

import __spark_entry__ as entry_module
from tools.check_oracles import compare, duck

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return duck(SF)


def test_oracles_name_registered_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert rows.count() > 0 and {"listing_id", "composite", "confidence", "dealbreakers"} <= set(rows.columns)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    result = QUERIES[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []  # no all-pairs joins, no Python rows
    if name in ORACLES:
        assert compare(result, database.sql(ORACLES[name])) == []
    else:
        assert result.count() >= 0
