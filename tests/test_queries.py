"""Every registered query against its SQL over the whole sample tables."""

from __future__ import annotations

import pytest
from compare import differences, oracle_connection
from conftest import FOLDER

import __spark_entry__ as spark_entry
from tablelens.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    _, found = differences(spark, oracle, QUERIES[name], ORACLES[name], FOLDER)
    assert found is None


def test_entry_is_ordered_by_total(spark):
    rows = spark_entry.entry(spark).collect()
    totals = [r["o_totalprice_sum"] for r in rows]
    assert len(rows) == 5 and totals == sorted(totals, reverse=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert unwanted not in plan
