"""Every registered query that SQL can express gives the same rows as that SQL in DuckDB."""

import os

import compare
import pytest

import __spark_entry__ as contract
from casebook.catalog.oracles import ORACLES
from casebook.catalog.queries import REGISTERED

FOLDER = compare.DATA / os.environ.get("ORACLE_SF", "sf0.001")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    result = REGISTERED[name](spark, str(FOLDER))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"))
    assert compare.differences(result, ORACLES[name], connection) == []


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_no_query_goes_without_sql():
    assert set(REGISTERED) == set(ORACLES)


def test_every_case_is_scored_with_a_known_label(spark):
    rows = contract.entry(spark)
    assert rows.count() == rows.select("complaint_id").distinct().count() == 1500
    assert rows.where("not known_label").isEmpty()
