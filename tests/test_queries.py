"""Registered queries on the smallest tables: agreement with SQL, and the shape of the plans."""

import os

import pytest

import __spark_entry__ as contract
from tools.compare import TABLES, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COMPARED = [
    "intervention_queue", "feature_table", "feature_view_full", "top_reasons_long", "fairness_audit", "roc_auc",
    "stratified_split", "optimized_thresholds", "pending_alerts", "quarantine", "recommend_interventions",
    "quantile_exact", "leave_one_out_mean", "map_reasons", "top_risk_function",
]
JVM_ONLY = ["intervention_queue", "top_reasons_in_row", "recommend_interventions", "fairness_audit", "feature_table"]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    return con


def test_every_answer_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 130


@pytest.mark.parametrize("name", COMPARED)
def test_query_agrees_with_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert differences(got, duck.sql(contract.oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", JVM_ONLY)
def test_plans_have_no_python_and_no_pairing_of_all_rows(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_scan_reads_only_what_a_query_needs(spark):
    plan = contract.queries()["high_risk_count"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "segment" not in plan.split("ReadSchema")[-1]


def test_entry_returns_the_head_of_the_queue(spark):
    rows = contract.entry(spark).orderBy("priority_rank").collect()
    assert [r["priority_rank"] for r in rows] == list(range(1, 101))
