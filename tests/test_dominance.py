"""The staircase index against comparing everything, and plans without nested loops or single partitions."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from casewright.operators import dominance, joins
from casewright.operators.ordering import top_rows

CATALOG = "intervention_type string, success_rate double, avg_cost double, financial_stress_level double, risk_score_threshold double, description string, category string"


def catalog(spark, n, seed=1, levels=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        level = rng.choice(levels) if levels else rng.uniform(0, 3)
        threshold = rng.choice([None, rng.random()]) if i % 50 == 0 else rng.random() if i % 3 else round(rng.random(), 1)
        rows.append((f"t{i}", round(rng.random(), 3) if i % 40 else None, rng.uniform(1, 900), level, threshold, "d", "c"))
    return rows, spark.createDataFrame(rows, CATALOG)


def best(rows, risk, stress, k):
    fits = [r for r in rows if None not in (r[3], r[4], risk, stress) and r[4] <= risk + 0.15 and r[3] <= stress + 1]
    return [r[0] for r in sorted(fits, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:k]]


@pytest.mark.parametrize("n,levels,searched,k", [(100_000, None, 1 << 16, 5), (3000, [0.0, 1.0, 2.0, None], 1 << 16, 5), (2000, None, 16, 3), (0, None, 16, 5)])
def test_best_of_any_catalogue_equal_comparing_all(spark, monkeypatch, n, levels, searched, k):
    monkeypatch.setattr(dominance, "SEARCHED", searched)
    rows, table = catalog(spark, n, levels=levels)
    rng = random.Random(5)
    asked = [(i, rng.choice([None, -1.0, rng.uniform(-0.2, 1), 0.85, 0.0]), rng.choice([None, -2.0, rng.uniform(-1, 3), 0.0])) for i in range(300)]
    entities = spark.createDataFrame(asked, "entity_id int, risk double, stress double")
    got = joins.recommend_interventions(entities, table, "entity_id", "risk", "stress", k)
    found = {}
    for r in got.orderBy("entity_id", "option_rank").collect():
        found.setdefault(r["entity_id"], []).append(r["intervention_type"])
    assert found == {i: b for i, risk, stress in asked if (b := best(rows, risk, stress, k))}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_every_fit_is_counted(spark):
    rows, table = catalog(spark, 200, levels=[0.0, 1.0, 2.0])
    entities = spark.createDataFrame([(1, 0.5, 0.0), (2, None, 1.0), (3, 0.9, None), (4, 0.1, 5.0)], "entity_id int, risk double, stress double")
    got = joins.fitting_interventions(entities, table, "entity_id", "risk", "stress").collect()
    assert sorted((r["entity_id"], r["intervention_type"]) for r in got) == sorted(
        (i, t) for i, risk, stress in [(1, 0.5, 0.0), (4, 0.1, 5.0)] for t in best(rows, risk, stress, 10**6))


SF = "/root/testdata/sf0.001"


def test_table_functions_have_no_nested_loop_and_no_single_partition(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan(contract.queries()["similar_interventions_function"](spark, SF))
    contract.queries()["top_risk_function"](spark, SF)
    scores = sorted(((r["dropout_risk_score"], -r["entity_id"]) for r in spark.table("cw_profiles").collect()), reverse=True)
    for n in (1, 50, 1001, 1_000_000):
        found = spark.sql(f"SELECT entity_id, dropout_risk_score FROM top_risk(0.2D, {n})")
        shown = plan(found)
        assert "Window" not in shown and "Sort" not in shown
        assert {r["entity_id"] for r in found.collect()} == {-i for s, i in scores[:n] if s >= 0.2}


@pytest.mark.parametrize("n", [0, 1, 7, 1001, 2500, 5000])
def test_top_rows_of_any_number(spark, n):
    rows = [(i, None if i % 11 == 0 else float(i % 13) if i % 2 else (i * 7919 % 1000) / 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "entity_id int, score double").repartition(5)
    got = top_rows(df, "score", "entity_id", n)
    want = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1], r[0]))[:n]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_reach_counts_equal_entities_once_and_does_not_gather_them_by_level(spark):
    entities = spark.createDataFrame([(i, (i % 7) / 10, i % 3) for i in range(500)] + [(500, None, 1), (501, 0.5, None)], "entity_id bigint, risk double, stress int")
    table = spark.createDataFrame([("a", 0.9, 1, 0.3), ("b", 0.8, 2, 0.5), ("c", 0.7, 9, 0.1), ("d", 0.6, None, 0.0)], "intervention_type string, success_rate double, financial_stress_level int, risk_score_threshold double")
    fits = joins.fitting_interventions(entities, table, "entity_id", "risk", "stress")
    want = {r["intervention_type"]: r["n"] for r in fits.groupBy("intervention_type").count().withColumnRenamed("count", "n").collect()}
    reach = joins.intervention_reach(entities, table, "risk", "stress")
    assert {r["intervention_type"]: r["entities"] for r in reach.collect()} == want and set(want) == {"a", "b"}
    plan = fits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
