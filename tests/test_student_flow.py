"""The whole flow on a generated file with the source's raw header."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from casewright.operators import learning, metrics
from casewright.operators.treeshap import tree_contributions
from casewright.plans import student
from casewright.sources.catalog import TABLES

HEADER = [
    "Marital status", "Application mode", "Application order", "Course", "Daytime/evening attendance",
    "Previous qualification", "Previous qualification (grade)", "Nacionality", "Mother's qualification",
    "Father's qualification", "Mother's occupation", "Father's occupation", "Admission grade", "Displaced",
    "Educational special needs", "Debtor", "Tuition fees up to date", "Gender", "Scholarship holder",
    "Age at enrollment", "International",
    *[f"Curricular units {n} sem ({part})" for n in ("1st", "2nd")
      for part in ("credited", "enrolled", "evaluations", "approved", "grade", "without evaluations")],
    "Unemployment rate", "Inflation rate", "GDP", "Target",
]
AS_OF = "2024-01-31 00:00:00"


def write_students(path, n=320, bad=7):
    rng = random.Random(5)
    with open(path, "w", newline="") as handle:
        out = csv.writer(handle)
        out.writerow(HEADER)
        for i in range(n):
            enrolled = rng.randint(4, 7)
            good = rng.random()
            approved = [min(enrolled, int(enrolled * good + rng.random())) for _ in range(2)]
            debtor, paid = int(rng.random() < 0.2), int(rng.random() < 0.85)
            risk = (1 - good) + 0.4 * debtor + 0.4 * (1 - paid) + rng.gauss(0, 0.1)
            target = "Dropout" if risk > 0.75 else "Enrolled" if risk > 0.5 else "Graduate"
            units = []
            for a in approved:
                units += [0, enrolled, enrolled + rng.randint(0, 2), a, round(20 * good, 1), rng.randint(0, 1)]
            out.writerow([
                1, rng.choice([1, 17, 39]), rng.randint(0, 3), rng.choice([33, 171, 9254]), rng.randint(0, 1),
                1, round(rng.uniform(95, 190), 1), 1, rng.randint(1, 40), rng.randint(1, 40), 5, 9,
                round(rng.uniform(95, 190), 1), rng.randint(0, 1), 0, debtor if i >= bad else 2, paid,
                rng.randint(0, 1), rng.randint(0, 1), rng.randint(17, 50), 0, *units, 10.8, 1.4, 1.74, target,
            ])
    return path


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = write_students(tmp_path_factory.mktemp("source") / "students.csv")
    return student.run(spark, str(path), AS_OF, trees=15, iterations=100)


def test_layers_keep_their_row_counts(tables):
    assert tables["bronze"].count() == 320
    assert len(tables["bronze"].columns) == 37 + 4
    assert tables["validated"].count() == 313
    assert {tables[name].count() for name in student.SUBJECTS} == {313}
    assert tables["features"].count() == 313
    assert tables["reasons"].count() == 62


def test_ids_are_dense(tables):
    low, high, distinct = tables["bronze"].agg(
        F.min("student_id"), F.max("student_id"), F.count_distinct("student_id")
    ).first()
    assert (low, high, distinct) == (1, 320, 320)


def test_models_learn_and_the_best_one_is_flagged(tables):
    rows = tables["metrics"].collect()
    assert len(rows) == 2 and sum(r["is_best_model"] for r in rows) == 1
    best = max(rows, key=lambda r: r["roc_auc"])
    assert best["is_best_model"] == 1 and best["roc_auc"] > 0.8


def test_stored_best_model_scores_the_same(spark, tables):
    model, row = learning.load_best(spark, tables["metrics"])
    assert row["is_best_model"] == 1
    test = tables["features"].join(tables["scores"].select("student_id", F.col("risk_score").alias("old")), "student_id")
    rescored = learning.score(model, test)
    assert rescored.where(F.abs(F.col("risk_score") - F.col("old")) > 1e-9).count() == 0


def test_queue_is_a_ranked_permutation_of_the_scores(tables):
    queue = tables["queue"].orderBy("priority_rank").toPandas()
    assert list(queue.priority_rank) == list(range(1, len(queue) + 1))
    assert queue.risk_score.is_monotonic_decreasing
    assert set(queue.student_id) == {r[0] for r in tables["scores"].select("student_id").collect()}
    assert {"student_id", "risk_score", "predicted_dropout", "actual_dropout", "confidence_band",
            "intervention_tier", "recommended_action", "top_risk_factor_1", "top_risk_factor_2",
            "top_risk_factor_3", "fairness_review_flag", "priority_rank", "queue_ts"} == set(queue.columns)


def test_explanations_cover_predicted_positives_without_sensitive_features(tables):
    positives = tables["scores"].where("predicted_dropout = 1").count()
    rows = tables["explanations"].collect()
    assert len(rows) == positives > 0
    names = {r[f"raw_feature_{i}"] for r in rows for i in (1, 2, 3)}
    assert not any("gender" in n or "age_at" in n or "mothers" in n for n in names)
    assert all(len({r["factor_1"], r["factor_2"], r["factor_3"]}) == 3 for r in rows if r["factor_3"] != "Other model risk signal")


def test_audit_lists_every_group(tables):
    rows = tables["fairness"].collect()
    assert {r["protected_attribute"] for r in rows} == set(student.AUDITED)
    total = tables["scores"].count()
    for attribute in student.AUDITED:
        assert sum(r["population_count"] for r in rows if r["protected_attribute"] == attribute) == total


def test_alerts_go_to_eligible_students_once(spark, tables):
    due = tables["queue"].where("predicted_dropout = 1 AND risk_score >= 0.7").count()
    log = tables["alerts"]
    assert log.count() == due > 0
    delivered = log.withColumn("sent_status", F.lit("sent"))
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    assignments = spark.table(TABLES["queue"]).select(
        "student_id", F.lit("Default Counselor").alias("counselor_name"),
        F.lit("counselor@example.org").alias("counselor_email"), F.lit(1).alias("active_flag"),
    )
    assert student.build_alerts(tables["queue"], assignments, delivered, now).count() == 0
    later = F.lit("2024-02-03 00:00:00").cast("timestamp")
    assert student.build_alerts(tables["queue"], assignments, delivered, later).count() == due


def test_forest_explanations_add_up_and_cover_everyone(tables):
    rows = tables["features"]
    trained = student.train_and_score(rows, F.lit(AS_OF), trees=8, iterations=20)
    forest = trained.models[student.FOREST]
    scored = learning.score(forest, rows)
    contributions, base = tree_contributions(forest.stages[-1], scored, ["student_id", "risk_score"])
    added = F.aggregate("contributions", F.lit(base), lambda a, c: a + c)
    assert contributions.where(F.abs(added - F.col("risk_score")) > 1e-9).count() == 0
    assert len(contributions.first()["contributions"]) == len(learning.feature_names(forest, trained.columns))
    flagged = trained.scores.where("predicted_dropout = 1").count()
    explained = student.explain(trained._replace(best=student.FOREST), rows)
    assert explained.count() == flagged
    assert explained.where("factor_1 = 'Other model risk signal'").count() == 0


def test_metrics_agree_with_plain_counting(tables):
    scored = tables["scores"]
    got = metrics.evaluate(scored, "actual_dropout", "predicted_dropout", "risk_score")
    pdf = scored.toPandas()
    pos, neg = pdf[pdf.actual_dropout == 1].risk_score, pdf[pdf.actual_dropout == 0].risk_score
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert got["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)))
    assert got["accuracy"] == pytest.approx((pdf.actual_dropout == pdf.predicted_dropout).mean())
