"""Hull thresholds against a search over all pairs of thresholds, with a NULL group and a group with one outcome."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from casewright.operators import mitigation
from casewright.operators.mitigation import apply_hull_thresholds, fit_hull_thresholds

GROUPS = ["a", "b", None]


def scored(seed=4, n=240, alone=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = rng.choice(GROUPS)
        y = int(rng.random() < {"a": 0.3, "b": 0.6, None: 0.5}[group])
        rows.append((i, group, round(min(0.99, max(0.0, rng.gauss(0.35 + 0.2 * y + (0.1 if group == "b" else 0), 0.2))), 2), y))
    if alone:
        rows += [(n + i, "alone", 0.4, 1) for i in range(5)]
    return rows


def curve(rows, group):
    """All points of a group and the pieces between any two of them: its hull, the slow way."""
    mine = [(s, y) for _, g, s, y in rows if g == group]
    pos, neg = sum(y for _, y in mine), sum(1 - y for _, y in mine)
    cuts = sorted({s for s, _ in mine} | {2.0})
    return [(sum(1 - y for s, y in mine if s >= t) / neg, sum(y for s, y in mine if s >= t) / pos) for t in cuts], pos, neg


def height(points, x):
    best = max([y for a, y in points if a <= x], default=0.0)
    for (a, ya), (b, yb) in itertools.combinations(points, 2):
        if a > b:
            (a, ya), (b, yb) = (b, yb), (a, ya)
        if a < b and a <= x <= b:
            best = max(best, ya + (yb - ya) * (x - a) / (b - a))
    return best


def expected(rows, chance):
    """(true-positive, false-positive, selection) rate of each group, as expected."""
    out = {}
    for g in {r[1] for r in rows}:
        pos = [chance[i] for i, group, _, y in rows if group == g and y]
        neg = [chance[i] for i, group, _, y in rows if group == g and not y]
        out[g] = (sum(pos) / max(1, len(pos)), sum(neg) / max(1, len(neg)), (sum(pos) + sum(neg)) / (len(pos) + len(neg)))
    return out


@pytest.mark.parametrize("constraint,watched", [("equalized_odds", (0, 1)), ("true_positive_rate_parity", (0,)), ("demographic_parity", (2,))])
def test_constraint_holds_and_nothing_is_better(spark, constraint, watched):
    rows = scored()
    df = spark.createDataFrame(rows, "id int, g string, score double, actual int").repartition(4)
    rules = fit_hull_thresholds(df, "g", "score", "actual", constraint)
    told = {r["group_name"]: r for r in rules.collect()}
    assert set(told) == {*GROUPS, "alone"} and told["alone"]["share_fixed"] == 1.0
    decided = apply_hull_thresholds(df, rules, "g", "score", "id").collect()
    assert all((r["fair_predicted_chance"] in (0.0, 1.0)) <= (r["fair_predicted"] == r["fair_predicted_chance"]) for r in decided)
    rates = expected(rows, {r["id"]: r["fair_predicted_chance"] for r in decided})
    for g in GROUPS:
        assert rates[g][0] == pytest.approx(told[g]["true_positive_rate"], abs=1e-9) and rates[g][1] == pytest.approx(told[g]["false_positive_rate"], abs=1e-9)
    for k in watched:
        values = [rates[g][k] for g in GROUPS]
        assert max(values) - min(values) < 1e-6
    curves = {g: curve(rows, g) for g in GROUPS}
    all_pos, all_neg = sum(c[1] for c in curves.values()), sum(c[2] for c in curves.values())
    reached = sum(rates[g][0] * curves[g][1] for g in GROUPS) / all_pos - sum(rates[g][1] * curves[g][2] for g in GROUPS) / all_neg
    tries = [i / 400 for i in range(401)] + sorted({x for c in curves.values() for x, _ in c[0]})
    if constraint == "equalized_odds":
        best = max(min(height(c[0], x) for c in curves.values()) - x for x in tries)
    elif constraint == "false_positive_rate_parity":
        best = max(sum(c[1] * height(c[0], x) for c in curves.values()) / all_pos - x for x in tries)
    else:
        fine = [i / 250 for i in range(251)]
        along = {g: [(x, height(c[0], x)) for x in fine] for g, c in curves.items()}

        def cost(g, common):
            c, points = curves[g], along[g]
            key = (lambda p: p[1]) if constraint == "true_positive_rate_parity" else (lambda p: (p[0] * c[2] + p[1] * c[1]) / (c[1] + c[2]))
            x, y = next((p for p in points if key(p) >= common - 1e-12), (1.0, 1.0))
            return c[1] * y / all_pos - c[2] * x / all_neg

        best = max(sum(cost(g, common) for g in curves) for common in fine) - 0.02
    assert reached >= best - 1e-9


def test_thinning_in_many_batches_gives_the_same_corners(spark, monkeypatch):
    rows = scored(seed=9, n=900, alone=False)
    df = spark.createDataFrame(rows, "id int, g string, score double, actual int")
    points = mitigation.roc_points(df, "g", "score", "actual")
    corners = sorted(map(str, mitigation.hull_corners(points).collect()))
    monkeypatch.setattr(mitigation, "FEW", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(str, mitigation.hull_corners(points).collect())) == corners
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_rows_and_one_outcome(spark):
    df = spark.createDataFrame([(1, "a", 0.5, 1), (2, "a", None, 0), (3, "b", 0.1, None)], "id int, g string, score double, actual int")
    assert fit_hull_thresholds(df.limit(0), "g", "score", "actual").count() == 0
    rules = fit_hull_thresholds(df, "g", "score", "actual")
    assert [r["share_fixed"] for r in rules.collect()] == [1.0]
    decided = {r["id"]: r["fair_predicted"] for r in apply_hull_thresholds(df, rules, "g", "score", "id").collect()}
    assert decided == {1: 0, 2: None, 3: None}
