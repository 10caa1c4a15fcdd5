"""Group thresholds by the hulls of the groups' ROC curves; no grid.

Every threshold of a group is a point (false-positive rate, true-positive rate); mixing two thresholds reaches the line between their
points, so a group reaches everything up to the upper hull of its points. A constraint asks all groups for one common
coordinate. On the hulls the objective is concave and made of straight pieces, so its maximum is found exactly: at a corner of a
hull or where the hulls of two groups cross. Each group then mixes the thresholds of two neighbouring corners.

Rows are only counted by (group, score). The points of a group are thinned to corners in parallel, batch by batch, because a hull
of hulls is the hull; what is left are the corners.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.operators.joins import null_safe_lookup
from casewright.operators.ordering import with_running_totals
from casewright.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: constraint: what is common to all groups, and whether the lowest group decides (all must reach one point).
CONSTRAINTS = {
    "equalized_odds": ("fpr", True),
    "false_positive_rate_parity": ("fpr", False),
    "true_positive_rate_parity": ("tpr", False),
    "demographic_parity": ("sel", False),
}
#: Values of the common coordinate that are tried at a time, and times that the best one's neighbourhood is cut as finely.
GRID, ROUNDS = 256, 3
#: Points that are thinned by one task in the end.
FEW = 1 << 16
POINT = "group_name string, fp bigint, tp bigint, threshold double"


def roc_points(df: DataFrame, attribute: str, score: str, actual: str) -> DataFrame:
    """(group_name, fp, tp, threshold): what each group has at or above each of its scores; NULL is a group.

    A running total over all (group, score) pairs by range partitions; rows without a score or an outcome are left out.
    """
    group = F.col(attribute).cast("string").alias("group_name")
    positive = F.col(actual) == 1
    counts = df.where(F.col(score).isNotNull() & F.col(actual).isNotNull()).groupBy(group, F.col(score).cast("double").alias("threshold"))
    counts = counts.agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    order = [F.col("group_name").asc_nulls_last(), F.col("threshold").desc()]
    running = with_running_totals(counts, order, {"_tp": "pos", "_fp": "neg"})
    begin = running.groupBy("group_name").agg(F.min(F.col("_tp") - F.col("pos")).alias("_tp0"), F.min(F.col("_fp") - F.col("neg")).alias("_fp0"))
    own = null_safe_lookup(running, staged(begin), ["group_name"], stored=True)
    return own.select("group_name", (F.col("_fp") - F.col("_fp0")).alias("fp"), (F.col("_tp") - F.col("_tp0")).alias("tp"), "threshold")


def _corners(points: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The upper hull, left to right; whole numbers, so nothing is rounded."""
    hull: list[tuple[int, int, float]] = []
    for fp, tp, threshold in sorted(points, key=lambda p: (p[0], -p[1])):
        if hull and (tp <= hull[-1][1] or fp == hull[-1][0]):
            continue
        while len(hull) > 1 and (hull[-1][0] - hull[-2][0]) * (tp - hull[-2][1]) >= (fp - hull[-2][0]) * (hull[-1][1] - hull[-2][1]):
            hull.pop()
        hull.append((fp, tp, threshold))
    return hull


def _thinned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for name, rows in batch.groupby("group_name", dropna=False):
            known = None if pd.isna(name) else name
            # The last point of all, with every row of the group, is a corner whatever its height.
            points = [(int(a), int(b), float(c)) for a, b, c in zip(rows["fp"], rows["tp"], rows["threshold"])]
            kept = set(_corners(points)) | {max(points, key=lambda p: (p[0], p[1]))}
            out += [(known, *p) for p in sorted(kept)]
        yield pd.DataFrame(out, columns=["group_name", "fp", "tp", "threshold"])


def hull_corners(points: DataFrame) -> DataFrame:
    """The corners of each group's upper hull, with the origin (threshold infinity); stored."""
    origin = points.select("group_name").distinct().select("group_name", F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(float("inf")))
    left, before = staged(points.union(origin).mapInPandas(_thinned, POINT)), None
    count = left.count()
    while count > FEW and (before is None or count < before / 2):
        order = [F.col("group_name").asc_nulls_last(), "fp", "tp"]
        left, before = staged(left.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_thinned, POINT)), count
        count = left.count()
    # What is left are corners, and a few points a batch that are not; a group's corners meet in one task.
    return staged(left.groupBy("group_name").applyInPandas(_whole, POINT))


def _whole(rows: pd.DataFrame) -> pd.DataFrame:
    return next(_thinned(iter([rows])))


def _edges(corners: DataFrame, constraint: str) -> DataFrame:
    """(group_name, c0, c1, v0, v1, slope, ...): the pieces of each group's value over the common coordinate; groups with both outcomes."""
    common, lowest = CONSTRAINTS[constraint]
    ends = corners.groupBy("group_name").agg(F.max("fp").alias("neg"), F.max("tp").alias("pos"))
    all_of = ends.where("neg > 0 AND pos > 0").agg(F.sum("neg").cast("double").alias("n"), F.sum("pos").cast("double").alias("p"))
    rated = null_safe_lookup(corners, staged(ends.where("neg > 0 AND pos > 0")), ["group_name"], how="inner", stored=True)
    rated = rated.withColumns({"fpr": F.col("fp") / F.col("neg"), "tpr": F.col("tp") / F.col("pos"), "sel": (F.col("fp") + F.col("tp")) / (F.col("neg") + F.col("pos"))})
    gain = F.col("tp") / all_of.select("p").scalar()
    loss = F.col("fp") / all_of.select("n").scalar()
    value = {"equalized_odds": F.col("tpr"), "false_positive_rate_parity": gain, "true_positive_rate_parity": -loss, "demographic_parity": gain - loss}[constraint]
    along = Window.partitionBy("group_name").orderBy("fp", "tp")
    placed = rated.select("group_name", "threshold", "fpr", "tpr", F.col(common).alias("c"), value.alias("v"), "fp", "tp")
    follow = placed.withColumns({f"{c}_next": F.lead(c).over(along) for c in ("c", "v", "fpr", "tpr", "threshold")})
    return staged(follow.where("c_next IS NOT NULL AND c_next >= c").drop("fp", "tp"))


def _lines(edges: DataFrame) -> DataFrame:
    """(group_name, slope, at, v): the value of a group is the lowest of its lines; upright pieces bound nothing."""
    steep = (F.col("v_next") - F.col("v")) / (F.col("c_next") - F.col("c"))
    return edges.where("c_next > c").select("group_name", steep.alias("slope"), F.col("c").alias("at"), "v")


def _objective(lines: DataFrame, tries: Sequence[float], constraint: str) -> DataFrame:
    """(c, goal): the objective at each tried coordinate."""
    common, lowest = CONSTRAINTS[constraint]
    reached = F.col("v") + F.col("slope") * (F.col("c") - F.col("at"))
    array = F.from_json(F.lit(json.dumps(sorted(set(tries)))), "array<double>")
    tried = lines.select("group_name", "slope", "at", "v", F.explode(array).alias("c"))
    by_group = tried.groupBy("c", "group_name").agg(F.min(reached).alias("v"))
    whole = by_group.groupBy("c").agg((F.min("v") if lowest else F.sum("v")).alias("v"))
    extra = {"equalized_odds": -F.col("c"), "false_positive_rate_parity": -F.col("c"), "true_positive_rate_parity": F.col("c"), "demographic_parity": F.lit(0.0)}[constraint]
    return whole.select("c", F.col("v"), (F.col("v") + extra).alias("goal"))


def _best_common(edges: DataFrame, constraint: str) -> tuple[float, float] | None:
    """(coordinate, value) with the best objective, the smallest coordinate on ties."""
    lines = staged(_lines(edges))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        steps = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        goals = {r["c"]: r["goal"] for r in _objective(lines, steps, constraint).collect()}  # GRID + 1 rows
        if not goals:
            return None
        at = max(range(GRID + 1), key=lambda i: (goals[steps[i]], -i))
        low, high = steps[max(0, at - 1)], steps[min(GRID, at + 1)]
    # The corners left in a range of (2 / GRID) ** ROUNDS, and the crossing of the lines that are lowest at its ends.
    inside = edges.select(F.explode(F.array("c", "c_next")).alias("c")).where(F.col("c").between(low, high)).distinct()
    tried = [low, high, *[r["c"] for r in inside.collect()]]
    if CONSTRAINTS[constraint][1]:
        value = lambda c: F.col("v") + F.col("slope") * (F.lit(c) - F.col("at"))
        ends = lines.agg(F.min(F.struct(value(low), "slope", value(low).alias("y"))).alias("l"), F.min(F.struct(value(high), -F.col("slope"), F.col("slope").alias("s"), value(high).alias("y"))).alias("r")).first()
        left, right = (ends["l"]["slope"], ends["l"]["y"]), (ends["r"]["s"], ends["r"]["y"])
        if left[0] != right[0]:
            cross = low + (right[1] - left[1] - right[0] * (high - low)) / (left[0] - right[0])
            if low < cross < high:
                tried.append(cross)
    rounded = F.round("goal", 12)
    best = _objective(lines, tried, constraint).agg(F.min(F.struct(-rounded, "c", "v")).alias("b")).first()["b"]
    return best["c"], best["v"]


def fit_hull_thresholds(
    df: DataFrame, attribute: str, score: str = "risk_score", actual: str = "actual", constraint: str = "equalized_odds"
) -> DataFrame:
    """(group_name, threshold_low, threshold_high, share_low, share_fixed, fixed, true_positive_rate, false_positive_rate), one row a group.

    A row of the group is decided by ``score >= threshold_low`` with the chance ``share_low``, else by ``threshold_high``; with the chance
    ``share_fixed`` neither counts and the decision is positive with the chance ``fixed``. The rates are what is expected on the fitting rows:
    under ``equalized_odds`` the same pair in all groups, under the parities the same true- or false-positive or selection rate, with the best
    balanced accuracy. A group with one outcome only constrains nothing; its decisions have the pooled rate by chance alone.
    """
    corners = hull_corners(roc_points(df, attribute, score, actual))
    edges = _edges(corners, constraint)
    found = _best_common(edges, constraint)
    counts = corners.groupBy("group_name").agg(F.max("fp").alias("neg"), F.max("tp").alias("pos"))
    inf = F.lit(float("inf"))
    if found is None:
        rate = F.lit(0.0)
        return counts.select("group_name", inf.alias("threshold_low"), inf.alias("threshold_high"), F.lit(0.0).alias("share_low"), F.lit(1.0).alias("share_fixed"),
                             rate.alias("fixed"), rate.alias("true_positive_rate"), rate.alias("false_positive_rate"))
    c, v = F.lit(found[0]), F.lit(found[1])
    # The piece of each group that holds the common coordinate; of an upright one the end that is better.
    holds = edges.where((F.col("c") <= c + 1e-15) & (F.col("c_next") >= c - 1e-15))
    share = F.coalesce(F.try_divide(c - F.col("c"), F.col("c_next") - F.col("c")), F.lit(1.0))
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))
    mixed = holds.withColumn("share", share).withColumns({n: F.col(n) + F.col("share") * (F.col(f"{n}_next") - F.col(n)) for n in ("fpr", "tpr")})
    pieces = F.struct("threshold", "threshold_next", "share", "fpr", "tpr")
    own = mixed.groupBy("group_name").agg(F.max_by(pieces, F.struct(F.round(F.col("tpr") - F.col("fpr"), 12), -F.col("fpr"), "threshold")).alias("m")).select("group_name", "m.*")
    # Where all must meet in one point, a group above it gives up what it has more, by deciding some rows by chance.
    given_up = F.coalesce(F.try_divide(F.col("tpr") - v, F.col("tpr") - F.col("fpr")), F.lit(0.0)) if CONSTRAINTS[constraint][1] else F.lit(0.0)
    given_up = F.least(F.lit(1.0), F.greatest(F.lit(0.0), given_up))
    fixed = F.col("fpr")
    fitted = own.withColumn("share_fixed", given_up).select(
        "group_name", F.col("threshold_next").alias("threshold_low"), F.col("threshold").alias("threshold_high"), F.col("share").alias("share_low"), "share_fixed",
        fixed.alias("fixed"), (F.col("tpr") - F.col("share_fixed") * (F.col("tpr") - fixed)).alias("true_positive_rate"), F.col("fpr").alias("false_positive_rate"),
    )
    both = null_safe_lookup(fitted, staged(counts), ["group_name"], stored=True)
    rate = both.agg((F.sum(F.col("true_positive_rate") * F.col("pos") + F.col("false_positive_rate") * F.col("neg")) / F.sum(F.col("pos") + F.col("neg"))).alias("r")).scalar()
    alone = counts.where("neg = 0 OR pos = 0").select(
        "group_name", inf.alias("threshold_low"), inf.alias("threshold_high"), F.lit(0.0).alias("share_low"), F.lit(1.0).alias("share_fixed"),
        rate.alias("fixed"), F.when(F.col("pos") > 0, rate).otherwise(0.0).alias("true_positive_rate"), F.when(F.col("neg") > 0, rate).otherwise(0.0).alias("false_positive_rate"),
    )
    return staged(fitted.union(alone))


def _draw(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(f"draw{seed}")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def apply_hull_thresholds(df: DataFrame, thresholds: DataFrame, attribute: str, score: str, key: str, name: str = "fair_predicted") -> DataFrame:
    """``df`` with the decision and its chance (``<name>_chance``); the draws are hashes of the id, so a rerun decides the same.

    A row without a score or whose group was not fitted has no decision (NULL).
    """
    group = f"_{name}_group"
    rules = thresholds.withColumnsRenamed({"group_name": group}).drop("true_positive_rate", "false_positive_rate")
    keyed = null_safe_lookup(df.withColumn(group, F.col(attribute).cast("string")), rules, [group], stored=True)
    low, high = (F.when(F.col(score) >= F.col(f"threshold_{end}"), 1.0).otherwise(0.0) for end in ("low", "high"))
    by_score = F.col("share_low") * low + (1 - F.col("share_low")) * high
    known = F.col(score).isNotNull() & F.col("share_low").isNotNull()
    chance = F.when(known, F.col("share_fixed") * F.col("fixed") + (1 - F.col("share_fixed")) * by_score)
    drawn = F.when(_draw(key, 1) < F.col("share_fixed"), F.when(_draw(key, 2) < F.col("fixed"), 1).otherwise(0)).otherwise(
        F.when(F.when(_draw(key, 3) < F.col("share_low"), low).otherwise(high) > 0, 1).otherwise(0)
    )
    decided = keyed.withColumns({f"{name}_chance": chance, name: F.when(known, drawn)})
    return decided.drop(group, "threshold_low", "threshold_high", "share_low", "share_fixed", "fixed")
