"""Group audits from confusion counts: one pass over the entities, the rest on group rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.expressions import any_of, case_rules
from casewright.operators.joins import null_safe_lookup

COUNTS = ["population_count", "tp", "fp", "fn", "tn"]
CORE_RATES = ["selection_rate", "true_positive_rate", "false_positive_rate"]
EXTRA_RATES = ["accuracy", "precision", "recall", "false_negative_rate"]


def rate(part: Column, whole: Column) -> Column:
    """Share of a count; an empty denominator gives 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion(actual: str, predicted: str) -> list[Column]:
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    return [
        F.count(F.lit(1)).alias("population_count"),
        F.count_if(a & p).alias("tp"),
        F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"),
        F.count_if(~a & ~p).alias("tn"),
    ]


def _rates(full: bool) -> dict[str, Column]:
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "population_count"))
    rates = {
        "selection_rate": rate(tp + fp, n),
        "true_positive_rate": rate(tp, tp + fn),
        "false_positive_rate": rate(fp, fp + tn),
    }
    if full:
        rates |= {
            "accuracy": rate(tp + tn, n),
            "precision": rate(tp, tp + fp),
            "recall": rate(tp, tp + fn),
            "false_negative_rate": rate(fn, tp + fn),
        }
    return rates


def group_confusion(df: DataFrame, attributes: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Confusion counts per (attribute, group) for all attributes in one scan."""
    by_attribute = df.select(actual, predicted, *[F.col(a).cast("string").alias(a) for a in attributes]).unpivot(
        [actual, predicted], list(attributes), "protected_attribute", "group_name"
    )
    return by_attribute.groupBy("protected_attribute", "group_name").agg(*confusion(actual, predicted))


def group_rates(
    df: DataFrame, attributes: Sequence[str], actual: str = "actual", predicted: str = "predicted",
    full: bool = False, overall: bool = False,
) -> DataFrame:
    """Selection, true-positive and false-positive rate per group; ``full`` adds accuracy and others.

    ``overall`` adds one row (attribute and group ``overall``) that sums up the first attribute.
    """
    counts = group_confusion(df, attributes, actual, predicted)
    if overall:
        everyone = counts.where(F.col("protected_attribute") == attributes[0]).agg(
            *[F.sum(c).alias(c) for c in COUNTS]
        )
        label = F.lit("overall")
        counts = counts.unionByName(
            everyone.select(label.alias("protected_attribute"), label.alias("group_name"), *COUNTS)
        )
    return counts.select("protected_attribute", "group_name", *COUNTS, *[
        expr.alias(name) for name, expr in _rates(full).items()
    ])


def _gap(name: str) -> Column:
    return F.max(name) - F.min(name)


def _ratio(name: str) -> Column:
    return F.try_divide(F.min(name), F.max(name))


def parity(rates: DataFrame) -> DataFrame:
    """Per attribute: parity, opportunity and odds as largest difference and smallest ratio.

    A ratio whose largest rate is 0 is NULL.
    """
    tpr, fpr = "true_positive_rate", "false_positive_rate"
    return rates.groupBy("protected_attribute").agg(
        _gap("selection_rate").alias("demographic_parity_difference"),
        _ratio("selection_rate").alias("demographic_parity_ratio"),
        _gap(tpr).alias("equal_opportunity_difference"),
        _ratio(tpr).alias("equal_opportunity_ratio"),
        F.greatest(_gap(tpr), _gap(fpr)).alias("equalized_odds_difference"),
        F.least(_ratio(tpr), _ratio(fpr)).alias("equalized_odds_ratio"),
    )


def review_flag(columns: Sequence[str], limit: float = 0.10) -> Column:
    return F.when(any_of(F.abs(c) > limit for c in columns), 1).otherwise(0)


def fairness_audit(
    df: DataFrame, attributes: Sequence[str], model_name: str, as_of: Column,
    actual: str = "actual", predicted: str = "predicted",
) -> DataFrame:
    """One row per group with its rates and the summary of its attribute."""
    rates = group_rates(df, attributes, actual, predicted)
    summary = parity(rates)
    gaps = ["demographic_parity_difference", "equal_opportunity_difference", "equalized_odds_difference"]
    # One summary row per audited attribute: the size is the length of ``attributes``.
    return rates.join(F.broadcast(summary), "protected_attribute").select(
        F.lit(model_name).alias("model_name"),
        "protected_attribute", "group_name", "population_count", *CORE_RATES,
        *[c for c in summary.columns if c != "protected_attribute"],
        review_flag(gaps).alias("fairness_review_flag"),
        as_of.cast("string").alias("audit_ts"),
    )


def gap_report(
    df: DataFrame, attributes: Sequence[str], actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Distance of each group's selection and true-positive rate from the overall rate."""
    counts = group_confusion(df, attributes, actual, predicted)
    overall = counts.groupBy("protected_attribute").agg(*[F.sum(c).alias(f"all_{c}") for c in COUNTS])
    selected = rate(F.col("tp") + F.col("fp"), F.col("population_count"))
    recalled = rate(F.col("tp"), F.col("tp") + F.col("fn"))
    all_selected = rate(F.col("all_tp") + F.col("all_fp"), F.col("all_population_count"))
    all_recalled = rate(F.col("all_tp"), F.col("all_tp") + F.col("all_fn"))
    return counts.join(F.broadcast(overall), "protected_attribute").select(
        "protected_attribute", "group_name", "population_count",
        selected.alias("positive_prediction_rate"),
        recalled.alias("true_positive_rate"),
        (selected - all_selected).alias("demographic_parity_gap"),
        (recalled - all_recalled).alias("equal_opportunity_gap"),
    )


def reviewed_gaps(report: DataFrame, model_name: str, as_of: Column, limit: float = 0.10) -> DataFrame:
    """A gap report with the model, the time, and flags: per row if a gap exceeds the limit, and whether any row's does."""
    gaps = ["demographic_parity_gap", "equal_opportunity_gap"]
    flagged = report.withColumn("review_required_flag", review_flag(gaps, limit))
    any_row = flagged.agg(F.max("review_required_flag")).scalar()
    return flagged.select(
        F.lit(model_name).alias("model_name"), "*", any_row.alias("global_review_required"), as_of.cast("timestamp").alias("audit_ts")
    )


def fairness_status(parity_ratio: str, odds_difference: str) -> Column:
    ratio, odds = F.col(parity_ratio), F.abs(odds_difference)
    return case_rules(
        [
            (ratio.between(0.8, 1.25) & (odds < 0.1), "PASS"),
            (ratio.between(0.7, 1.3), "REVIEW"),
        ],
        "FAIL",
    )


def parity_band(parity_ratio: str) -> Column:
    ratio = F.col(parity_ratio)
    return case_rules([(ratio < 0.8, "FAIL"), (ratio > 1.25, "WARNING")], "PASS")


def odds_band(odds_difference: str) -> Column:
    odds = F.abs(odds_difference)
    return case_rules([(odds < 0.1, "PASS"), (odds < 0.2, "MODERATE")], "FAIL")


def disparities(rates: DataFrame, metrics: Sequence[str], limit: float = 0.1) -> DataFrame:
    """Largest between-group difference per attribute and metric, flagged above the limit."""
    long = rates.unpivot(["protected_attribute"], list(metrics), "metric", "rate")
    spread = long.groupBy("protected_attribute", "metric").agg(_gap("rate").alias("difference"))
    return spread.withColumn("above_limit", F.when(F.col("difference") > limit, 1).otherwise(0))


def disparate_impact(rates: DataFrame, attribute: str, privileged: str) -> DataFrame:
    """Selection rate of every group over that of the privileged group."""
    own = rates.where(F.col("protected_attribute") == attribute)
    reference = own.where(F.col("group_name") == privileged).agg(F.max("selection_rate").alias("r"))
    return own.select(
        "group_name", "selection_rate",
        F.try_divide(F.col("selection_rate"), reference.scalar()).alias("disparate_impact_ratio"),
    )


def threshold_curve(df: DataFrame, attribute: str, score: str, actual: str, grid: int = 100) -> DataFrame:
    """Per group and threshold step: how many rows at or above it are positive and negative.

    Scores fall into ``grid + 1`` bins while aggregating, so at most that many rows per group remain.
    """
    steps = F.least(F.lit(grid), F.greatest(F.lit(0), F.floor(F.col(score) * F.lit(float(grid)) + F.lit(1e-9))))
    bins = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(attribute).cast("string").alias("group_name"), steps.cast("int").alias("step"))
        .agg(F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg"))
    )
    groups = bins.groupBy("group_name").agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    full = groups.select("group_name", "all_pos", "all_neg", F.explode(F.sequence(F.lit(0), F.lit(grid))).alias("step"))
    above = Window.partitionBy("group_name").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = bins.select(F.col("group_name").alias("_group"), F.col("step").alias("_step"), "pos", "neg")
    same = F.col("group_name").eqNullSafe(F.col("_group")) & (F.col("step") == F.col("_step"))  # NULL is a group too
    return full.join(found, same, "left").select(
        "group_name", "step", "all_pos", "all_neg",
        F.sum(F.coalesce("pos", F.lit(0))).over(above).alias("tp"),
        F.sum(F.coalesce("neg", F.lit(0))).over(above).alias("fp"),
    )


CONSTRAINTS = {
    "equalized_odds": ("tpr", "fpr"),
    "true_positive_rate_parity": ("tpr",),
    "false_positive_rate_parity": ("fpr",),
    "demographic_parity": ("sel",),
}


def optimize_thresholds(
    df: DataFrame, attribute: str, score: str = "risk_score", actual: str = "actual",
    constraint: str = "equalized_odds", grid: int = 100, tolerance: float = 0.05,
) -> DataFrame:
    """One deterministic threshold per group: best balanced accuracy with the gap inside a tolerance.

    For every step of the pooled curve each group picks the step whose rates are nearest to the
    pooled rates. Of the pooled steps whose gap between groups is within ``tolerance`` the one with
    the best balanced accuracy wins. All work is on ``groups x (grid + 1)^2`` rows.
    """
    curve = threshold_curve(df, attribute, score, actual, grid)
    rates = {
        "tpr": rate(F.col("tp"), F.col("all_pos")),
        "fpr": rate(F.col("fp"), F.col("all_neg")),
        "sel": rate(F.col("tp") + F.col("fp"), F.col("all_pos") + F.col("all_neg")),
    }
    by_group = curve.withColumns(rates)
    pooled = curve.groupBy("step").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "all_pos", "all_neg")])
    goals = pooled.select(F.col("step").alias("goal"), *[e.alias(f"goal_{n}") for n, e in rates.items()])
    watched = CONSTRAINTS[constraint]
    offered = by_group.withColumn("goal", F.explode(F.sequence(F.lit(0), F.lit(grid))))
    # ``goals`` has grid + 1 rows.
    offered = offered.join(F.broadcast(goals), "goal")
    distances = [F.abs(F.col(n) - F.col(f"goal_{n}")) for n in watched]
    distance = F.round(F.greatest(*distances) if len(distances) > 1 else distances[0], 9)
    best = offered.groupBy("group_name", "goal").agg(
        F.min_by(
            F.struct("step", "tp", "fp", "all_pos", "all_neg", "tpr", "fpr", "sel"),
            F.struct(distance.alias("d"), F.col("step")),
        ).alias("pick")
    ).select("group_name", "goal", "pick.*")
    gaps = [_gap(n) for n in watched]
    outcome = best.groupBy("goal").agg(
        F.round(F.greatest(*gaps) if len(gaps) > 1 else gaps[0], 9).alias("gap"),
        F.round(
            (rate(F.sum("tp"), F.sum("all_pos")) + F.lit(1.0) - rate(F.sum("fp"), F.sum("all_neg"))) / 2, 9
        ).alias("balanced_accuracy"),
    )
    excess = F.greatest(F.col("gap") - F.lit(tolerance), F.lit(0.0))
    winner = outcome.agg(
        F.min_by("goal", F.struct(excess, -F.col("balanced_accuracy"), F.col("goal"))).alias("goal")
    )
    return best.where(F.col("goal") == winner.scalar()).select(
        "group_name", (F.col("step") / F.lit(float(grid))).alias("threshold"),
        F.col("tpr").alias("true_positive_rate"), F.col("fpr").alias("false_positive_rate"),
    )


def apply_thresholds(df: DataFrame, thresholds: DataFrame, attribute: str, score: str, name: str = "fair_predicted") -> DataFrame:
    """Decide with the group's own threshold (scores are compared on the same grid)."""
    cuts = thresholds.select(F.col("group_name").alias(attribute), F.col("threshold"))
    keyed = df.withColumn(attribute, F.col(attribute).cast("string"))
    joined = null_safe_lookup(keyed, cuts, [attribute])
    return joined.withColumn(
        name, F.when(F.col(score) + F.lit(1e-9) >= F.col("threshold"), 1).otherwise(0)
    ).drop("threshold")


def compare_mitigation(
    df: DataFrame, attribute: str, before: str, after: str, actual: str = "actual"
) -> DataFrame:
    """Accuracy, parity and odds before and after, both gains as before minus after, and a verdict."""
    def outcome(predicted: str) -> DataFrame:
        counts = group_rates(df, [attribute], actual, predicted)
        summary = parity(counts)
        accuracy = counts.groupBy("protected_attribute").agg(
            rate(F.sum("tp") + F.sum("tn"), F.sum("population_count")).alias("accuracy")
        )
        return summary.join(accuracy, "protected_attribute").select(
            "protected_attribute", "accuracy",
            F.col("demographic_parity_ratio").alias("dp_ratio"),
            F.col("equalized_odds_difference").alias("eo_difference"),
        )

    def named(prefix: str, frame: DataFrame) -> DataFrame:
        return frame.select("protected_attribute", *[
            F.col(c).alias(f"{c}_{prefix}") for c in ("accuracy", "dp_ratio", "eo_difference")
        ])

    both = named("before", outcome(before)).join(named("after", outcome(after)), "protected_attribute")
    change = F.col("accuracy_before") - F.col("accuracy_after")
    eo_gain = F.abs("eo_difference_before") - F.abs("eo_difference_after")
    dp_gain = F.abs(F.col("dp_ratio_before") - 1.0) - F.abs(F.col("dp_ratio_after") - 1.0)
    return both.withColumns(
        {
            "accuracy_drop": F.round(change, 6),
            "fairness_gain_dp": F.round(dp_gain, 6),
            "fairness_gain_eo": F.round(eo_gain, 6),
            "recommendation": F.when((F.abs(change) < 0.03) & (eo_gain > 0.05), "deploy").otherwise("review"),
        }
    )
