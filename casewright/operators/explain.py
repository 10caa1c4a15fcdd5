"""Per-row contributions and the top reasons derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.expressions import ColumnLike, as_column
from casewright.functions.reasons import describe_names, is_sensitive, reason_of
from casewright.operators.joins import attach_global, null_safe_lookup
from casewright.vocabulary import OTHER_FEATURE, OTHER_REASON


def feature_means(df: DataFrame, features: Sequence[str], digits: int | None = 6) -> DataFrame:
    """One row with the background mean of each feature."""
    means = {f: F.avg(f) for f in features}
    if digits is not None:
        means = {f: F.round(m, digits) for f, m in means.items()}
    return df.agg(*[m.alias(f"_mean_{f}") for f, m in means.items()])


def linear_contributions(
    df: DataFrame, coefficients: Mapping[str, float], background: DataFrame | None = None, digits: int | None = 6
) -> DataFrame:
    """Exact contributions of a linear model: ``coef * (x - mean)`` in columns ``contrib_<feature>``.

    Only the one-row means are rounded (to ``digits``), so that reruns order the features alike.
    """
    names = list(coefficients)
    with_means = attach_global(df, feature_means(background if background is not None else df, names, digits))
    parts = {
        f"contrib_{name}": F.lit(float(coef)) * (F.col(name).cast("double") - F.col(f"_mean_{name}"))
        for name, coef in coefficients.items()
    }
    return with_means.withColumns(parts).drop(*[f"_mean_{n}" for n in names])


def fallback_contributions(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """``x * weight`` when only importances or coefficients are known."""
    return df.withColumns(
        {f"contrib_{n}": F.col(n).cast("double") * F.lit(float(w)) for n, w in weights.items()}
    )


def long_contributions(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., feature, value, contribution): one row per entity and feature, one scan."""
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f).cast("double").alias("value"),
                F.col(f"contrib_{f}").alias("contribution"),
            )
            for f in features
        ]
    )
    return df.select(*keep, F.inline(rows))


def _reason_columns(picked: Sequence[tuple[Column, Column]]) -> list[Column]:
    raw = [F.coalesce(name, F.lit(OTHER_FEATURE)).alias(f"raw_feature_{i}") for i, (name, _) in enumerate(picked, 1)]
    text = [F.coalesce(reason, F.lit(OTHER_REASON)).alias(f"factor_{i}") for i, (_, reason) in enumerate(picked, 1)]
    return raw + text


def _sort_key(contribution: Column, positive_first: bool) -> list[Column]:
    tier = F.when(contribution > 0, 0).otherwise(1) if positive_first else F.lit(0)
    return [tier.alias("tier"), (-F.abs(contribution)).alias("weight")]


def _usable(names: Sequence[str], all_features: bool) -> tuple[list[str], list[str], dict[str, str]]:
    """Feature names in reverse order, the reasons in use, and the reason of each usable feature."""
    reason_by_name = {
        name: reason for name, reason, sensitive in describe_names(names)
        if all_features or not (sensitive or reason == OTHER_REASON)
    }
    return sorted(reason_by_name, reverse=True), list(dict.fromkeys(reason_by_name.values())), reason_by_name


def _entry(contribution: Column, positive_first: bool, place: Column, reason: Column) -> Column:
    """Sorts highest first: positive before the rest, then size, then the alphabetically first name."""
    positive = F.when(contribution > 0, 1).otherwise(0) if positive_first else F.lit(0)
    return F.struct(
        positive.alias("positive"), F.abs(contribution).alias("size"), place.alias("place"), reason.alias("reason")
    )


def _literals(values: Sequence[object]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def top_reasons_wide(
    df: DataFrame, contributions: Mapping[str, ColumnLike], keep: Sequence[str], k: int = 3,
    positive_first: bool = True, all_features: bool = False,
) -> DataFrame:
    """Top ``k`` distinct reasons per row, from contributions ``{feature name: column}``.

    Everything happens inside the row: no explode, no shuffle. Features that share a reason are reduced
    to their best one: positive contributions first, then the rest by size. Sensitive and unmapped
    features are skipped unless ``all_features``. The code does not grow with the number of features.
    """
    packed = df.select(*keep, F.array(*map(as_column, contributions.values())).alias("_contributions"))
    return top_reasons_array(packed, list(contributions), keep, "_contributions", k, positive_first, all_features)


def map_reasons(df: DataFrame, feature: str = "feature") -> DataFrame:
    """(feature, reason, sensitive) for the distinct feature names of a column."""
    return df.select(feature).distinct().withColumns(
        {"reason": reason_of(feature), "sensitive": is_sensitive(feature)}
    )


def top_reasons(
    contributions: DataFrame, key: str, k: int = 3, positive_first: bool = True, all_features: bool = False
) -> DataFrame:
    """Top ``k`` distinct reasons per entity from long rows (key, feature, contribution).

    Names are mapped once per distinct feature, not once per row. The best row per (entity, reason) is
    kept first, with map-side combine, so what is gathered per entity is bounded by the number of
    reasons in the vocabulary.
    """
    reasons = map_reasons(contributions)
    rows = null_safe_lookup(contributions, reasons, ["feature"])
    usable = F.col("contribution").isNotNull()
    if not all_features:
        usable = usable & (F.col("reason") != OTHER_REASON) & ~F.col("sensitive")
    # What cannot be a reason stays as a row without one, so that no entity is lost.
    best = rows.groupBy(key, F.when(usable, F.col("reason")).alias("reason")).agg(
        F.min(F.struct(*_sort_key(F.col("contribution"), positive_first), "feature")).alias("best")
    )
    named = F.when(F.col("reason").isNotNull(), F.struct("best.tier", "best.weight", "best.feature", "reason"))
    gathered = best.groupBy(key).agg(F.sort_array(F.collect_list(named)).alias("_sorted"))
    chosen = [(F.get("_sorted", F.lit(i))["feature"], F.get("_sorted", F.lit(i))["reason"]) for i in range(k)]
    return gathered.select(key, *_reason_columns(chosen))


def top_reasons_array(
    df: DataFrame, names: Sequence[str], keep: Sequence[str], array: str = "contributions", k: int = 3,
    positive_first: bool = True, all_features: bool = False,
) -> DataFrame:
    """Top reasons from an array of contributions, one entry per model feature in ``names`` order.

    For wide models: the code stays short however many features there are.
    """
    ordered_names, reasons, reason_by_name = _usable(names, all_features)
    places = _literals([ordered_names.index(n) if n in reason_by_name else -1 for n in names])
    numbers = _literals([reasons.index(reason_by_name[n]) if n in reason_by_name else -1 for n in names])
    entries = F.transform(
        F.col(array), lambda c, i: F.when(c.isNotNull(), _entry(c, positive_first, F.get(places, i), F.get(numbers, i)))
    )
    usable = F.filter(entries, lambda e: e["place"] >= 0)
    picked = df.select(*keep, F.sort_array(usable, asc=False).alias("_rest"))
    for i in range(k):
        picked = picked.withColumn(f"_pick{i}", F.get("_rest", F.lit(0)))
        picked = picked.withColumn("_rest", _other_reasons(F.col("_rest"), F.col(f"_pick{i}.reason")))
    chosen = [F.col(f"_pick{i}") for i in range(k)]
    return picked.select(*keep, *_reason_columns([
        (F.get(_literals(ordered_names or [None]), c["place"]).cast("string"),
         F.get(_literals(reasons or [None]), c["reason"]).cast("string")) for c in chosen
    ]))


def _other_reasons(entries: Column, reason: Column) -> Column:
    return F.filter(entries, lambda e: e["reason"] != reason)


def waterfall(contributions: DataFrame, key: str, base: float) -> DataFrame:
    """Contributions per entity by size, with the running total that starts at the base value."""
    order = [F.abs("contribution").desc_nulls_last(), F.col("feature").asc()]
    window = Window.partitionBy(key).orderBy(*order)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return contributions.select(
        key, "feature", "value", "contribution",
        F.row_number().over(window).cast("bigint").alias("step"),
        F.round(F.lit(float(base)) + F.sum("contribution").over(running), 4).alias("running_total"),
    )


def contribution_pct(contributions: DataFrame, score: str, digits: int = 2) -> DataFrame:
    """Contribution as a percentage of the prediction it explains."""
    share = F.round(F.try_divide(F.col("contribution"), F.col(score)) * F.lit(100.0), digits)
    return contributions.withColumn("contribution_pct", share)


def global_importance(contributions: DataFrame, digits: int = 4) -> DataFrame:
    """Mean absolute contribution per feature."""
    return contributions.groupBy("feature").agg(
        F.round(F.avg(F.abs("contribution")), digits).alias("mean_abs_contribution")
    )
