"""Aggregations, group statistics and report shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.operators.joins import null_safe_lookup
from casewright.operators.ordering import top_n


def group_count(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def global_max(df: DataFrame, column: str, default: int = 0, name: str | None = None) -> DataFrame:
    """One row with the largest value, NULL counting as ``default``."""
    return df.agg(F.max(F.coalesce(F.col(column), F.lit(default))).alias(name or column))


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(condition).alias(name))


def _percent(count: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * count / whole, digits)


def share_summary(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Count, share of all rows, and average / smallest / largest measure per key.

    The share is a window over the aggregated rows, one row per key value.
    """
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(measure), 4).alias(f"avg_{measure}"),
        F.round(F.min(measure), 4).alias(f"min_{measure}"),
        F.round(F.max(measure), 4).alias(f"max_{measure}"),
    )
    everything = F.sum("n").over(Window.partitionBy())
    return grouped.withColumn("pct_of_total", _percent(F.col("n"), everything))


def share_within(df: DataFrame, outer: str, inner: str, measure: str) -> DataFrame:
    """Two-key summary with the share inside the first key."""
    grouped = df.groupBy(outer, inner).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(measure), 4).alias(f"avg_{measure}")
    )
    inside = F.sum("n").over(Window.partitionBy(outer))
    return grouped.withColumn(f"pct_within_{outer}", _percent(F.col("n"), inside))


def long_factors(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (entity, position): the factor columns unpivoted in a single scan."""
    return df.unpivot(list(keep), list(columns), "position", "factor")


def factor_frequency(df: DataFrame, columns: Sequence[str], measure: str) -> DataFrame:
    """How often each factor occurs in each position, with the average measure."""
    return (
        long_factors(df, columns, [measure])
        .groupBy("position", "factor")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(measure), 3).alias(f"avg_{measure}"))
    )


def combination_top(df: DataFrame, columns: Sequence[str], measure: str, action: str, n: int) -> DataFrame:
    """Most frequent factor combinations with their usual action and their share of all rows.

    The usual action is the most frequent one, alphabetical on ties, so the result is repeatable.
    Counting per (combination, action) first keeps the second grouping small.
    """
    per_action = df.groupBy(*columns, action).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_sum"), F.count(measure).alias("_m")
    )
    combos = per_action.groupBy(*columns).agg(
        F.sum("_n").alias("n"),
        F.round(F.sum("_sum") / F.sum("_m"), 4).alias(f"avg_{measure}"),
        F.min_by(action, F.struct(-F.col("_n"), F.col(action))).alias("typical_action"),
    )
    everything = per_action.agg(F.sum("_n").alias("t")).scalar()
    shared = combos.withColumn("pct_of_total", _percent(F.col("n"), everything))
    return top_n(shared, [F.col("n").desc(), *[F.col(c).asc_nulls_last() for c in columns]], n)


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return top_n(counts, [F.col("n").desc(), F.col(column).asc_nulls_last()], n)


def group_stats(
    df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column], digits: int | Mapping[str, int] | None = 6,
    rows: str | None = None,
) -> DataFrame:
    """One row per group with averages of expressions, and with its number of ``rows`` under that name.

    Averages are rounded so that a later comparison between two groups does not hinge on the order
    in which partial sums were merged. ``digits`` is one number or one per statistic.
    """
    values = {name: F.avg(expr) for name, expr in stats.items()}
    if digits is not None:
        places = digits if isinstance(digits, Mapping) else dict.fromkeys(stats, digits)
        values = {name: F.round(value, places[name]) for name, value in values.items()}
    if rows is not None:
        values[rows] = F.count(F.lit(1))
    return df.groupBy(*keys).agg(*[value.alias(name) for name, value in values.items()])


def with_group_stats(
    df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column],
    digits: int | Mapping[str, int] | None = 6, fit_on: DataFrame | None = None,
) -> DataFrame:
    """Group averages on every row.

    Aggregates first (map-side combine) and joins the small result back with null-safe equality, so a
    group that holds a third of the rows never has to fit in one task. ``fit_on`` takes the averages
    from other rows, e.g. the training part.
    """
    source = df if fit_on is None else fit_on
    return null_safe_lookup(df, group_stats(source, keys, stats, digits), keys)


def with_leave_one_out_mean(
    df: DataFrame, keys: Sequence[str], value: str, name: str, digits: int | None = 6
) -> DataFrame:
    """Mean of the other rows of the group; NULL when the row is alone or has no value of its own."""
    sums = df.groupBy(*keys).agg(
        F.sum(value).cast("double").alias("_sum"), F.count(value).alias("_n")
    )
    joined = null_safe_lookup(df, sums, keys)
    mean = F.try_divide(F.col("_sum") - F.col(value), (F.col("_n") - 1).cast("double"))
    if digits is not None:
        mean = F.round(mean, digits)
    return joined.withColumn(name, mean).drop("_sum", "_n")


def gap_to_group(
    df: DataFrame, keys: Sequence[str], column: str, group_value: Column, name: str, digits: int | None = None
) -> DataFrame:
    """Distance of a column from the group's mean of another expression; the caller picks both."""
    joined = with_group_stats(df, keys, {"_mean": group_value})
    gap = F.col(column) - F.col("_mean")
    return joined.withColumn(name, gap if digits is None else F.round(gap, digits)).drop("_mean")


def below_quantile_flag(df: DataFrame, column: str, cut: DataFrame | Column, name: str) -> DataFrame:
    """1 where the column is below a quantile (a one-row table or a value), else 0."""
    limit = cut if isinstance(cut, Column) else cut.scalar()
    return df.withColumn(name, F.when(F.col(column) < limit, 1).otherwise(0))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, their share, and how many other rows there are for each row of the class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = F.sum("n").over(Window.partitionBy())
    return counts.withColumns(
        {
            "share": F.round(F.col("n") / everything, 4),
            "rest_per_row": F.round((everything - F.col("n")) / F.col("n"), 2),
        }
    )


def score_by_outcome(df: DataFrame, outcome: str, score: str) -> DataFrame:
    return df.groupBy(outcome).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(score), 4).alias(f"avg_{score}")
    )


def stack_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """Put reports of the same shape under each other."""
    first, *rest = reports
    for report in rest:
        first = first.unionByName(report)
    return first
