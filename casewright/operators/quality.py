"""Declarative data-quality rules with explicit three-valued logic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.expressions import any_of


class Rule(NamedTuple):
    """A named condition that is true for a violating row. Rules that are not enforced only report."""

    name: str
    violated: Column
    enforce: bool = True


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def rule_in_set(name: str, columns: Sequence[str], allowed: Sequence[object]) -> Rule:
    return Rule(name, any_of(~F.col(c).isin(*allowed) for c in columns))


def rule_min(name: str, columns: Sequence[str], least: float = 0) -> Rule:
    return Rule(name, any_of(F.col(c) < least for c in columns))


def rule_le(name: str, parts: Sequence[str], whole: str) -> Rule:
    return Rule(name, any_of(F.col(p) > F.col(whole) for p in parts))


def rule_between(name: str, column: str, low: float, high: float, enforce: bool = True) -> Rule:
    return Rule(name, (F.col(column) < low) | (F.col(column) > high), enforce)


def with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One boolean column per rule (NULL where it cannot be decided)."""
    return df.withColumns({rule.name: rule.violated for rule in rules})


def verdict(rules: Sequence[Rule]) -> Column:
    """True if any enforced rule is violated, NULL if that cannot be decided."""
    return any_of(rule.violated for rule in rules if rule.enforce)


def apply_rules(df: DataFrame, rules: Sequence[Rule], on_null: str = "drop") -> DataFrame:
    """Rows that pass. ``on_null`` decides about rows without a verdict: ``drop`` or ``keep``."""
    bad = verdict(rules)
    if on_null == "keep":
        return df.where(~F.coalesce(bad, F.lit(False)))
    if on_null == "drop":
        return df.where(~bad)
    raise ValueError(f"on_null must be 'drop' or 'keep', not {on_null!r}")


def quarantine(df: DataFrame, rules: Sequence[Rule], undecided: str = "undecided") -> DataFrame:
    """The rows ``apply_rules`` drops, with the names of the rules they break.

    A row without a verdict is listed as ``undecided``.
    """
    enforced = [rule for rule in rules if rule.enforce]
    failed = F.array_compact(F.array(*[F.when(r.violated, F.lit(r.name)) for r in enforced]))
    bad = verdict(rules)
    return df.where(F.coalesce(bad, F.lit(True))).withColumn(
        "failed_rules", F.when(bad, failed).otherwise(F.array(F.lit(undecided)))
    )


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: violations per rule, and rows dropped only because no verdict was possible."""
    counts = [F.count_if(rule.violated).alias(f"{rule.name}_rows") for rule in rules]
    return df.agg(*counts, F.count_if(verdict(rules).isNull()).alias("undecided_rows"))


def null_audit(df: DataFrame, columns: Sequence[str], long: bool = False) -> DataFrame:
    """NULL count per column: one wide row, or (column_name, null_rows) rows."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_rows") if long else wide


def profile(df: DataFrame, sums: Sequence[str] = (), averages: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Row count, totals of flag columns and averages of measures in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.sum(c).alias(f"sum_{c}") for c in sums],
        *[F.round(F.avg(c), digits).alias(f"avg_{c}") for c in averages],
    )


def layer_summary(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per layer."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("layer"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in layers.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def reconcile_counts(layers: Mapping[str, DataFrame], reference: str) -> DataFrame:
    """Row count per layer against the reference layer."""
    summary = layer_summary(layers).drop("n_columns")
    expected = layers[reference].agg(F.count(F.lit(1)).alias("n"))
    return summary.withColumn("missing_rows", expected.scalar() - F.col("n_rows")).withColumn(
        "matches", F.when(F.col("missing_rows") == 0, 1).otherwise(0)
    )
