"""Row-wise building blocks: every function returns a Catalyst ``Column``, so it stays in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def add_all(columns: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left + right, columns)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike, empty: float = 0.0) -> Column:
    """Double division; a missing or non-positive denominator gives ``empty``."""
    over = as_column(denominator).cast("double")
    return F.when(over > 0, as_column(numerator).cast("double") / over).otherwise(F.lit(empty))


def null_ratio(
    numerator: ColumnLike, denominator: ColumnLike, scale: float = 1.0, digits: int | None = None
) -> Column:
    """Scaled division where a zero denominator gives NULL."""
    ratio = F.try_divide(
        F.lit(scale) * as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )
    return ratio if digits is None else F.round(ratio, digits)


def pooled_ratio(numerators: Sequence[ColumnLike], denominators: Sequence[ColumnLike]) -> Column:
    """Sum of parts over sum of wholes, 0 when there is no whole."""
    return safe_ratio(add_all(map(as_column, numerators)), add_all(map(as_column, denominators)))


COMPARISONS = {
    "<": lambda left, right: left < right,
    "<=": lambda left, right: left <= right,
    "==": lambda left, right: left == right,
    ">=": lambda left, right: left >= right,
    ">": lambda left, right: left > right,
}


def case_rules(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """First true condition wins; a NULL condition counts as not true."""
    (condition, label), *rest = rules
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def band(column: ColumnLike, cuts: Sequence[tuple[str, object, str]], default: str) -> Column:
    """Ordered threshold bands over one column, e.g. ``[(">=", 0.7, "high"), (">=", 0.4, "medium")]``."""
    value = as_column(column)
    return case_rules([(COMPARISONS[op](value, cut), label) for op, cut, label in cuts], default)


def flag(condition: Column) -> Column:
    """1 when the condition is true, 0 when it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def indicator_sum(conditions: Sequence[Column]) -> Column:
    return add_all(flag(condition) for condition in conditions)


def delta(later: ColumnLike, earlier: ColumnLike) -> Column:
    return as_column(later) - as_column(earlier)


def total(*columns: ColumnLike) -> Column:
    return add_all(map(as_column, columns))


def mean_of(*columns: ColumnLike) -> Column:
    return total(*columns) / F.lit(float(len(columns)))


def weighted_score(
    terms: Sequence[tuple[ColumnLike, float, float | None]], digits: int | None = 4
) -> Column:
    """Sum of ``weight * coalesce(column, default)``; a default of None lets NULL through."""
    parts = []
    for column, weight, default in terms:
        value = as_column(column).cast("double")
        if default is not None:
            value = F.coalesce(value, F.lit(float(default)))
        parts.append(value * F.lit(float(weight)))
    score = add_all(parts)
    return score if digits is None else F.round(score, digits)


def momentum_band(
    value_delta: ColumnLike, ratio_delta: ColumnLike, value_tolerance: float = 0.25, ratio_tolerance: float = 0.05
) -> Column:
    value, ratio = as_column(value_delta), as_column(ratio_delta)
    return case_rules(
        [
            ((value < 0) & (ratio < 0), "declining"),
            ((F.abs(value) < value_tolerance) & (F.abs(ratio) < ratio_tolerance), "stable"),
        ],
        "improving_or_mixed",
    )


def product(left: ColumnLike, right: ColumnLike, divisor: float | None = None, digits: int | None = None) -> Column:
    """Interaction of two columns, optionally scaled down and rounded."""
    value = as_column(left) * as_column(right)
    if divisor is not None:
        value = value / F.lit(float(divisor))
    return value if digits is None else F.round(value, digits)


def encode_target(column: ColumnLike, codes: Mapping[str, int], default: int | None = None) -> Column:
    """Label to integer code; anything outside ``codes`` becomes ``default``."""
    value = as_column(column)
    otherwise = F.lit(default).cast("int")
    return case_rules([(value == label, F.lit(code)) for label, code in codes.items()], otherwise)


def cross_attribute(columns: Sequence[ColumnLike], sep: str = "|", missing: str = "unknown") -> Column:
    """Intersection key of several attributes; a missing part is spelled out."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(missing)) for c in columns]
    return F.concat_ws(sep, *parts)
