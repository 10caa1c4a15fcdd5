"""Text and JSON payloads built inside the plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.actions import risk_level
from casewright.functions.expressions import ColumnLike, as_column

# Alert wording.
ALERT_SUBJECT = "Student Risk Alert: Student %d score %s"
ALERT_BODY = (
    "Hello %s,\n\n"
    "This is an automated student risk alert generated from the dropout monitoring workflow.\n\n"
    "Student ID: %d\n"
    "Risk score: %s\n"
    "Recommended action: %s\n"
    "Top reasons:\n1. %s\n2. %s\n3. %s\n\n"
    "Queue timestamp: %s\n\n"
    "Please review the student record and take the recommended next step.\n"
)


def render(template: str, *arguments: ColumnLike) -> Column:
    """printf-style text; needs no Python worker."""
    return F.format_string(template, *[as_column(a) for a in arguments])


def fixed_point(value: ColumnLike) -> Column:
    """``%.3f`` of a double as C and SQL engines print it: the stored binary value rounded, a tie to the even digit.

    ``format_string`` rounds the shortest printed digits half up instead (0.1235 is stored as less, 0.3125 is a tie). The product
    with 1000 is taken exactly, as a double and what it is off by, so the comparison with one half is exact too.
    """
    given = as_column(value).cast("double")
    x = F.abs(given)
    high = x * 134217729.0 - (x * 134217729.0 - x)  # the upper 26 bits
    product = x * 1000.0
    off = (high * 1000.0 - product) + (x - high) * 1000.0
    whole = F.floor(product)
    beyond_half = (product - whole) - 0.5 + off
    up = (beyond_half > 0) | ((beyond_half == 0) & (whole % 2 == 1))
    digits = whole + F.when(up, 1).otherwise(0)
    text = F.format_string("%s%d.%03d", F.when(F.startswith(given.cast("string"), F.lit("-")), "-").otherwise(""), ((digits - digits % 1000) / 1000).cast("bigint"), digits % 1000)
    # From 2^42 on the product is no longer exact; such numbers keep the shortest digits.
    return F.when(x < float(1 << 42), text).when(given.isNotNull(), F.format_string("%.3f", given))


def alert_subject(entity: ColumnLike, score: ColumnLike) -> Column:
    """NULL without an entity or a score."""
    known = as_column(entity).isNotNull() & as_column(score).isNotNull()
    return F.when(known, render(ALERT_SUBJECT, entity, fixed_point(score)))


def alert_body(
    recipient: ColumnLike, entity: ColumnLike, score: ColumnLike, action: ColumnLike,
    reasons: Sequence[ColumnLike], queued_at: ColumnLike,
) -> Column:
    stamp = F.date_format(as_column(queued_at), "yyyy-MM-dd HH:mm:ss")
    return render(ALERT_BODY, recipient, entity, fixed_point(score), action, *reasons, stamp)


def explain_payload(
    entity: ColumnLike,
    score: ColumnLike,
    base: ColumnLike,
    features: Mapping[str, ColumnLike],
    top: Sequence[tuple[ColumnLike, ColumnLike, ColumnLike]],
) -> Column:
    """JSON document for one entity: prediction, feature values and leading factors.

    ``top`` holds (feature name, current value, contribution) column triples.
    """
    value = as_column(score)
    factors = [
        F.struct(
            as_column(name).alias("feature"),
            as_column(current).cast("double").alias("current_value"),
            as_column(impact).cast("double").alias("shap_impact"),
            (F.try_divide(as_column(impact), value) * F.lit(100.0)).alias("contribution_pct"),
        )
        for name, current, impact in top
    ]
    return F.to_json(
        F.struct(
            as_column(entity).cast("string").alias("student_id"),
            F.struct(
                value.cast("double").alias("dropout_probability"),
                risk_level(value).alias("risk_level"),
                as_column(base).cast("double").alias("base_risk"),
            ).alias("prediction"),
            F.struct(*[as_column(c).alias(n) for n, c in features.items()]).alias("student_features"),
            F.struct(F.array(*factors).alias("top_3_risk_factors")).alias("shap_explanation"),
        )
    )
