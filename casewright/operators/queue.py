"""The ranked work queue and rule-based plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.actions import (
    confidence_band, intervention_tier, plan_actions, recommend_action,
)
from casewright.operators.dominance import best_fitting
from casewright.operators.joins import attach_global, catalog_index, left_join_default
from casewright.operators.ordering import priority_rank
from casewright.operators.statistics import global_max
from casewright.vocabulary import OTHER_REASON

FACTORS = ["factor_1", "factor_2", "factor_3"]


def decisions(
    scores: DataFrame, explanations: DataFrame, audit: DataFrame, as_of: Column,
    key: str = "entity_id", predicted: str = "predicted", actual: str = "actual",
    rule: Column | None = None,
) -> DataFrame:
    """Scores with bands, action, top reasons and the global review flag; a rank is carried along."""
    rank = [c for c in scores.columns if c == "priority_rank"]
    explained = left_join_default(
        scores.select(key, "risk_score", predicted, actual, *rank),
        explanations.select(key, *FACTORS), key, {f: OTHER_REASON for f in FACTORS},
    )
    review = global_max(audit, "fairness_review_flag")
    flagged = attach_global(explained, review)
    return flagged.select(
        key, "risk_score", predicted, actual,
        confidence_band("risk_score").alias("confidence_band"),
        intervention_tier("risk_score").alias("intervention_tier"),
        (rule if rule is not None else recommend_action("risk_score", FACTORS)).alias("recommended_action"),
        *[F.col(f).alias(f"top_risk_{f}") for f in FACTORS],
        "fairness_review_flag",
        *rank,
        as_of.alias("queue_ts"),
    )


def intervention_queue(
    scores: DataFrame, explanations: DataFrame, audit: DataFrame, as_of: Column,
    key: str = "entity_id", predicted: str = "predicted", actual: str = "actual",
    rule: Column | None = None,
) -> DataFrame:
    """The full queue: every scored entity with its decision and its place in the global order.

    The narrow scores are ranked first, so neither the range sampling nor the sort carries or computes
    explanations.
    """
    narrow = scores.select(key, "risk_score", predicted, actual)
    ranked = priority_rank(narrow, "risk_score", key, [F.col(predicted).desc_nulls_last()])
    return decisions(ranked, explanations, audit, as_of, key, predicted, actual, rule)


def intervention_plan(
    profile: DataFrame, catalog: DataFrame, key: str, risk: str, stress: str, grade: str, absences: str,
    failing: float = 10.0, good_rate: float = 0.7, cheap: float = 500.0,
) -> DataFrame:
    """Mandatory actions plus one fitting option: successful and cheap ones are preferred, then success."""
    limits = F.col(risk) + F.lit(0.15), F.col(stress) + F.lit(1)
    found = best_fitting(profile, catalog_index(catalog, 5), *limits, name="_best")
    # The choice is made inside the row; nothing is exploded or joined back.
    preferred = F.filter("_best", lambda o: (o["success_rate"] > good_rate) & (o["avg_cost"] < cheap))
    chosen = F.coalesce(F.get(preferred, F.lit(0)), F.get("_best", F.lit(0)))
    return found.select(
        key, F.concat_ws("|", plan_actions(stress, grade, absences, risk, failing)).alias("required_actions"),
        chosen["intervention_type"].alias("preferred_intervention"),
    )
