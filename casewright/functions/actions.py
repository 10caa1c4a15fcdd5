"""Action rules: ordered data compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright import vocabulary as v
from casewright.functions.expressions import (
    ColumnLike, any_of, as_column, band, case_rules, indicator_sum,
)

# Band cuts.
CONFIDENCE_CUTS = [(">=", 0.80, "high_confidence"), (">=", 0.60, "medium_confidence")]
TIER_CUTS = [(">=", 0.70, "high"), (">=", 0.40, "medium")]
RISK_LEVEL_CUTS = [(">", 0.7, "CRITICAL"), (">", 0.5, "HIGH")]

# Reason sets by domain. The first four count as domains, the others only qualify.
DOMAINS = {
    "financial": v.FINANCIAL_REASONS,
    "academic": v.ACADEMIC_REASONS,
    "engagement": v.ENGAGEMENT_REASONS,
    "context": v.CONTEXT_REASONS,
    "first_generation": v.FIRST_GENERATION_REASONS,
    "tough_course": v.TOUGH_COURSE_REASONS,
}
COUNTED_DOMAINS = ["financial", "academic", "engagement", "context"]

# Smallest score, smallest number of domains, required domains, action. First match wins.
ACTION_RULES = [
    (0.85, 2, [], "high_priority_case_review"),
    (0.75, 2, [], "coordinated_support_plan"),
    (0.60, 0, ["first_generation", "academic"], "mentorship_program_referral"),
    (0.70, 0, ["tough_course", "academic"], "course_pathway_review"),
    (0.70, 0, ["financial"], "financial_support_review"),
    (0.70, 0, ["academic"], "academic_tutoring_required"),
    (0.60, 0, ["engagement"], "attendance_reengagement"),
    (0.55, 0, [], "student_success_coaching"),
    (0.40, 0, [], "advisor_follow_up"),
]
NO_ACTION = "no_immediate_action"

# The five-outcome rule set.
BASIC_DOMAINS = {
    "financial": v.BASIC_FINANCIAL_REASONS,
    "academic": v.BASIC_ACADEMIC_REASONS,
    "engagement": v.BASIC_ENGAGEMENT_REASONS,
}
BASIC_RULES = [
    (0.70, 0, ["financial"], "financial_aid_counseling"),
    (0.70, 0, ["academic"], "academic_mentoring"),
    (0.60, 0, ["engagement"], "counselor_outreach"),
    (0.60, 0, [], "counselor_review"),
]
BASIC_DEFAULT = "monitor"

# Feature, comparison, cut, intervention, priority (1 urgent, 2 moderate, 3 monitor).
FACTOR_TABLE = [
    ("financial_stress_index", None, None, "Emergency Financial Aid + Counseling", 1),
    ("sem1_grade", "<", 10, "Tutoring Program + Study Groups", 1),
    ("sem1_approval_rate", "<", 50, "Academic Advisor Meeting + Support Plan", 1),
    ("sem1_absenteeism", ">", 3, "Attendance Tracking + Engagement Program", 2),
    ("is_high_rigor_course", None, None, "Course Transfer Option or Extra Support", 2),
    ("dropout_risk_sem1", "<", 0.3, "General Academic Success Workshops", 3),
]


def confidence_band(score: ColumnLike) -> Column:
    return band(score, CONFIDENCE_CUTS, "low_confidence")


def intervention_tier(score: ColumnLike) -> Column:
    return band(score, TIER_CUTS, "low")


def risk_level(score: ColumnLike) -> Column:
    return band(score, RISK_LEVEL_CUTS, "MEDIUM")


def recommend_action(
    score: ColumnLike,
    reasons: Sequence[ColumnLike],
    rules: Sequence[tuple] = ACTION_RULES,
    domains: dict[str, Sequence[str]] = DOMAINS,
    default: str = NO_ACTION,
    counted: Sequence[str] = COUNTED_DOMAINS,
) -> Column:
    """Recommended action for a score and its top reasons; a NULL score gets the default."""
    value = as_column(score)
    hit = {name: any_of(as_column(r).isin(*labels) for r in reasons) for name, labels in domains.items()}
    n_domains = indicator_sum([hit[name] for name in counted if name in hit])
    compiled = []
    for least, min_domains, required, action in rules:
        condition = value >= least
        if min_domains:
            condition = condition & (n_domains >= min_domains)
        for name in required:
            condition = condition & hit[name]
        compiled.append((condition, action))
    return case_rules(compiled, default)


def recommend_basic_action(score: ColumnLike, reasons: Sequence[ColumnLike]) -> Column:
    return recommend_action(score, reasons, BASIC_RULES, BASIC_DOMAINS, BASIC_DEFAULT)


def factor_intervention(feature: ColumnLike, value: ColumnLike) -> Column:
    """Struct (recommended_intervention, intervention_priority) for the leading factor and its value."""
    name, amount = as_column(feature), as_column(value)
    rules = []
    for key, op, cut, label, priority in FACTOR_TABLE:
        condition = name == key
        if op == "<":
            condition = condition & (amount < cut)
        elif op == ">":
            condition = condition & (amount > cut)
        rules.append((condition, (label, priority)))
    return F.struct(
        case_rules([(c, o[0]) for c, o in rules], None).alias("recommended_intervention"),
        case_rules([(c, o[1]) for c, o in rules], None).alias("intervention_priority"),
    )


def plan_actions(
    stress: ColumnLike, grade: ColumnLike, absences: ColumnLike, risk: ColumnLike, failing: float = 10.0
) -> Column:
    """Array of the actions every plan must contain, in fixed order."""
    wanted = [
        (as_column(stress) >= 2, "emergency_financial_aid"),
        (as_column(grade) < failing, "tutoring_or_reduced_load"),
        (as_column(absences) > 3, "counseling"),
        (as_column(risk) > 0.8, "human_counselor_review"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(label)) for c, label in wanted]), lambda x: x.isNotNull())
