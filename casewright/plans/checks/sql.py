"""Shared SQL fragments of the independent answers (DuckDB dialect)."""

from __future__ import annotations

from casewright.plans.proxy import COEFFICIENTS
from casewright.vocabulary import FEATURE_REASONS, INTERVENTIONS, SENSITIVE_FEATURES


def quoted(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def half_up(value: str, digits: int) -> str:
    """Rounding on the printed decimal digits, half away from zero, as Spark's ``round`` does it."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def values_table(name: str, columns: str, rows) -> str:
    body = ",\n ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


SUBJ = """per AS (
  SELECT l_orderkey AS entity_id,
    count(*) FILTER (WHERE l_linestatus = 'O') AS enr1,
    count(*) FILTER (WHERE l_linestatus = 'F') AS enr2,
    count(*) FILTER (WHERE l_linestatus = 'O' AND l_returnflag <> 'A') AS eval1,
    count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag <> 'A') AS eval2,
    count(*) FILTER (WHERE l_linestatus = 'O' AND l_quantity >= 20) AS appr1,
    count(*) FILTER (WHERE l_linestatus = 'F' AND l_quantity >= 20) AS appr2,
    count(*) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'A') AS noeval1,
    count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'A') AS noeval2,
    coalesce(avg(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS grade1,
    coalesce(avg(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS grade2
  FROM lineitem GROUP BY 1),
subj AS (
  SELECT o_orderkey AS entity_id, c_nationkey AS course, c_mktsegment AS segment,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS app_order,
    o_totalprice AS admission, c_acctbal AS prior_grade,
    CAST(c_custkey % 2 AS INTEGER) AS gender, CAST(17 + c_custkey % 40 AS INTEGER) AS age,
    CASE o_orderstatus WHEN 'F' THEN 'Dropout' WHEN 'P' THEN 'Enrolled' ELSE 'Graduate' END AS target,
    CAST(c_acctbal < 0 AS INTEGER) AS debtor,
    CAST(o_totalprice < 400000 AS INTEGER) AS paid,
    CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS scholar,
    per.* EXCLUDE (entity_id)
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN per ON per.entity_id = o_orderkey)"""

FEAT = SUBJ + """,
crs AS (
  SELECT course, round(avg((grade1 + grade2) / 2), 6) AS course_rigor_score,
    round(avg(admission), 6) AS competitive_density
  FROM subj GROUP BY course),
base AS (
  SELECT subj.*, crs.course_rigor_score, crs.competitive_density,
    CASE WHEN enr1 > 0 THEN appr1 / enr1 ELSE CAST(0 AS DOUBLE) END AS sem1_approval_ratio,
    CASE WHEN enr2 > 0 THEN appr2 / enr2 ELSE CAST(0 AS DOUBLE) END AS sem2_approval_ratio,
    CASE WHEN enr1 > 0 THEN eval1 / enr1 ELSE CAST(0 AS DOUBLE) END AS sem1_evaluation_ratio,
    CASE WHEN enr2 > 0 THEN eval2 / enr2 ELSE CAST(0 AS DOUBLE) END AS sem2_evaluation_ratio,
    CASE WHEN enr1 > 0 THEN noeval1 / enr1 ELSE CAST(0 AS DOUBLE) END AS sem1_non_evaluated_ratio,
    CASE WHEN enr2 > 0 THEN noeval2 / enr2 ELSE CAST(0 AS DOUBLE) END AS sem2_non_evaluated_ratio
  FROM subj JOIN crs ON crs.course IS NOT DISTINCT FROM subj.course),
cut AS (SELECT quantile_disc(course_rigor_score, 0.25) AS q25 FROM base),
feat0 AS (
  SELECT base.*,
    CASE WHEN debtor = 1 AND paid = 0 THEN 'high'
         WHEN debtor = 1 OR paid = 0 OR scholar = 0 THEN 'medium' ELSE 'low' END AS financial_risk_band,
    grade2 - grade1 AS sem_grade_delta,
    sem2_approval_ratio - sem1_approval_ratio AS sem_approval_delta,
    eval2 - eval1 AS evaluation_delta, noeval2 - noeval1 AS non_evaluated_delta,
    enr2 - enr1 AS academic_load_delta, (grade1 + grade2) / 2 AS overall_grade_avg,
    CASE WHEN enr1 + enr2 > 0 THEN (appr1 + appr2) / (enr1 + enr2) ELSE CAST(0 AS DOUBLE) END AS overall_approval_ratio,
    noeval1 + noeval2 AS absenteeism_index, appr1 + appr2 AS total_approved_units,
    CAST(debtor = 1 AS INTEGER) + CAST(paid = 0 AS INTEGER) + CAST(scholar = 0 AS INTEGER) AS financial_stress_index,
    CAST(coalesce(eval1 = 0, false) AS INTEGER) + CAST(coalesce(eval2 = 0, false) AS INTEGER)
      + CAST(coalesce(noeval1 > 0, false) AS INTEGER) + CAST(coalesce(noeval2 > 0, false) AS INTEGER) AS engagement_risk_proxy,
    CAST(coalesce(eval2 = 0 AND enr2 > 0, false) AS INTEGER) AS is_ghosting,
    CAST(app_order = 1 AS INTEGER) AS is_primary_choice,
    admission - course_rigor_score AS admission_gap,
    CAST(course_rigor_score < (SELECT q25 FROM cut) AS INTEGER) AS grade_deflation_flag
  FROM base),
feat AS (
  SELECT feat0.*,
    CASE WHEN financial_stress_index >= 2 THEN 'high_financial_stress'
         WHEN financial_stress_index = 1 THEN 'moderate_financial_stress'
         ELSE 'low_financial_stress' END AS financial_segment,
    CAST(coalesce(sem_grade_delta < 0, false) AS INTEGER) AS grade_drop_flag,
    CAST(coalesce(sem_approval_delta < 0, false) AS INTEGER) AS approval_drop_flag,
    CAST(coalesce(evaluation_delta < 0, false) AS INTEGER) AS engagement_drop_flag,
    CASE WHEN sem_grade_delta < 0 AND sem_approval_delta < 0 THEN 'declining'
         WHEN abs(sem_grade_delta) < 0.25 AND abs(sem_approval_delta) < 0.05 THEN 'stable'
         ELSE 'improving_or_mixed' END AS academic_momentum_band
  FROM feat0)"""

RISK = """CAST(financial_stress_index AS DOUBLE) * 0.25
      + coalesce(CAST({absences} AS DOUBLE), 0) * 0.15
      + (1 - {approval} / 100) * 0.30
      + CASE WHEN {grade} < 10 THEN CAST(0.2 AS DOUBLE) ELSE 0 END
      + CAST({rigor} AS DOUBLE) * 0.10"""


def risk(absences: str, approval: str, grade: str, rigor: str) -> str:
    return half_up(RISK.format(absences=absences, approval=approval, grade=grade, rigor=rigor), 4)


SCORED = FEAT + f""",
scored AS (
  SELECT feat.*, r.risk_score, CAST(r.risk_score >= 0.5 AS INTEGER) AS predicted,
    CAST(target = 'Dropout' AS INTEGER) AS actual
  FROM feat JOIN (
    SELECT entity_id, least(1.0, {risk('absenteeism_index', half_up('overall_approval_ratio * 100', 2), 'overall_grade_avg', 'grade_deflation_flag')}) AS risk_score
    FROM feat) r USING (entity_id))"""

REASONS = values_table(
    "reasons", "ordinal, key, reason", [(i, k, r) for i, (k, r) in enumerate(FEATURE_REASONS)]
)
CATALOG = values_table(
    "catalog",
    "intervention_type, success_rate, avg_cost, financial_stress_level, risk_score_threshold, description, category",
    INTERVENTIONS,
)

CONTRIB = SCORED + ",\nmeans AS (SELECT " + ", ".join(
    f"round(avg({c}), 6) AS m_{c}" for c in COEFFICIENTS
) + " FROM scored),\nexplained AS (SELECT * FROM scored WHERE predicted = 1),\ncontrib AS (\n" + "\nUNION ALL\n".join(
    f"  SELECT entity_id, risk_score, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
    f"CAST({w} AS DOUBLE) * (CAST({c} AS DOUBLE) - m_{c}) AS contribution FROM explained, means"
    for c, w in COEFFICIENTS.items()
) + ")"

TOP = CONTRIB + ",\n" + REASONS + """,
eligible AS (
  SELECT entity_id, 'num__' || feature AS feature, reason, contribution,
    CASE WHEN contribution > 0 THEN 0 ELSE 1 END AS tier, abs(contribution) AS weight
  FROM contrib JOIN reasons ON key = feature
  WHERE contribution IS NOT NULL AND feature NOT IN """ + in_list(SENSITIVE_FEATURES) + """),
once AS (
  SELECT * FROM eligible
  QUALIFY row_number() OVER (PARTITION BY entity_id, reason ORDER BY tier, weight DESC, feature) = 1),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY tier, weight DESC, feature) AS pos FROM once),
top AS (
  SELECT e.entity_id, e.risk_score,
    coalesce(max(p.feature) FILTER (WHERE pos = 1), 'other_model_signal') AS raw_feature_1,
    coalesce(max(p.feature) FILTER (WHERE pos = 2), 'other_model_signal') AS raw_feature_2,
    coalesce(max(p.feature) FILTER (WHERE pos = 3), 'other_model_signal') AS raw_feature_3,
    coalesce(max(p.reason) FILTER (WHERE pos = 1), 'Other model risk signal') AS factor_1,
    coalesce(max(p.reason) FILTER (WHERE pos = 2), 'Other model risk signal') AS factor_2,
    coalesce(max(p.reason) FILTER (WHERE pos = 3), 'Other model risk signal') AS factor_3
  FROM explained e LEFT JOIN placed p ON p.entity_id = e.entity_id
  GROUP BY e.entity_id, e.risk_score)"""


def rates_cte(source: str, attributes, name: str = "rates") -> str:
    """Confusion counts and rates per (attribute, group), one branch per attribute."""
    branches = "\n UNION ALL\n".join(
        f" SELECT '{a}' AS protected_attribute, CAST({a} AS VARCHAR) AS group_name, actual, predicted FROM {source}"
        for a in attributes
    )
    return f"""{name}_long AS (
{branches}),
{name}_n AS (
  SELECT protected_attribute, group_name, count(*) AS population_count,
    count(*) FILTER (WHERE actual = 1 AND predicted = 1) AS tp,
    count(*) FILTER (WHERE actual = 0 AND predicted = 1) AS fp,
    count(*) FILTER (WHERE actual = 1 AND predicted = 0) AS fn,
    count(*) FILTER (WHERE actual = 0 AND predicted = 0) AS tn
  FROM {name}_long GROUP BY 1, 2),
{name} AS (
  SELECT *, (tp + fp) / population_count AS selection_rate,
    coalesce(tp / nullif(tp + fn, 0), 0) AS true_positive_rate,
    coalesce(fp / nullif(fp + tn, 0), 0) AS false_positive_rate,
    (tp + tn) / population_count AS accuracy,
    coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(fn / nullif(tp + fn, 0), 0) AS false_negative_rate
  FROM {name}_n)"""


def parity_cte(rates: str = "rates", name: str = "par") -> str:
    return f"""{name} AS (
  SELECT protected_attribute,
    max(selection_rate) - min(selection_rate) AS demographic_parity_difference,
    min(selection_rate) / nullif(max(selection_rate), 0) AS demographic_parity_ratio,
    max(true_positive_rate) - min(true_positive_rate) AS equal_opportunity_difference,
    min(true_positive_rate) / nullif(max(true_positive_rate), 0) AS equal_opportunity_ratio,
    greatest(max(true_positive_rate) - min(true_positive_rate),
             max(false_positive_rate) - min(false_positive_rate)) AS equalized_odds_difference,
    least(min(true_positive_rate) / nullif(max(true_positive_rate), 0),
          min(false_positive_rate) / nullif(max(false_positive_rate), 0)) AS equalized_odds_ratio
  FROM {rates} GROUP BY 1)"""


AUDIT_SRC = """asrc AS (
  SELECT *, gender || '|' || financial_segment AS gender_x_financial_segment FROM scored)"""
AUDITED = ["gender", "financial_segment", "scholar", "gender_x_financial_segment"]
AUDIT = AUDIT_SRC + ",\n" + rates_cte("asrc", AUDITED) + ",\n" + parity_cte() + """,
audit AS (
  SELECT 'composite_risk' AS model_name, protected_attribute, group_name, population_count,
    selection_rate, true_positive_rate, false_positive_rate, par.* EXCLUDE (protected_attribute),
    CAST(abs(demographic_parity_difference) > 0.1 OR abs(equal_opportunity_difference) > 0.1
      OR abs(equalized_odds_difference) > 0.1 AS INTEGER) AS fairness_review_flag,
    '2024-01-31 00:00:00' AS audit_ts
  FROM rates JOIN par USING (protected_attribute))"""


def action_case(score: str, factors) -> str:
    """The ten-way rule set spelled out by hand."""
    from casewright import vocabulary as v

    def hit(labels) -> str:
        return "(" + " OR ".join(f"{f} IN {in_list(labels)}" for f in factors) + ")"

    fin, aca = hit(v.FINANCIAL_REASONS), hit(v.ACADEMIC_REASONS)
    eng, ctx = hit(v.ENGAGEMENT_REASONS), hit(v.CONTEXT_REASONS)
    first, tough = hit(v.FIRST_GENERATION_REASONS), hit(v.TOUGH_COURSE_REASONS)
    n = f"(CAST({fin} AS INTEGER) + CAST({aca} AS INTEGER) + CAST({eng} AS INTEGER) + CAST({ctx} AS INTEGER))"
    return f"""CASE WHEN {score} >= 0.85 AND {n} >= 2 THEN 'high_priority_case_review'
  WHEN {score} >= 0.75 AND {n} >= 2 THEN 'coordinated_support_plan'
  WHEN {score} >= 0.60 AND {first} AND {aca} THEN 'mentorship_program_referral'
  WHEN {score} >= 0.70 AND {tough} AND {aca} THEN 'course_pathway_review'
  WHEN {score} >= 0.70 AND {fin} THEN 'financial_support_review'
  WHEN {score} >= 0.70 AND {aca} THEN 'academic_tutoring_required'
  WHEN {score} >= 0.60 AND {eng} THEN 'attendance_reengagement'
  WHEN {score} >= 0.55 THEN 'student_success_coaching'
  WHEN {score} >= 0.40 THEN 'advisor_follow_up' ELSE 'no_immediate_action' END"""


QUEUE = TOP + ",\n" + AUDIT + """,
joined AS (
  SELECT s.entity_id, s.risk_score, s.predicted, s.actual,
    coalesce(factor_1, 'Other model risk signal') AS top_risk_factor_1,
    coalesce(factor_2, 'Other model risk signal') AS top_risk_factor_2,
    coalesce(factor_3, 'Other model risk signal') AS top_risk_factor_3
  FROM scored s LEFT JOIN top t ON t.entity_id = s.entity_id),
queue AS (
  SELECT *,
    CASE WHEN risk_score >= 0.8 THEN 'high_confidence' WHEN risk_score >= 0.6 THEN 'medium_confidence'
         ELSE 'low_confidence' END AS confidence_band,
    CASE WHEN risk_score >= 0.7 THEN 'high' WHEN risk_score >= 0.4 THEN 'medium' ELSE 'low' END AS intervention_tier,
    """ + action_case("risk_score", ["top_risk_factor_1", "top_risk_factor_2", "top_risk_factor_3"]) + """ AS recommended_action,
    (SELECT max(fairness_review_flag) FROM audit) AS fairness_review_flag,
    row_number() OVER (ORDER BY risk_score DESC, predicted DESC, entity_id) AS priority_rank,
    TIMESTAMP '2024-01-31 00:00:00' AS queue_ts
  FROM joined)"""
