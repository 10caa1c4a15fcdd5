"""Row-wise expressions, feature formulas and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.functions import expressions as x
from casewright.functions import messages
from casewright.operators.explain import long_contributions
from casewright.plans import features as f
from casewright.plans.checks.registry import check
from casewright.plans.checks.sql import CONTRIB, FEAT, SCORED, SUBJ, half_up, risk
from casewright.plans.proxy import (
    COEFFICIENTS, FIRST, MONEY, SECOND, SUBJECT, entity_table, explained_rows,
    feature_rows, score_columns, scored_rows, subjects, table,
)
from casewright.session import staged


@check("safe_ratio", f"""WITH {SUBJ} SELECT entity_id,
  CASE WHEN enr1 > 0 THEN round(appr1 / enr1, 6) ELSE 0.0 END AS first_ratio,
  CASE WHEN enr2 > 0 THEN round(noeval2 / enr2, 6) ELSE 0.0 END AS second_ratio FROM subj""")
def safe_ratio(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", F.round(x.safe_ratio("appr1", "enr1"), 6).alias("first_ratio"),
        F.round(x.safe_ratio("noeval2", "enr2"), 6).alias("second_ratio"),
    )


@check("null_ratio", f"""WITH {SUBJ} SELECT entity_id,
  round(100.0 * appr1 / nullif(enr1, 0), 2) AS approval_rate,
  round(eval1 / nullif(enr1, 0), 4) AS evaluation_rate FROM subj""")
def null_ratio(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", x.null_ratio("appr1", "enr1", 100.0, 2).alias("approval_rate"),
        x.null_ratio("eval1", "enr1", 1.0, 4).alias("evaluation_rate"),
    )


@check("threshold_bands", """SELECT c_custkey,
  CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 1000 THEN 'medium' ELSE 'low' END AS balance_band,
  CASE WHEN 17 + c_custkey % 40 <= 20 THEN 'Teen' WHEN 17 + c_custkey % 40 <= 25 THEN 'Young_Adult'
       WHEN 17 + c_custkey % 40 <= 35 THEN 'Adult' ELSE 'Mature' END AS age_group FROM customer""")
def threshold_bands(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("age", F.lit(17) + F.col("c_custkey") % 40)
    return rows.select(
        "c_custkey", x.band("c_acctbal", [(">=", 5000, "high"), (">=", 1000, "medium")], "low").alias("balance_band"),
        f.age_group("age").alias("age_group"),
    )


@check("rule_bands", f"""WITH {SUBJ} SELECT entity_id,
  CASE WHEN debtor = 1 AND paid = 0 THEN 'high'
       WHEN debtor = 1 OR paid = 0 OR scholar = 0 THEN 'medium' ELSE 'low' END AS financial_risk_band FROM subj""")
def rule_bands(spark, sf_dir):
    return subjects(spark, sf_dir).select("entity_id", f.financial_risk_band(MONEY).alias("financial_risk_band"))


@check("indicator_index", f"""WITH {SUBJ} SELECT entity_id,
  CAST(debtor = 1 AS INTEGER) + CAST(paid = 0 AS INTEGER) + CAST(scholar = 0 AS INTEGER) AS financial_stress_index,
  (CASE WHEN eval1 = 0 THEN 1 ELSE 0 END) + (CASE WHEN eval2 = 0 THEN 1 ELSE 0 END)
   + (CASE WHEN noeval1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN noeval2 > 0 THEN 1 ELSE 0 END) AS engagement_risk_proxy
  FROM subj""")
def indicator_index(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", f.financial_stress(MONEY).alias("financial_stress_index"),
        f.engagement_risk(FIRST, SECOND).alias("engagement_risk_proxy"),
    )


@check("weighted_score", f"""WITH {SUBJ} SELECT entity_id,
  round(coalesce(debtor, 0) * CAST(2.0 AS DOUBLE) + (1 - coalesce(paid, 1)) * CAST(1.5 AS DOUBLE)
    + (1 - coalesce(scholar, 0)) * CAST(0.5 AS DOUBLE), 4) AS financial_risk_score,
  round(coalesce(grade1, 0) * CAST(0.5 AS DOUBLE) + coalesce(grade2, 0) * CAST(0.3 AS DOUBLE)
    + coalesce(enr1, 0) * CAST(-0.2 AS DOUBLE), 4) AS macro_style_score FROM subj""")
def weighted_score(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", f.financial_risk_score(MONEY).alias("financial_risk_score"),
        f.macro_risk_score("grade1", "grade2", "enr1").alias("macro_style_score"),
    )


@check("period_deltas", f"""WITH {SUBJ} SELECT entity_id, round(grade2 - grade1, 4) AS grade_delta,
  eval2 - eval1 AS evaluation_delta, enr2 - enr1 AS load_delta FROM subj""")
def period_deltas(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", F.round(x.delta("grade2", "grade1"), 4).alias("grade_delta"),
        x.delta("eval2", "eval1").alias("evaluation_delta"), x.delta("enr2", "enr1").alias("load_delta"),
    )


@check("period_means", f"""WITH {SUBJ} SELECT entity_id, round((grade1 + grade2) / 2, 4) AS mean_grade,
  noeval1 + noeval2 AS absences, appr1 + appr2 AS approved FROM subj""")
def period_means(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", F.round(x.mean_of("grade1", "grade2"), 4).alias("mean_grade"),
        x.total("noeval1", "noeval2").alias("absences"), x.total("appr1", "appr2").alias("approved"),
    )


@check("pooled_ratio", f"""WITH {SUBJ} SELECT entity_id,
  CASE WHEN enr1 + enr2 > 0 THEN round((appr1 + appr2) / (enr1 + enr2), 6) ELSE 0.0 END AS approval FROM subj""")
def pooled_ratio(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", F.round(x.pooled_ratio(["appr1", "appr2"], ["enr1", "enr2"]), 6).alias("approval")
    )


@check("directional_flags", f"""WITH {FEAT} SELECT entity_id, grade_drop_flag, approval_drop_flag,
  engagement_drop_flag, is_ghosting, is_primary_choice FROM feat""")
def directional_flags(spark, sf_dir):
    rows = subjects(spark, sf_dir).withColumns(f.ratio_columns(FIRST, SECOND)).withColumns(f.change_columns(FIRST, SECOND))
    return rows.select("entity_id", *[c.alias(n) for n, c in f.flag_columns(SECOND, "app_order").items()])


@check("momentum_band", f"WITH {FEAT} SELECT entity_id, academic_momentum_band FROM feat")
def momentum_band(spark, sf_dir):
    rows = subjects(spark, sf_dir).withColumns(f.ratio_columns(FIRST, SECOND)).withColumns(f.change_columns(FIRST, SECOND))
    return rows.select("entity_id", x.momentum_band("sem_grade_delta", "sem_approval_delta").alias("academic_momentum_band"))


@check("interactions", f"""WITH {SUBJ} SELECT entity_id, debtor * scholar AS stress_x_support,
  CASE WHEN grade1 < 10 AND noeval1 > 0 THEN 1 ELSE 0 END AS low_grade_absent,
  round(age * noeval1 / CAST(100 AS DOUBLE), 2) AS age_x_absence FROM subj""")
def interactions(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", x.product("debtor", "scholar").alias("stress_x_support"),
        x.flag((F.col("grade1") < 10) & (F.col("noeval1") > 0)).alias("low_grade_absent"),
        x.product("age", "noeval1", 100, 2).alias("age_x_absence"),
    )


@check("composite_risk", f"WITH {SCORED} SELECT entity_id, risk_score, predicted, actual FROM scored")
def composite_risk(spark, sf_dir):
    return scored_rows(spark, sf_dir).select("entity_id", "risk_score", "predicted", "actual")


@check("encode_target", f"""WITH {SUBJ} SELECT entity_id, CAST(target = 'Dropout' AS INTEGER) AS target_binary,
  CASE target WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 ELSE 2 END AS target_multiclass FROM subj""")
def encode_target(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", x.flag(F.col("target") == "Dropout").alias("target_binary"),
        x.encode_target("target", f.OUTCOME_CODES).alias("target_multiclass"),
    )


@check("cross_attribute", f"""WITH {SUBJ} SELECT entity_id,
  gender || '|' || coalesce(CAST(enr1 AS VARCHAR), 'unknown') || '|' || segment AS cross_key FROM subj""")
def cross_attribute(spark, sf_dir):
    return subjects(spark, sf_dir).select(
        "entity_id", x.cross_attribute(["gender", "enr1", "segment"]).alias("cross_key")
    )


FEATURE_COLUMNS = [
    "financial_risk_band", "evaluation_delta", "non_evaluated_delta", "academic_load_delta", "absenteeism_index",
    "total_approved_units", "financial_stress_index", "financial_segment", "engagement_risk_proxy",
    "academic_momentum_band", "grade_drop_flag", "approval_drop_flag", "engagement_drop_flag", "is_ghosting",
    "is_primary_choice", "grade_deflation_flag",
]
FEATURE_DOUBLES = [
    "sem1_approval_ratio", "sem2_approval_ratio", "sem1_evaluation_ratio", "sem2_evaluation_ratio",
    "sem1_non_evaluated_ratio", "sem2_non_evaluated_ratio", "sem_grade_delta", "sem_approval_delta",
    "overall_grade_avg", "overall_approval_ratio", "course_rigor_score", "competitive_density", "admission_gap",
]


@check("feature_table", f"WITH {FEAT} SELECT entity_id, " + ", ".join(FEATURE_COLUMNS) + ", "
       + ", ".join(f"{half_up(c, 4)} AS {c}" for c in FEATURE_DOUBLES) + " FROM feat")
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir).select(
        "entity_id", *FEATURE_COLUMNS, *[F.round(c, 4).alias(c) for c in FEATURE_DOUBLES]
    )


HORIZON = SUBJ + f""",
cs AS (
  SELECT course, round(avg(grade1), 2) AS course_avg_grade_sem1,
    round(avg((grade1 + grade2) / 2), 2) AS course_avg_grade_overall,
    round(avg(100.0 * appr1 / CASE WHEN enr1 = 0 THEN 1 ELSE enr1 END), 2) AS course_approval_rate,
    round(avg(admission), 2) AS competitive_density,
    round(avg(CASE WHEN target = 'Dropout' THEN CAST(1 AS DOUBLE) ELSE 0 END), 4) AS course_dropout_rate
  FROM subj GROUP BY course),
q AS (SELECT quantile_disc(grade1, 0.25) AS g25, quantile_disc(admission, 0.25) AS a25,
  quantile_disc(admission, 0.75) AS a75 FROM subj),
h0 AS (
  SELECT subj.*, cs.* EXCLUDE (course), debtor + 1 - paid AS financial_stress_index,
    round(debtor * CAST(2.0 AS DOUBLE) + (1 - paid) * CAST(1.5 AS DOUBLE) + (1 - scholar) * CAST(0.5 AS DOUBLE), 4) AS financial_risk_score,
    CASE WHEN admission >= a75 THEN 'High' WHEN admission >= a25 THEN 'Mid' ELSE 'Low' END AS admission_tier,
    round(100.0 * appr1 / nullif(enr1, 0), 2) AS sem1_approval_rate,
    round(eval1 / nullif(enr1, 0), 4) AS sem1_evaluation_rate,
    round(100.0 * appr2 / nullif(enr2, 0), 2) AS sem2_approval_rate,
    round(100.0 * (appr1 + appr2) / nullif(enr1 + enr2, 0), 2) AS overall_approval_rate,
    {half_up('(grade1 + grade2) / 2', 2)} AS avg_grade, {half_up('grade2 - grade1', 2)} AS sem_grade_trend,
    appr2 - appr1 AS sem_approval_trend, noeval1 AS sem1_absenteeism, noeval2 AS sem2_absenteeism,
    noeval1 + noeval2 AS total_absenteeism,
    CASE WHEN eval2 = 0 AND enr2 > 0 THEN 1 ELSE 0 END AS is_ghosting_sem2,
    CAST(app_order = 1 AS INTEGER) AS is_primary_choice,
    CASE WHEN course_avg_grade_sem1 < g25 THEN 1 ELSE 0 END AS is_high_rigor_course,
    {half_up('grade1 - course_avg_grade_sem1', 2)} AS student_vs_course_gap_sem1,
    {half_up('admission - course_avg_grade_sem1', 2)} AS admission_vs_course_gap,
    CAST(target = 'Dropout' AS INTEGER) AS target_binary,
    CASE target WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 ELSE 2 END AS target_multiclass
  FROM subj JOIN cs ON cs.course IS NOT DISTINCT FROM subj.course, q),
h AS (
  SELECT h0.*, sem1_evaluation_rate AS commitment_ratio_sem1,
    financial_stress_index * is_high_rigor_course AS financial_stress_x_rigor,
    CASE WHEN grade1 < 10 AND sem1_absenteeism > 2 THEN 1 ELSE 0 END AS low_grade_high_absence_sem1,
    {risk('sem1_absenteeism', 'coalesce(sem1_approval_rate, 100)', 'grade1', 'is_high_rigor_course')} AS dropout_risk_sem1,
    {risk('total_absenteeism', 'coalesce(overall_approval_rate, 100)', 'avg_grade', 'is_high_rigor_course')} AS dropout_risk_full
  FROM h0)"""
VIEW_BASE = ["entity_id", "course", "debtor", "paid", "scholar", "enr1", "appr1", "eval1", "noeval1", "target"]


def horizon_rows(spark, sf_dir):
    return f.horizon_features(entity_table(spark, sf_dir), SUBJECT)


@check("feature_view_early", f"WITH {HORIZON} SELECT " + ", ".join(VIEW_BASE + f.EARLY_FEATURES) + " FROM h")
def feature_view_early(spark, sf_dir):
    return f.feature_view(horizon_rows(spark, sf_dir), "early", VIEW_BASE, ["unemployment_rate"])


@check("feature_view_full", f"WITH {HORIZON} SELECT " + ", ".join(VIEW_BASE + f.EARLY_FEATURES + f.LATE_FEATURES) + " FROM h")
def feature_view_full(spark, sf_dir):
    return f.feature_view(horizon_rows(spark, sf_dir), "full", VIEW_BASE)


@check("background_features", f"""WITH {SUBJ} SELECT entity_id,
  CASE WHEN age <= 20 THEN 'Teen' WHEN age <= 25 THEN 'Young_Adult' WHEN age <= 35 THEN 'Adult' ELSE 'Mature' END AS age_group,
  {half_up('admission - prior_grade', 2)} AS qualification_to_admission_gap, (gender + app_order) / 2 AS parent_education_index,
  {half_up('age * noeval1 / CAST(100 AS DOUBLE)', 2)} AS age_x_absenteeism,
  {half_up('coalesce(CAST(scholar AS DOUBLE), 0) * 0.5 + coalesce(CAST(noeval1 AS DOUBLE), 0) * 0.3 + coalesce(CAST(noeval2 AS DOUBLE), 0) * -0.2', 4)} AS macro_risk_score FROM subj""")
def background_features(spark, sf_dir):
    columns = f.background_columns("age", "admission", "prior_grade", ("gender", "app_order"), "noeval1", ("scholar", "noeval1", "noeval2"))
    return subjects(spark, sf_dir).withColumns(columns).select("entity_id", *f.BACKGROUND_FEATURES)


@check("drop_protected", f"WITH {SUBJ} SELECT * EXCLUDE (gender, age, segment, grade1, grade2, prior_grade, admission) FROM subj")
def drop_protected(spark, sf_dir):
    rows = subjects(spark, sf_dir).drop("grade1", "grade2", "prior_grade", "admission")
    return f.drop_protected(rows, ["gender", "age", "segment"])


SPLIT = {
    "profile": {"course": ("course", "int"), "preference": ("app_order", "int")},
    "financial": {"debtor": ("debtor", "int"), "fees_paid": ("paid", "int"), "supported": ("scholar", "int")},
    "performance": {"first_taken": ("enr1", "int"), "first_passed": ("appr1", "int"), "second_taken": ("enr2", "int")},
}


def split(name):
    return lambda spark, sf_dir: f.split_tables(subjects(spark, sf_dir), SPLIT, "entity_id")[name]


for piece, spec in SPLIT.items():
    columns = ", ".join(f"CAST({source} AS INTEGER) AS {out}" for out, (source, _) in spec.items())
    check(f"split_{piece}", f"WITH {SUBJ} SELECT entity_id, {columns} FROM subj")(split(piece))


@check("alert_messages", f"""WITH {SUBJ} SELECT entity_id,
  printf('Student Risk Alert: Student %d score %.3f', entity_id, (admission / 500000)) AS alert_subject FROM subj""")
def alert_messages(spark, sf_dir):
    rows = subjects(spark, sf_dir).withColumn("score", F.col("admission") / F.lit(500000.0))
    return rows.select("entity_id", messages.alert_subject("entity_id", "score").alias("alert_subject"))


@check("explain_payload")
def explain_payload(spark, sf_dir):
    scored = staged(score_columns(scored_rows(spark, sf_dir)))
    names = ["financial_stress_index", "absenteeism_index", "overall_approval_ratio"]
    top = [(F.lit(n), F.col(n), F.col(f"contrib_{n}")) for n in names]
    base = scored.agg(F.round(F.avg("risk_score"), 6)).scalar()
    document = messages.explain_payload("entity_id", "risk_score", "_base", {n: n for n in names}, top)
    return explained_rows(scored).withColumn("_base", base).select("entity_id", document.alias("payload"))


@check("long_contributions", f"""WITH {CONTRIB} SELECT entity_id, feature, round(value, 4) AS value,
  round(contribution, 4) AS contribution FROM contrib""")
def contributions(spark, sf_dir):
    scored = staged(score_columns(scored_rows(spark, sf_dir)))
    rows = long_contributions(explained_rows(scored), list(COEFFICIENTS), ["entity_id"])
    return rows.select("entity_id", "feature", F.round("value", 4).alias("value"), F.round("contribution", 4).alias("contribution"))


