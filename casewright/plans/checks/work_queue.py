"""Actions, the ranked queue, reports and SQL table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.functions import actions, table_functions
from casewright.operators import queue as work
from casewright.operators import reports, statistics
from casewright.plans.checks.registry import check
from casewright.plans.checks.sql import CATALOG, QUEUE, SCORED, TOP, action_case, in_list
from casewright.plans.proxy import (
    decided, explanations, score_columns, scored_rows, subjects, table,
)
from casewright.plans.proxy import queue as ranked_queue
from casewright.session import staged
from casewright.sources.literals import intervention_catalog
from casewright.vocabulary import BASIC_ACADEMIC_REASONS, BASIC_ENGAGEMENT_REASONS, BASIC_FINANCIAL_REASONS

FACTORS = ["factor_1", "factor_2", "factor_3"]
QUEUE_COLUMNS = (
    "entity_id, risk_score, predicted, actual, confidence_band, intervention_tier, recommended_action, "
    "top_risk_factor_1, top_risk_factor_2, top_risk_factor_3, fairness_review_flag, priority_rank, queue_ts"
)


def top_rows(spark, sf_dir):
    return explanations(staged(score_columns(scored_rows(spark, sf_dir))))


@check("confidence_and_tier", f"""WITH {SCORED} SELECT entity_id,
  CASE WHEN risk_score >= 0.8 THEN 'high_confidence' WHEN risk_score >= 0.6 THEN 'medium_confidence' ELSE 'low_confidence' END AS confidence_band,
  CASE WHEN risk_score >= 0.7 THEN 'high' WHEN risk_score >= 0.4 THEN 'medium' ELSE 'low' END AS intervention_tier FROM scored""")
def confidence_and_tier(spark, sf_dir):
    return scored_rows(spark, sf_dir).select(
        "entity_id", actions.confidence_band("risk_score").alias("confidence_band"),
        actions.intervention_tier("risk_score").alias("intervention_tier"),
    )


@check("recommended_action", f"WITH {TOP} SELECT entity_id, {action_case('risk_score', FACTORS)} AS recommended_action FROM top")
def recommended_action(spark, sf_dir):
    return top_rows(spark, sf_dir).select("entity_id", actions.recommend_action("risk_score", FACTORS).alias("recommended_action"))


def any_factor(labels):
    return "(" + " OR ".join(f"{f} IN {in_list(labels)}" for f in FACTORS) + ")"


@check("basic_action", f"""WITH {TOP} SELECT entity_id,
  CASE WHEN risk_score >= 0.7 AND {any_factor(BASIC_FINANCIAL_REASONS)} THEN 'financial_aid_counseling'
       WHEN risk_score >= 0.7 AND {any_factor(BASIC_ACADEMIC_REASONS)} THEN 'academic_mentoring'
       WHEN risk_score >= 0.6 AND {any_factor(BASIC_ENGAGEMENT_REASONS)} THEN 'counselor_outreach'
       WHEN risk_score >= 0.6 THEN 'counselor_review' ELSE 'monitor' END AS recommended_action FROM top""")
def basic_action(spark, sf_dir):
    return top_rows(spark, sf_dir).select("entity_id", actions.recommend_basic_action("risk_score", FACTORS).alias("recommended_action"))


LEADING = """f AS (SELECT entity_id, financial_stress_index, grade1, 100.0 * appr1 / nullif(enr1, 0) AS rate, noeval1 FROM feat),
lead AS (SELECT entity_id, 'financial_stress_index' AS feature, CAST(financial_stress_index AS DOUBLE) AS v FROM f
  UNION ALL SELECT entity_id, 'sem1_grade', grade1 FROM f UNION ALL SELECT entity_id, 'sem1_approval_rate', rate FROM f
  UNION ALL SELECT entity_id, 'sem1_absenteeism', noeval1 FROM f)"""


@check("factor_intervention", f"""WITH {SCORED}, {LEADING} SELECT entity_id, feature,
  CASE WHEN feature = 'financial_stress_index' THEN 'Emergency Financial Aid + Counseling'
       WHEN feature = 'sem1_grade' AND v < 10 THEN 'Tutoring Program + Study Groups'
       WHEN feature = 'sem1_approval_rate' AND v < 50 THEN 'Academic Advisor Meeting + Support Plan'
       WHEN feature = 'sem1_absenteeism' AND v > 3 THEN 'Attendance Tracking + Engagement Program' END AS recommended_intervention,
  CASE WHEN feature = 'financial_stress_index' THEN 1 WHEN feature = 'sem1_grade' AND v < 10 THEN 1
       WHEN feature = 'sem1_approval_rate' AND v < 50 THEN 1 WHEN feature = 'sem1_absenteeism' AND v > 3 THEN 2 END AS intervention_priority
  FROM lead""")
def factor_intervention(spark, sf_dir):
    from casewright.functions.expressions import null_ratio
    from casewright.plans.features import financial_stress
    from casewright.plans.proxy import MONEY

    rows = subjects(spark, sf_dir).select(
        "entity_id", financial_stress(MONEY).cast("double").alias("financial_stress_index"),
        F.col("grade1").alias("sem1_grade"), null_ratio("appr1", "enr1", 100.0).alias("sem1_approval_rate"),
        F.col("noeval1").cast("double").alias("sem1_absenteeism"),
    )
    long = rows.unpivot(["entity_id"], rows.columns[1:], "feature", "value")
    return long.select("entity_id", "feature", actions.factor_intervention("feature", "value").alias("o")).select("entity_id", "feature", "o.*")


@check("intervention_queue", f"WITH {QUEUE} SELECT {QUEUE_COLUMNS} FROM queue")
def intervention_queue(spark, sf_dir):
    return ranked_queue(spark, sf_dir)


@check("queue_head", f"WITH {QUEUE} SELECT {QUEUE_COLUMNS} FROM queue WHERE priority_rank <= 20")
def queue_head(spark, sf_dir):
    return reports.top_priority(ranked_queue(spark, sf_dir), 20)


PLAN = f"""{SCORED}, {CATALOG}, fit AS (
  SELECT entity_id, intervention_type, success_rate, avg_cost,
    row_number() OVER (PARTITION BY entity_id ORDER BY success_rate DESC, intervention_type) AS option_rank
  FROM scored s JOIN catalog c ON c.risk_score_threshold <= s.risk_score + 0.15 AND c.financial_stress_level <= s.financial_stress_index + 1
  QUALIFY option_rank <= 5),
pick AS (SELECT * FROM fit QUALIFY row_number() OVER (PARTITION BY entity_id
  ORDER BY CASE WHEN success_rate > 0.7 AND avg_cost < 500 THEN 0 ELSE 1 END, option_rank) = 1)"""


@check("intervention_plan", f"""WITH {PLAN} SELECT s.entity_id, concat_ws('|',
  CASE WHEN financial_stress_index >= 2 THEN 'emergency_financial_aid' END, CASE WHEN grade1 < 10 THEN 'tutoring_or_reduced_load' END,
  CASE WHEN absenteeism_index > 3 THEN 'counseling' END, CASE WHEN risk_score > 0.8 THEN 'human_counselor_review' END) AS required_actions,
  intervention_type AS preferred_intervention FROM scored s LEFT JOIN pick p ON p.entity_id = s.entity_id""")
def intervention_plan(spark, sf_dir):
    profile = staged(scored_rows(spark, sf_dir).select("entity_id", "risk_score", "financial_stress_index", "grade1", "absenteeism_index"))
    return work.intervention_plan(
        profile, intervention_catalog(spark), "entity_id", "risk_score", "financial_stress_index", "grade1", "absenteeism_index"
    )


# --- reports ----------------------------------------------------------------------------------


@check("action_distribution", f"""WITH {QUEUE} SELECT recommended_action, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_of_total,
  round(avg(risk_score), 4) AS avg_risk_score, round(min(risk_score), 4) AS min_risk_score, round(max(risk_score), 4) AS max_risk_score
  FROM queue GROUP BY 1""")
def action_distribution(spark, sf_dir):
    return reports.action_breakdown(decided(spark, sf_dir))


UNPIVOTED = " UNION ALL ".join(
    f"SELECT entity_id, risk_score, intervention_tier, 'top_risk_factor_{i}' AS position, top_risk_factor_{i} AS factor FROM queue" for i in (1, 2, 3)
)


@check("factor_frequency", f"""WITH {QUEUE}, u AS ({UNPIVOTED}) SELECT position, factor, count(*) AS n, round(avg(risk_score), 3) AS avg_risk_score FROM u GROUP BY 1, 2""")
def factor_frequency(spark, sf_dir):
    return statistics.factor_frequency(decided(spark, sf_dir), reports.FACTORS, "risk_score")


@check("factor_combinations", f"""WITH {QUEUE}, a AS (SELECT top_risk_factor_1, top_risk_factor_2, top_risk_factor_3, recommended_action,
    count(*) AS k, row_number() OVER (PARTITION BY top_risk_factor_1, top_risk_factor_2, top_risk_factor_3 ORDER BY count(*) DESC, recommended_action) AS r
  FROM queue GROUP BY 1, 2, 3, 4),
c AS (SELECT top_risk_factor_1, top_risk_factor_2, top_risk_factor_3, count(*) AS n, round(avg(risk_score), 4) AS avg_risk_score,
    round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_of_total FROM queue GROUP BY 1, 2, 3)
SELECT c.*, a.recommended_action AS typical_action FROM c JOIN a USING (top_risk_factor_1, top_risk_factor_2, top_risk_factor_3)
WHERE a.r = 1 ORDER BY n DESC, 1, 2, 3 LIMIT 20""")
def factor_combinations(spark, sf_dir):
    return statistics.combination_top(decided(spark, sf_dir), reports.FACTORS, "risk_score", "recommended_action", 20)


@check("tier_by_action", f"""WITH {QUEUE} SELECT intervention_tier, recommended_action, count(*) AS n, round(avg(risk_score), 4) AS avg_risk_score,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY intervention_tier), 2) AS pct_within_intervention_tier FROM queue GROUP BY 1, 2""")
def tier_by_action(spark, sf_dir):
    return statistics.share_within(decided(spark, sf_dir), "intervention_tier", "recommended_action", "risk_score")


@check("raw_feature_counts", f"WITH {TOP} SELECT raw_feature_1, count(*) AS n FROM top GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15")
def raw_feature_counts(spark, sf_dir):
    return statistics.value_counts(top_rows(spark, sf_dir), "raw_feature_1", 15)


DETAIL = "confidence_band, top_risk_factor_1, top_risk_factor_2, top_risk_factor_3, priority_rank"


def candidate_query(action):
    return lambda spark, sf_dir: reports.candidates(ranked_queue(spark, sf_dir), action, 20)


for name, wanted in (("financial_candidates", "financial_support_review"), ("academic_candidates", "academic_tutoring_required")):
    check(name, f"""WITH {QUEUE} SELECT entity_id, round(risk_score, 4) AS risk_score, {DETAIL} FROM queue
      WHERE recommended_action = '{wanted}' ORDER BY queue.risk_score DESC, entity_id LIMIT 20""")(candidate_query(wanted))


@check("diverse_high_risk", f"""WITH {QUEUE} SELECT entity_id, round(risk_score, 4) AS risk_score, recommended_action, top_risk_factor_1,
  top_risk_factor_2, top_risk_factor_3, priority_rank FROM queue WHERE risk_score >= 0.7
  AND top_risk_factor_1 NOT IN ('High overall absenteeism', 'Other model risk signal') ORDER BY queue.risk_score DESC, entity_id LIMIT 30""")
def diverse_high_risk(spark, sf_dir):
    return reports.diverse_high_risk(ranked_queue(spark, sf_dir), ["High overall absenteeism", "Other model risk signal"])


@check("inspect_explanations", f"""WITH {TOP} SELECT entity_id, round(risk_score, 4) AS risk_score, raw_feature_1, raw_feature_2, raw_feature_3,
  factor_1 AS mapped_1, factor_2 AS mapped_2, factor_3 AS mapped_3 FROM top ORDER BY top.risk_score DESC, entity_id LIMIT 30""")
def inspect_explanations(spark, sf_dir):
    return reports.inspect_explanations(top_rows(spark, sf_dir))


@check("tile_needing_support", f"""WITH {QUEUE} SELECT count(*) FILTER (WHERE intervention_tier = 'high') AS high_tier,
  count(*) FILTER (WHERE predicted = 1) AS predicted_positive FROM queue""")
def tile_needing_support(spark, sf_dir):
    return reports.needing_support(decided(spark, sf_dir))


@check("tile_manual_review", f"""WITH {QUEUE} SELECT count(*) FILTER (WHERE fairness_review_flag = 1) AS flagged,
  count(*) FILTER (WHERE recommended_action = 'high_priority_case_review') AS case_review FROM queue""")
def tile_manual_review(spark, sf_dir):
    return reports.manual_review(decided(spark, sf_dir))


@check("tile_by_tier", f"WITH {QUEUE} SELECT intervention_tier, count(*) AS n FROM queue GROUP BY 1")
def tile_by_tier(spark, sf_dir):
    return reports.by_tier(decided(spark, sf_dir))


@check("tile_common_factors", f"WITH {QUEUE}, u AS ({UNPIVOTED}) SELECT factor, count(*) AS n FROM u GROUP BY 1")
def tile_common_factors(spark, sf_dir):
    return reports.common_factors(decided(spark, sf_dir))


@check("tile_factors_by_tier", f"WITH {QUEUE}, u AS ({UNPIVOTED}) SELECT intervention_tier, factor, count(*) AS n FROM u GROUP BY 1, 2")
def tile_factors_by_tier(spark, sf_dir):
    return reports.factors_by_tier(decided(spark, sf_dir))


@check("tile_resources", f"WITH {QUEUE} SELECT recommended_action, count(DISTINCT entity_id) AS entities FROM queue GROUP BY 1")
def tile_resources(spark, sf_dir):
    return reports.resources_by_action(decided(spark, sf_dir))


NO_MEASURES = "CAST(NULL AS DOUBLE) AS pct, CAST(NULL AS DOUBLE) AS avg_risk, CAST(NULL AS DOUBLE) AS low_risk, CAST(NULL AS DOUBLE) AS high_risk"


@check("dashboard", f"""WITH {QUEUE}, u AS ({UNPIVOTED})
SELECT 'needing_support' AS tile, 'high_tier' AS label, CAST(NULL AS VARCHAR) AS detail, count(*) FILTER (WHERE intervention_tier = 'high') AS n, {NO_MEASURES} FROM queue
UNION ALL SELECT 'needing_support', 'predicted_positive', NULL, count(*) FILTER (WHERE predicted = 1), {NO_MEASURES} FROM queue
UNION ALL SELECT 'manual_review', 'flagged', NULL, count(*) FILTER (WHERE fairness_review_flag = 1), {NO_MEASURES} FROM queue
UNION ALL SELECT 'manual_review', 'case_review', NULL, count(*) FILTER (WHERE recommended_action = 'high_priority_case_review'), {NO_MEASURES} FROM queue
UNION ALL SELECT 'by_tier', intervention_tier, NULL, count(*), {NO_MEASURES} FROM queue GROUP BY intervention_tier
UNION ALL SELECT 'action_breakdown', recommended_action, NULL, count(*), round(100.0 * count(*) / sum(count(*)) OVER (), 2), round(avg(risk_score), 4), round(min(risk_score), 4), round(max(risk_score), 4) FROM queue GROUP BY recommended_action
UNION ALL SELECT 'resources', recommended_action, NULL, count(DISTINCT entity_id), {NO_MEASURES} FROM queue GROUP BY recommended_action
UNION ALL SELECT 'common_factors', factor, NULL, count(*), {NO_MEASURES} FROM u GROUP BY factor
UNION ALL SELECT 'factors_by_tier', intervention_tier, factor, count(*), {NO_MEASURES} FROM u GROUP BY intervention_tier, factor
UNION ALL SELECT 'top_priority', CAST(entity_id AS VARCHAR), recommended_action, priority_rank, {NO_MEASURES} FROM queue WHERE priority_rank <= 20""")
def dashboard(spark, sf_dir):
    return reports.dashboard(ranked_queue(spark, sf_dir))


# --- SQL functions ----------------------------------------------------------------------------

PROFILE_COLUMNS = "entity_id, dropout_risk_score, financial_stress_index, grade1, target"


def register(spark, sf_dir):
    profiles = staged(scored_rows(spark, sf_dir).select(
        "entity_id", F.col("risk_score").alias("dropout_risk_score"), "financial_stress_index", "grade1", "target"
    ))
    table_functions.register_table_functions(profiles, intervention_catalog(spark))


PROFILES = SCORED + ",\nprofiles AS (SELECT entity_id, risk_score AS dropout_risk_score, financial_stress_index, round(grade1, 4) AS grade1, target FROM scored)"


@check("entity_profile_function", f"WITH {PROFILES} SELECT {PROFILE_COLUMNS} FROM profiles WHERE entity_id = 100")
def entity_profile_function(spark, sf_dir):
    register(spark, sf_dir)
    return spark.sql("SELECT entity_id, dropout_risk_score, financial_stress_index, round(grade1, 4) AS grade1, target FROM entity_profile(100)")


@check("similar_interventions_function", f"""WITH {PROFILES}, {CATALOG} SELECT entity_id, intervention_type, CAST(success_rate AS DOUBLE) AS success_rate
  FROM profiles p JOIN catalog c
    ON c.risk_score_threshold <= dropout_risk_score + 0.15 AND c.financial_stress_level <= p.financial_stress_index + 1
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY success_rate DESC, intervention_type) <= 5""")
def similar_interventions_function(spark, sf_dir):
    register(spark, sf_dir)
    return spark.sql(
        "SELECT p.entity_id, s.intervention_type, s.success_rate FROM cw_profiles p, "
        "LATERAL similar_interventions(CAST(p.dropout_risk_score AS DOUBLE), CAST(p.financial_stress_index AS INT)) s"
    )


@check("top_risk_function", f"WITH {PROFILES} SELECT {PROFILE_COLUMNS} FROM profiles WHERE dropout_risk_score >= 0.7 ORDER BY dropout_risk_score DESC, entity_id LIMIT 50")
def top_risk_function(spark, sf_dir):
    register(spark, sf_dir)
    return spark.sql("SELECT entity_id, dropout_risk_score, financial_stress_index, round(grade1, 4) AS grade1, target FROM top_risk(0.7D, 50)")


@check("safe_ratio_function", """SELECT l_orderkey, round(CASE WHEN sum(l_linenumber - 1) > 0
  THEN count(*) / sum(l_linenumber - 1) ELSE 0 END, 4) AS ratio FROM lineitem GROUP BY 1""")
def safe_ratio_function(spark, sf_dir):
    table_functions.register_safe_ratio(spark)
    sums = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").cast("double").alias("n"), F.sum(F.col("l_linenumber") - 1).cast("double").alias("d")
    )
    return sums.select("l_orderkey", F.round(F.call_function("safe_ratio", "n", "d"), 4).alias("ratio"))
