"""Model metrics, explanations, fairness and mitigation."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.functions import messages
from casewright.functions.actions import risk_level
from casewright.functions.reasons import base_feature, is_sensitive
from casewright.operators import explain, fairness, learning, metrics, statistics, treeshap
from casewright.plans.checks.registry import check
from casewright.plans.checks.sql import (
    AUDIT, AUDITED, CONTRIB, REASONS, SCORED, SUBJ, TOP, half_up, in_list, parity_cte, rates_cte,
)
from casewright.plans.features import feature_table
from casewright.plans.proxy import (
    COEFFICIENTS, MODEL_NAMES, SUBJECT, audit, entity_table, explained_rows, explanations,
    labelled_documents, score_columns, scored_rows, subjects, table,
)
from casewright.session import staged
from casewright.vocabulary import SENSITIVE_FEATURES

FEATURES = list(COEFFICIENTS)


def stored_scores(spark, sf_dir):
    return staged(score_columns(scored_rows(spark, sf_dir)))


def long_rows(spark, sf_dir):
    return explain.long_contributions(explained_rows(stored_scores(spark, sf_dir)), FEATURES, ["entity_id", "risk_score"])


# --- explanations -----------------------------------------------------------------------------


@check("linear_contributions", f"WITH {CONTRIB} SELECT entity_id, "
       + ", ".join(f"round(max(contribution) FILTER (WHERE feature = '{c}'), 4) AS contrib_{c}" for c in FEATURES)
       + " FROM contrib GROUP BY 1")
def linear_contributions(spark, sf_dir):
    rows = explained_rows(stored_scores(spark, sf_dir))
    return rows.select("entity_id", *[F.round(f"contrib_{c}", 4).alias(f"contrib_{c}") for c in FEATURES])


@check("fallback_contributions", f"WITH {SCORED} SELECT entity_id, "
       + ", ".join(f"round(CAST({c} AS DOUBLE) * CAST({w} AS DOUBLE), 4) AS contrib_{c}" for c, w in COEFFICIENTS.items())
       + " FROM scored WHERE predicted = 1")
def fallback_contributions(spark, sf_dir):
    rows = explain.fallback_contributions(scored_rows(spark, sf_dir).where(F.col("predicted") == 1), COEFFICIENTS)
    return rows.select("entity_id", *[F.round(f"contrib_{c}", 4).alias(f"contrib_{c}") for c in FEATURES])


TOP_COLUMNS = "entity_id, raw_feature_1, raw_feature_2, raw_feature_3, factor_1, factor_2, factor_3"


@check("top_reasons_in_row", f"WITH {TOP} SELECT {TOP_COLUMNS} FROM top")
def top_reasons_in_row(spark, sf_dir):
    return explanations(stored_scores(spark, sf_dir)).drop("risk_score")


@check("top_reasons_long", f"WITH {TOP} SELECT {TOP_COLUMNS} FROM top")
def top_reasons_long(spark, sf_dir):
    raw = F.when(F.col("feature") == "gender", MODEL_NAMES["gender"]).otherwise(F.concat(F.lit("num__"), "feature"))
    return explain.top_reasons(long_rows(spark, sf_dir).withColumn("feature", raw), "entity_id")


BY_SIZE = CONTRIB + ",\n" + REASONS + """,
named AS (SELECT entity_id, CASE feature WHEN 'gender' THEN 'cat__gender_1' ELSE 'num__' || feature END AS feature,
    reason, abs(contribution) AS weight
  FROM contrib JOIN reasons ON key = feature WHERE contribution IS NOT NULL),
single AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY entity_id, reason ORDER BY weight DESC, feature) = 1),
pos AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY weight DESC, feature) AS p FROM single)"""


@check("top_reasons_by_size", f"WITH {BY_SIZE} SELECT entity_id, "
       + ", ".join(f"max(feature) FILTER (WHERE p = {i}) AS raw_feature_{i}, max(reason) FILTER (WHERE p = {i}) AS factor_{i}" for i in (1, 2, 3))
       + " FROM pos GROUP BY 1")
def top_reasons_by_size(spark, sf_dir):
    columns = {MODEL_NAMES[name]: f"contrib_{name}" for name in FEATURES}
    rows = explained_rows(stored_scores(spark, sf_dir))
    return explain.top_reasons_wide(rows, columns, ["entity_id"], positive_first=False, all_features=True)


@check("base_feature_names", """SELECT raw, regexp_replace(regexp_replace(lower(raw), '^(num|cat)__', ''), '_[0-9]+$', '') AS base, count(*) AS n
  FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'cat__' ELSE 'num__' END || o_orderpriority || '_' || (o_custkey % 5) AS raw FROM orders)
  GROUP BY 1, 2""")
def base_feature_names(spark, sf_dir):
    prefix = F.when(F.col("o_orderkey") % 2 == 0, "cat__").otherwise("num__")
    raw = F.concat(prefix, F.col("o_orderpriority"), F.lit("_"), F.col("o_custkey") % 5)
    counts = table(spark, sf_dir, "orders").groupBy(raw.alias("raw")).agg(F.count("*").alias("n"))
    return counts.withColumn("base", base_feature("raw"))


@check("sensitive_features", f"""SELECT raw, n,
  coalesce(max(key) FILTER (WHERE rk = 1), any_value(name)) IN {in_list(SENSITIVE_FEATURES)} AS sensitive
  FROM (SELECT raw, n, name, key, row_number() OVER (PARTITION BY raw ORDER BY length(key) DESC) AS rk
    FROM (SELECT raw, n, regexp_replace(regexp_replace(raw, '^(num|cat)__', ''), '_[0-9]+$', '') AS name FROM (
        SELECT raw, count(*) AS n FROM (SELECT 'cat__' || CASE c_mktsegment WHEN 'BUILDING' THEN 'gender' WHEN 'MACHINERY' THEN 'marital_status'
          WHEN 'HOUSEHOLD' THEN 'course' ELSE 'nacionality_x' END || '_' || c_nationkey AS raw FROM customer) GROUP BY 1)) b
    LEFT JOIN (VALUES ('gender'), ('marital_status'), ('course'), ('nacionality')) k(key)
      ON name = key OR starts_with(name, key || '_')) GROUP BY raw, n""")
def sensitive_features(spark, sf_dir):
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", "gender").when(segment == "MACHINERY", "marital_status")
        .when(segment == "HOUSEHOLD", "course").otherwise("nacionality_x")
    )
    raw = F.concat(F.lit("cat__"), name, F.lit("_"), "c_nationkey")
    counts = table(spark, sf_dir, "customer").groupBy(raw.alias("raw")).agg(F.count("*").alias("n"))
    return counts.withColumn("sensitive", is_sensitive("raw"))


@check("waterfall", f"""WITH {CONTRIB} SELECT entity_id, feature, round(value, 4) AS value, round(contribution, 4) AS contribution,
  row_number() OVER w AS step, {half_up('0.5 + sum(contribution) OVER (w ROWS UNBOUNDED PRECEDING)', 4)} AS running_total
  FROM contrib WINDOW w AS (PARTITION BY entity_id ORDER BY abs(contribution) DESC NULLS LAST, feature)""")
def waterfall(spark, sf_dir):
    rows = explain.waterfall(long_rows(spark, sf_dir), "entity_id", 0.5)
    return rows.withColumns({"value": F.round("value", 4), "contribution": F.round("contribution", 4)})


@check("contribution_pct", f"""WITH {CONTRIB} SELECT entity_id, feature, {half_up('contribution / risk_score * 100', 2)} AS contribution_pct FROM contrib""")
def contribution_pct(spark, sf_dir):
    return explain.contribution_pct(long_rows(spark, sf_dir), "risk_score").select("entity_id", "feature", "contribution_pct")


@check("global_importance", f"WITH {CONTRIB} SELECT feature, round(avg(abs(contribution)), 4) AS mean_abs_contribution FROM contrib GROUP BY 1")
def global_importance(spark, sf_dir):
    return explain.global_importance(long_rows(spark, sf_dir))


@check("risk_level", f"""WITH {SCORED} SELECT entity_id, CASE WHEN risk_score > 0.7 THEN 'CRITICAL' WHEN risk_score > 0.5 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level FROM scored""")
def risk_levels(spark, sf_dir):
    return scored_rows(spark, sf_dir).select("entity_id", risk_level("risk_score").alias("risk_level"))


# --- metrics and splits -----------------------------------------------------------------------


@check("binary_metrics", """WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND n_chars >= 600) AS tp,
  count(*) FILTER (WHERE quality = 0 AND n_chars >= 600) AS fp, count(*) FILTER (WHERE quality = 1 AND n_chars < 600) AS fn,
  count(*) FILTER (WHERE quality = 0 AND n_chars < 600) AS tn, count(*) AS n FROM documents JOIN labels USING (doc_id))
SELECT round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def binary_metrics(spark, sf_dir):
    row = metrics.binary_metrics(labelled_documents(spark, sf_dir))
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@check("roc_auc", f"""WITH {SCORED}, r AS (SELECT actual, rank() OVER (ORDER BY risk_score)
    + (count(*) OVER (PARTITION BY risk_score) - 1) / 2 AS rk FROM scored),
  n AS (SELECT count(*) FILTER (WHERE actual = 1) AS p, count(*) FILTER (WHERE actual = 0) AS q,
    sum(rk) FILTER (WHERE actual = 1) AS s FROM r)
SELECT round((s - p * (p + 1) / 2) / (p * q), 6) AS roc_auc FROM n""")
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(scored_rows(spark, sf_dir)).select(F.round("roc_auc", 6).alias("roc_auc"))


@check("zero_fill", f"WITH {SUBJ} SELECT entity_id, coalesce(enr1, 0) AS enr1, coalesce(noeval2, 0) AS noeval2 FROM subj")
def zero_fill(spark, sf_dir):
    rows = subjects(spark, sf_dir).select("entity_id", "enr1", "noeval2")
    return learning.zero_fill(rows, ["enr1", "noeval2"])


@check("stratified_split", """SELECT o_orderkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus
    ORDER BY md5(o_orderkey || '-42'), o_orderkey) <= round(0.2 * count(*) OVER (PARTITION BY o_orderstatus)) AS INTEGER) AS is_test
  FROM orders""")
def stratified_split(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return learning.stratified_split(rows, "o_orderstatus", "o_orderkey")


@check("hashed_split")
def hashed_split(spark, sf_dir):
    rows = learning.stratified_split(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey", exact=False)
    return rows.groupBy("o_orderstatus", "is_test").agg(F.count("*").alias("n"))


@check("class_weights", """SELECT o_orderkey, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders)
  * count(*) OVER (PARTITION BY o_orderstatus)), 6) AS class_weight FROM orders""")
def class_weights(spark, sf_dir):
    rows = learning.class_weights(table(spark, sf_dir, "orders"), "o_orderstatus")
    return rows.select("o_orderkey", F.round("class_weight", 6).alias("class_weight"))


LANG_AUC = """auc AS (SELECT lang AS model_name, round((sum(rk) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1)
    * (count(*) FILTER (WHERE quality = 1) + 1) / 2) / nullif(count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality = 0), 0), 6) AS roc_auc
  FROM (SELECT lang, quality, rank() OVER (PARTITION BY lang ORDER BY n_chars)
      + (count(*) OVER (PARTITION BY lang, n_chars) - 1) / 2 AS rk FROM documents JOIN labels USING (doc_id))
  GROUP BY lang)"""


@check("select_best", f"WITH {LANG_AUC} SELECT model_name, roc_auc FROM auc ORDER BY roc_auc DESC, (model_name = 'en') DESC, model_name LIMIT 1")
def select_best(spark, sf_dir):
    rows = staged(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    )
    per_language = metrics.roc_auc(rows, "quality", "n_chars", ["lang"])
    return metrics.select_best(per_language.select(F.col("lang").alias("model_name"), F.round("roc_auc", 6).alias("roc_auc")), "en")


CATEGORIES = ["course", "app_order", "debtor", "paid", "scholar", "financial_segment", "academic_momentum_band", "financial_risk_band"]
OUTSIDE_MODEL = ["entity_id", "target", "segment", "actual", "is_test", "class_weight"]
PROTECTED = ["gender", "age"]


def prepared(spark, sf_dir):
    rows = entity_table(spark, sf_dir).withColumn("actual", F.when(F.col("target") == "Dropout", 1).otherwise(0))
    # The split and the weights only attach a few cuts to stored rows; the features alone are written.
    split = learning.stratified_split(rows, "actual", "entity_id")
    parts = staged(feature_table(split, SUBJECT, fit_on=split.where(F.col("is_test") == 0)))
    train = learning.class_weights(parts.where(F.col("is_test") == 0), "actual")
    columns = learning.ml_columns(parts, CATEGORIES, OUTSIDE_MODEL, PROTECTED)
    return parts, train, columns, learning.build_preprocessor(train, columns)


@check("preprocessed_features")
def preprocessed_features(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    parts, train, _, stages = prepared(spark, sf_dir)
    vectors = Pipeline(stages=stages).fit(train).transform(parts)
    return vectors.select("entity_id", vector_to_array("features").alias("features"))


@check("logistic_scores")
def logistic_scores(spark, sf_dir):
    parts, train, _, stages = prepared(spark, sf_dir)
    model = learning.fit_lr(train, stages, "actual")
    return learning.score(model, parts.where(F.col("is_test") == 1)).select("entity_id", "actual", "risk_score", "predicted")


@check("forest_scores")
def forest_scores(spark, sf_dir):
    parts, train, _, stages = prepared(spark, sf_dir)
    model = learning.fit_rf(train, stages, "actual")
    return learning.score(model, parts.where(F.col("is_test") == 1)).select("entity_id", "actual", "risk_score", "predicted")


@check("tree_contributions")
def tree_contributions(spark, sf_dir):
    parts, train, _, stages = prepared(spark, sf_dir)
    model = learning.fit_rf(train, stages, "actual")
    flagged = learning.score(model, parts.where(F.col("is_test") == 1)).where(F.col("predicted") == 1)
    rows, base = treeshap.tree_contributions(model.stages[-1], flagged, ["entity_id", "risk_score"])
    added = F.aggregate("contributions", F.lit(base), lambda a, c: a + c)
    return rows.select("entity_id", "risk_score", added.alias("base_plus_contributions"))


@check("model_metrics")
def model_metrics(spark, sf_dir):
    parts, train, _, stages = prepared(spark, sf_dir)
    test = parts.where(F.col("is_test") == 1)
    models = {
        "logistic_regression_baseline": learning.fit_lr(train, stages, "actual"),
        "random_forest_baseline": learning.fit_rf(train, stages, "actual"),
    }
    results = {
        name: metrics.evaluate(staged(learning.score(m, test).select("actual", "predicted", "risk_score")), "actual", "predicted", "risk_score")
        for name, m in models.items()
    }
    return metrics.metrics_table(spark, results, "random_forest_baseline", F.lit("2024-01-31 00:00:00"))


@check("payload_fields", f"""WITH {SCORED} SELECT CAST(entity_id AS VARCHAR) AS entity, CASE WHEN risk_score > 0.7 THEN 'CRITICAL' WHEN risk_score > 0.5 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level,
  round(risk_score, 4) AS probability, absenteeism_index AS absences FROM scored WHERE predicted = 1""")
def payload_fields(spark, sf_dir):
    """The document of each entity, read back."""
    scored = stored_scores(spark, sf_dir)
    document = messages.explain_payload("entity_id", "risk_score", F.lit(0.5), {"absences": F.col("absenteeism_index")}, [(F.lit("absences"), F.col("absenteeism_index"), F.col("contrib_absenteeism_index"))])
    kind = "student_id string, prediction struct<dropout_probability: double, risk_level: string>, student_features struct<absences: bigint>"
    read = explained_rows(scored).select(F.from_json(document, kind).alias("p"))
    return read.select(
        F.col("p.student_id").alias("entity"), F.col("p.prediction.risk_level").alias("risk_level"),
        F.round("p.prediction.dropout_probability", 4).alias("probability"), F.col("p.student_features.absences").alias("absences"),
    )


# --- fairness ---------------------------------------------------------------------------------

DOCS = """docs AS (SELECT doc_id, lang, source, quality AS actual, CAST(n_chars >= 600 AS INTEGER) AS predicted
  FROM documents JOIN labels USING (doc_id))"""
DOC_RATES = DOCS + ",\n" + rates_cte("docs", ["lang", "source"])
CORE = "protected_attribute, group_name, population_count, tp, fp, fn, tn, round(selection_rate, 6) AS selection_rate, round(true_positive_rate, 6) AS true_positive_rate, round(false_positive_rate, 6) AS false_positive_rate"
EXTRA = 'round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(false_negative_rate, 6) AS false_negative_rate'


def rounded(df, digits=6):
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema
    ])


@check("group_rates", f"""WITH {DOC_RATES} SELECT {CORE} FROM rates UNION ALL
  SELECT 'overall', 'overall', count(*), count(*) FILTER (WHERE actual = 1 AND predicted = 1),
    count(*) FILTER (WHERE actual = 0 AND predicted = 1), count(*) FILTER (WHERE actual = 1 AND predicted = 0),
    count(*) FILTER (WHERE actual = 0 AND predicted = 0), round(avg(predicted), 6),
    round(avg(predicted) FILTER (WHERE actual = 1), 6), round(avg(predicted) FILTER (WHERE actual = 0), 6) FROM docs""")
def group_rates(spark, sf_dir):
    return rounded(fairness.group_rates(labelled_documents(spark, sf_dir), ["lang", "source"], overall=True))


@check("group_rates_full", f"WITH {DOC_RATES} SELECT {CORE}, {EXTRA} FROM rates")
def group_rates_full(spark, sf_dir):
    return rounded(fairness.group_rates(labelled_documents(spark, sf_dir), ["lang", "source"], full=True))


PARITY_COLUMNS = ["demographic_parity_difference", "demographic_parity_ratio", "equal_opportunity_difference",
                  "equal_opportunity_ratio", "equalized_odds_difference", "equalized_odds_ratio"]
PARITY_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in PARITY_COLUMNS)


@check("parity", f"WITH {DOC_RATES}, {parity_cte()} SELECT protected_attribute, {PARITY_SQL} FROM par")
def parity(spark, sf_dir):
    return rounded(fairness.parity(fairness.group_rates(labelled_documents(spark, sf_dir), ["lang", "source"])))


@check("fairness_audit", f"""WITH {SCORED}, {AUDIT} SELECT model_name, protected_attribute, group_name, population_count,
  round(selection_rate, 6) AS selection_rate, round(true_positive_rate, 6) AS true_positive_rate,
  round(false_positive_rate, 6) AS false_positive_rate, {PARITY_SQL}, fairness_review_flag, audit_ts FROM audit""")
def fairness_audit(spark, sf_dir):
    return rounded(audit(scored_rows(spark, sf_dir)))


@check("global_review", f"WITH {SCORED}, {AUDIT} SELECT max(fairness_review_flag) AS fairness_review_flag FROM audit")
def global_review(spark, sf_dir):
    return statistics.global_max(audit(scored_rows(spark, sf_dir)), "fairness_review_flag")


@check("gap_report", f"""WITH {DOC_RATES} SELECT protected_attribute, group_name, population_count,
  round(selection_rate, 6) AS positive_prediction_rate, round(true_positive_rate, 6) AS true_positive_rate,
  round(selection_rate - (SELECT avg(predicted) FROM docs), 6) AS demographic_parity_gap,
  round(true_positive_rate - (SELECT avg(predicted) FROM docs WHERE actual = 1), 6) AS equal_opportunity_gap FROM rates""")
def gap_report(spark, sf_dir):
    return rounded(fairness.gap_report(labelled_documents(spark, sf_dir), ["lang", "source"]))


@check("gap_report_reviewed", f"""WITH {DOC_RATES}, g AS (SELECT protected_attribute, group_name, selection_rate - (SELECT avg(predicted) FROM docs) AS dp,
  true_positive_rate - (SELECT avg(predicted) FROM docs WHERE actual = 1) AS eo FROM rates), f AS (SELECT *, CAST(abs(dp) > 0.1 OR abs(eo) > 0.1 AS INTEGER) AS flag FROM g)
SELECT 'length_rule' AS model_name, protected_attribute, group_name, flag AS review_required_flag, (SELECT max(flag) FROM f) AS global_review_required,
  TIMESTAMP '2024-01-31 00:00:00' AS audit_ts FROM f""")
def gap_report_reviewed(spark, sf_dir):
    report = fairness.gap_report(labelled_documents(spark, sf_dir), ["lang", "source"])
    reviewed = fairness.reviewed_gaps(report, "length_rule", F.lit("2024-01-31 00:00:00"))
    return reviewed.select("model_name", "protected_attribute", "group_name", "review_required_flag", "global_review_required", "audit_ts")


@check("fairness_status", f"""WITH {SCORED}, {AUDIT} SELECT protected_attribute,
  CASE WHEN demographic_parity_ratio BETWEEN 0.8 AND 1.25 AND abs(equalized_odds_difference) < 0.1 THEN 'PASS'
       WHEN demographic_parity_ratio BETWEEN 0.7 AND 1.3 THEN 'REVIEW' ELSE 'FAIL' END AS status,
  CASE WHEN demographic_parity_ratio < 0.8 THEN 'FAIL' WHEN demographic_parity_ratio > 1.25 THEN 'WARNING' ELSE 'PASS' END AS parity_band,
  CASE WHEN abs(equalized_odds_difference) < 0.1 THEN 'PASS' WHEN abs(equalized_odds_difference) < 0.2 THEN 'MODERATE' ELSE 'FAIL' END AS odds_band
  FROM par""")
def fairness_status(spark, sf_dir):
    scored = scored_rows(spark, sf_dir)
    cross = F.concat_ws("|", "gender", "financial_segment")
    rates = fairness.group_rates(scored.withColumn("gender_x_financial_segment", cross), AUDITED)
    ratio, odds = "demographic_parity_ratio", "equalized_odds_difference"
    return fairness.parity(rates).select(
        "protected_attribute", fairness.fairness_status(ratio, odds).alias("status"),
        fairness.parity_band(ratio).alias("parity_band"), fairness.odds_band(odds).alias("odds_band"),
    )


METRICS = ["selection_rate", "true_positive_rate", "false_positive_rate", "accuracy", "precision"]


@check("disparities", f"WITH {DOC_RATES} " + " UNION ALL ".join(
    f"""SELECT protected_attribute, '{m}' AS metric, round(max("{m}") - min("{m}"), 6) AS difference,
    CAST(max("{m}") - min("{m}") > 0.1 AS INTEGER) AS above_limit FROM rates GROUP BY 1""" for m in METRICS))
def disparities(spark, sf_dir):
    rates = fairness.group_rates(labelled_documents(spark, sf_dir), ["lang", "source"], full=True)
    return rounded(fairness.disparities(rates, METRICS))


@check("disparate_impact", f"""WITH {DOC_RATES} SELECT group_name, round(selection_rate, 6) AS selection_rate,
  round(selection_rate / (SELECT selection_rate FROM rates WHERE protected_attribute = 'lang' AND group_name = 'en'), 6) AS disparate_impact_ratio
  FROM rates WHERE protected_attribute = 'lang'""")
def disparate_impact(spark, sf_dir):
    rates = fairness.group_rates(labelled_documents(spark, sf_dir), ["lang"])
    return rounded(fairness.disparate_impact(rates, "lang", "en"))


GRID = SCORED + """,
g AS (SELECT CAST(financial_segment AS VARCHAR) AS group_name, actual,
    CAST(least(100, greatest(0, floor(risk_score * 100 + 1e-9))) AS INTEGER) AS bin FROM scored),
curve AS (SELECT group_name, s.step, count(*) FILTER (WHERE actual = 1) AS all_pos, count(*) FILTER (WHERE actual <> 1) AS all_neg,
    count(*) FILTER (WHERE actual = 1 AND bin >= s.step) AS tp, count(*) FILTER (WHERE actual <> 1 AND bin >= s.step) AS fp
  FROM g, (SELECT unnest(range(0, 101)) AS step) s GROUP BY 1, 2),
gr AS (SELECT *, coalesce(tp / nullif(all_pos, 0), 0) AS tpr, coalesce(fp / nullif(all_neg, 0), 0) AS fpr FROM curve),
goals AS (SELECT step AS goal, sum(tp) / sum(all_pos) AS goal_tpr, sum(fp) / sum(all_neg) AS goal_fpr FROM curve GROUP BY 1),
best AS (SELECT * FROM gr, goals QUALIFY row_number() OVER (PARTITION BY group_name, goal
  ORDER BY round(greatest(abs(tpr - goal_tpr), abs(fpr - goal_fpr)), 9), step) = 1),
outcome AS (SELECT goal, round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 9) AS gap,
  round((sum(tp) / sum(all_pos) + 1 - sum(fp) / sum(all_neg)) / 2, 9) AS ba FROM best GROUP BY 1),
winner AS (SELECT goal FROM outcome ORDER BY greatest(gap - 0.05, 0), ba DESC, goal LIMIT 1),
cuts AS (SELECT group_name, step / 100 AS threshold, tpr, fpr FROM best WHERE goal = (SELECT goal FROM winner))"""


@check("threshold_curve", f"WITH {GRID} SELECT group_name, CAST(step AS INTEGER) AS step, all_pos, all_neg, tp, fp FROM curve")
def threshold_curve(spark, sf_dir):
    return fairness.threshold_curve(scored_rows(spark, sf_dir), "financial_segment", "risk_score", "actual")


@check("optimized_thresholds", f"""WITH {GRID} SELECT group_name, round(threshold, 6) AS threshold,
  round(tpr, 6) AS true_positive_rate, round(fpr, 6) AS false_positive_rate FROM cuts""")
def optimized_thresholds(spark, sf_dir):
    scored = staged(scored_rows(spark, sf_dir).select("financial_segment", "risk_score", "actual"))
    return rounded(fairness.optimize_thresholds(scored, "financial_segment"))


MITIGATED = GRID + """,
fair AS (SELECT financial_segment, actual, predicted AS before, CAST(risk_score + 1e-9 >= threshold AS INTEGER) AS after
  FROM scored JOIN cuts ON group_name = financial_segment),
b0 AS (SELECT financial_segment, actual, before AS predicted FROM fair), a0 AS (SELECT financial_segment, actual, after AS predicted FROM fair),
""" + rates_cte("b0", ["financial_segment"], "rb") + ",\n" + rates_cte("a0", ["financial_segment"], "ra") + ",\n" \
    + parity_cte("rb", "pb") + ",\n" + parity_cte("ra", "pa") + """,
both_ AS (SELECT pb.protected_attribute, (SELECT avg(CAST(actual = predicted AS INTEGER)) FROM b0) AS accuracy_before,
  (SELECT avg(CAST(actual = predicted AS INTEGER)) FROM a0) AS accuracy_after,
  pb.demographic_parity_ratio AS dp_ratio_before, pa.demographic_parity_ratio AS dp_ratio_after,
  pb.equalized_odds_difference AS eo_difference_before, pa.equalized_odds_difference AS eo_difference_after FROM pb JOIN pa USING (protected_attribute))"""


@check("compare_mitigation", f"""WITH {MITIGATED} SELECT protected_attribute, round(accuracy_before, 6) AS accuracy_before,
  round(dp_ratio_before, 6) AS dp_ratio_before, round(eo_difference_before, 6) AS eo_difference_before,
  round(accuracy_after, 6) AS accuracy_after, round(dp_ratio_after, 6) AS dp_ratio_after, round(eo_difference_after, 6) AS eo_difference_after,
  round(accuracy_before - accuracy_after, 6) AS accuracy_drop,
  round(abs(dp_ratio_before - 1) - abs(dp_ratio_after - 1), 6) AS fairness_gain_dp,
  round(abs(eo_difference_before) - abs(eo_difference_after), 6) AS fairness_gain_eo,
  CASE WHEN abs(accuracy_before - accuracy_after) < 0.03 AND abs(eo_difference_before) - abs(eo_difference_after) > 0.05
    THEN 'deploy' ELSE 'review' END AS recommendation FROM both_""")
def compare_mitigation(spark, sf_dir):
    scored = staged(scored_rows(spark, sf_dir).select("financial_segment", "risk_score", "actual", "predicted"))
    cuts = fairness.optimize_thresholds(scored, "financial_segment")
    fair = fairness.apply_thresholds(scored, cuts, "financial_segment", "risk_score")
    return rounded(fairness.compare_mitigation(fair, "financial_segment", "predicted", "fair_predicted"))
