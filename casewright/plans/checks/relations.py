"""Joins, group statistics, order and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.functions.reasons import reason_of
from casewright.operators import alerts, joins, statistics
from casewright.operators.explain import long_contributions
from casewright.operators.ordering import priority_rank, quantile, top_n, with_running_totals
from casewright.plans.checks.registry import check
from casewright.plans.checks.sql import CATALOG, CONTRIB, FEAT, REASONS, SCORED, SUBJ, TOP, half_up
from casewright.plans.proxy import (
    AS_OF, COEFFICIENTS, MODEL_NAMES, decided, entity_table, explained_rows, explanations,
    feature_rows, periods, score_columns, scored_rows, send_log, subjects, table, teams,
)
from casewright.session import staged
from casewright.sources.catalog import default_assignments
from casewright.sources.literals import intervention_catalog, reason_mapping


def now():
    return F.lit(AS_OF).cast("timestamp")


def order_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").alias("entity_id")
    return (
        orders.select(key, "o_orderstatus"),
        orders.select(key, "o_totalprice"),
        periods(spark, sf_dir).select("entity_id", "enr1", "enr2"),
    )


@check("star_join_inner", f"""WITH {SUBJ} SELECT o_orderkey AS entity_id, o_orderstatus, o_totalprice, enr1, enr2
  FROM orders JOIN per ON entity_id = o_orderkey""")
def star_join_inner(spark, sf_dir):
    base, *dims = order_parts(spark, sf_dir)
    return joins.star_join(base, dims, "entity_id")


@check("star_join_left", f"""WITH {SUBJ} SELECT o_orderkey AS entity_id, o_orderstatus, o_totalprice, enr1, enr2
  FROM orders LEFT JOIN per ON entity_id = o_orderkey""")
def star_join_left(spark, sf_dir):
    base, *dims = order_parts(spark, sf_dir)
    return joins.star_join(base, dims, "entity_id", "left")


@check("enrich_facts", """SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal
  FROM orders JOIN customer ON c_custkey = o_custkey""")
def enrich_facts(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.enrich(facts, customer, "o_custkey", ["c_mktsegment", "c_acctbal"])


@check("left_join_default", """SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def left_join_default(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    return joins.left_join_default(documents, labels, "doc_id", {"quality": -1, "toxic": 0})


@check("attach_global", """SELECT c_custkey, (SELECT max(c_acctbal) FROM customer) AS best,
  (SELECT count(*) FROM customer) AS n FROM customer""")
def attach_global(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    one = customer.agg(F.max("c_acctbal").alias("best"), F.count("*").alias("n"))
    return joins.attach_global(customer.select("c_custkey"), one)


TEAM = """CASE WHEN entity_id % 7 <> 3 THEN 'team' || (entity_id % 7) || '@example.org' END"""
TEAMS = f"""teams AS (SELECT entity_id, 'Team ' || (entity_id % 7) AS counselor_name, {TEAM} AS counselor_email,
  CASE WHEN entity_id % 11 = 0 THEN 0 WHEN entity_id % 2 = 0 THEN 1 END AS active_flag FROM scored)"""
RECENT = """recent AS (SELECT DISTINCT user_id AS entity_id, 'team' || (event_id % 7) || '@example.org' AS counselor_email
  FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR)"""


@check("assign_active", f"""WITH {SCORED}, {TEAMS} SELECT entity_id, risk_score, counselor_name, counselor_email
  FROM scored JOIN teams USING (entity_id) WHERE coalesce(active_flag, 1) = 1""")
def assign_active(spark, sf_dir):
    scored = staged(scored_rows(spark, sf_dir).select("entity_id", "risk_score"))
    return joins.assign(scored, teams(scored))


@check("recent_sends", f"WITH {RECENT} SELECT * FROM recent")
def recent_sends(spark, sf_dir):
    return alerts.recent_sends(send_log(spark, sf_dir), ["entity_id", "counselor_email"], now())


@check("suppress_recent", f"""WITH {RECENT}, due AS (SELECT event_id, user_id AS entity_id,
  CASE WHEN event_id % 7 <> 3 THEN 'team' || (event_id % 7) || '@example.org' END AS counselor_email FROM events)
SELECT * FROM due d WHERE NOT EXISTS (SELECT 1 FROM recent r
  WHERE r.entity_id = d.entity_id AND r.counselor_email = d.counselor_email)""")
def suppress_recent(spark, sf_dir):
    log = send_log(spark, sf_dir)
    team = F.col("event_id") % 7
    due = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("entity_id"),
        F.when(team != 3, F.concat(F.lit("team"), team, F.lit("@example.org"))).alias("counselor_email"),
    )
    keys = ["entity_id", "counselor_email"]
    return joins.suppress_recent(due, alerts.recent_sends(log, keys, now()), keys).select("event_id", *keys)


@check("audit_frame", """SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), 'unknown') AS quality, lang,
  lang || '|' || coalesce(CAST(quality AS VARCHAR), 'unknown') AS lang_x_quality
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def audit_frame(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    crosses = {"lang_x_quality": ["lang", "quality"]}
    return joins.audit_frame(documents, [labels], "doc_id", ["lang", "quality"], crosses)


@check("flagged_only", f"WITH {SCORED} SELECT entity_id, target, course FROM scored WHERE predicted = 1")
def flagged_only(spark, sf_dir):
    rows = staged(scored_rows(spark, sf_dir).select("entity_id", "target", "course", "predicted"))
    flagged = rows.where(F.col("predicted") == 1)
    return joins.semi(rows, flagged, "entity_id").select("entity_id", "target", "course")


@check("score_lookup", f"""WITH {SCORED} SELECT c.c_custkey AS entity_id, coalesce(risk_score, 0.0) AS risk_score
  FROM customer c LEFT JOIN scored s ON s.entity_id = c.c_custkey * 13""")
def score_lookup(spark, sf_dir):
    scores = scored_rows(spark, sf_dir).select(F.col("entity_id").alias("wanted"), "risk_score")
    wanted = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_id"), (F.col("c_custkey") * 13).alias("wanted")
    )
    return joins.left_join_default(wanted, scores, "wanted", {"risk_score": 0.0}).select("entity_id", "risk_score")


PARTIAL = f"""WITH {CONTRIB}, {REASONS}, names AS (
  SELECT CASE feature WHEN 'gender' THEN 'cat__gender_1' ELSE 'num__' || feature END AS raw, count(*) AS n
  FROM contrib GROUP BY 1 UNION ALL
  SELECT 'cat__' || replace(lower(o_orderstatus), 'f', 'course') || '_' || (o_custkey % 9) AS raw, count(*) FROM orders GROUP BY 1),
stripped AS (SELECT raw, n, regexp_replace(regexp_replace(lower(raw), '^(num|cat)__', ''), '_[0-9]+$', '') AS name FROM names),
hits AS (SELECT raw, n, name, reason, ordinal, CASE WHEN key = name THEN 0 ELSE 1 END AS kind
  FROM stripped LEFT JOIN reasons ON name <> '' AND (contains(name, key) OR contains(key, name)))"""


@check("map_reasons", PARTIAL + """ SELECT raw, n, coalesce(reason, 'Other model risk signal') AS reason FROM hits
  QUALIFY row_number() OVER (PARTITION BY raw ORDER BY kind, ordinal) = 1""")
def map_reasons(spark, sf_dir):
    scored = staged(score_columns(scored_rows(spark, sf_dir)))
    long = long_contributions(explained_rows(scored), list(COEFFICIENTS), ["entity_id"])
    raw = F.when(F.col("feature") == "gender", MODEL_NAMES["gender"]).otherwise(F.concat(F.lit("num__"), "feature"))
    seen = long.groupBy(raw.alias("raw")).agg(F.count("*").alias("n"))
    status = F.concat(
        F.lit("cat__"), F.replace(F.lower("o_orderstatus"), F.lit("f"), F.lit("course")), F.lit("_"), F.col("o_custkey") % 9
    )
    levels = table(spark, sf_dir, "orders").groupBy(status.alias("raw")).agg(F.count("*").alias("n"))
    return seen.unionByName(levels).withColumn("reason", reason_of("raw"))


FIT = f"""WITH {SCORED}, {CATALOG}, fit AS (
  SELECT entity_id, risk_score, financial_stress_index AS stress, c.*
  FROM scored s JOIN catalog c ON c.risk_score_threshold <= s.risk_score + 0.15
    AND c.financial_stress_level <= s.financial_stress_index + 1)"""


@check("recommend_interventions", FIT + """
SELECT entity_id, risk_score, stress AS financial_stress_index,
  row_number() OVER (PARTITION BY entity_id ORDER BY success_rate DESC, intervention_type) AS option_rank,
  intervention_type, CAST(success_rate AS DOUBLE) AS success_rate, CAST(avg_cost AS DOUBLE) AS avg_cost, description, category
FROM fit QUALIFY option_rank <= 5""")
def recommend_interventions(spark, sf_dir):
    scored = scored_rows(spark, sf_dir)
    return joins.recommend_interventions(scored, intervention_catalog(spark), "entity_id", "risk_score", "financial_stress_index")


@check("catalog_reach", FIT + """
SELECT c.intervention_type, c.category, count(entity_id) AS entities
FROM catalog c LEFT JOIN fit f ON f.intervention_type = c.intervention_type GROUP BY 1, 2""")
def catalog_reach(spark, sf_dir):
    catalog = intervention_catalog(spark)
    reach = joins.intervention_reach(scored_rows(spark, sf_dir), catalog, "risk_score", "financial_stress_index")
    return joins.left_join_default(catalog.select("intervention_type", "category"), reach, "intervention_type", {"entities": 0})


@check("reason_mapping_usage", f"""WITH {TOP} SELECT r.key AS raw_feature_key, r.reason AS mapped_reason, count(t.f) AS uses
FROM reasons r LEFT JOIN (SELECT unnest([factor_1, factor_2, factor_3]) AS f FROM top) t ON t.f = r.reason GROUP BY 1, 2""")
def reason_mapping_usage(spark, sf_dir):
    scored = staged(score_columns(scored_rows(spark, sf_dir)))
    uses = statistics.long_factors(explanations(scored), ["factor_1", "factor_2", "factor_3"]).groupBy(
        F.col("factor").alias("mapped_reason")
    ).agg(F.count("*").alias("uses"))
    mapping = reason_mapping(spark).drop("ordinal")
    return joins.left_join_default(mapping, uses, "mapped_reason", {"uses": 0})


@check("default_assignments", """SELECT DISTINCT l_orderkey AS entity_id, 'Default Counselor' AS counselor_name,
  'counselor@example.org' AS counselor_email, 1 AS active_flag FROM lineitem""")
def assignments_by_default(spark, sf_dir):
    queue = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entity_id"))
    constants = {"counselor_name": "Default Counselor", "counselor_email": "counselor@example.org"}
    return default_assignments(queue, "entity_id", constants)


# --- aggregation ------------------------------------------------------------------------------


@check("group_count", """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""")
def group_count(spark, sf_dir):
    return statistics.group_count(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], "n")


@check("global_max", "SELECT max(coalesce(quality, 0)) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def global_max(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return statistics.global_max(rows, "quality")


@check("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type").dropDuplicates()


@check("class_balance", """SELECT o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share,
  round((sum(count(*)) OVER () - count(*)) / count(*), 2) AS rest_per_row FROM orders GROUP BY 1""")
def class_balance(spark, sf_dir):
    return statistics.class_balance(table(spark, sf_dir, "orders"), "o_orderstatus")


@check("score_by_outcome", f"WITH {SCORED} SELECT target, count(*) AS n, round(avg(risk_score), 4) AS avg_risk_score FROM scored GROUP BY 1")
def score_by_outcome(spark, sf_dir):
    return statistics.score_by_outcome(scored_rows(spark, sf_dir), "target", "risk_score")


@check("high_risk_count", f"WITH {SCORED} SELECT count(*) FILTER (WHERE risk_score >= 0.7) AS n FROM scored")
def high_risk_count(spark, sf_dir):
    return statistics.count_where(scored_rows(spark, sf_dir), F.col("risk_score") >= 0.7)


@check("quantile_exact", "SELECT quantile_disc(l_extendedprice, 0.25) AS cut FROM lineitem")
def quantile_exact(spark, sf_dir):
    return quantile(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.25)


@check("quantile_sketch", "SELECT quantile_disc(o_totalprice, 0.75) AS cut FROM orders")
def quantile_sketch(spark, sf_dir):
    return quantile(table(spark, sf_dir, "orders"), "o_totalprice", 0.75)


# --- group statistics -------------------------------------------------------------------------


@check("group_means", """SELECT c_custkey, round(avg(c_acctbal) OVER (PARTITION BY c_nationkey), 4) AS mean_balance,
  round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) OVER (PARTITION BY c_nationkey), 4) AS building_share
  FROM customer""")
def group_means(spark, sf_dir):
    building = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(1.0)).otherwise(F.lit(0.0))
    rows = statistics.with_group_stats(
        table(spark, sf_dir, "customer"), ["c_nationkey"],
        {"mean_balance": F.col("c_acctbal"), "building_share": building}, digits=4,
    )
    return rows.select("c_custkey", "mean_balance", "building_share")


NULL_GROUP = """SELECT entity_id, {} FROM (SELECT entity_id, nullif(enr1, 0) AS grp, CAST(noeval2 AS DOUBLE) AS v FROM subj)"""


@check("group_means_null_key", f"WITH {SUBJ} " + NULL_GROUP.format("grp, round(avg(v) OVER (PARTITION BY grp), 4) AS mean_v"))
def group_means_null_key(spark, sf_dir):
    rows = subjects(spark, sf_dir).select(
        "entity_id", F.nullif("enr1", F.lit(0)).alias("grp"), F.col("noeval2").cast("double").alias("v")
    )
    return statistics.with_group_stats(rows, ["grp"], {"mean_v": F.col("v")}, 4).select("entity_id", "grp", "mean_v")


@check("gap_to_group", """SELECT c_custkey, round(c_acctbal - round(avg(c_acctbal) OVER (PARTITION BY c_nationkey), 6), 2) AS gap FROM customer""")
def gap_to_group(spark, sf_dir):
    rows = statistics.gap_to_group(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", F.col("c_acctbal"), "gap", 2)
    return rows.select("c_custkey", "gap")


@check("below_quantile_flag", f"WITH {FEAT} SELECT entity_id, grade_deflation_flag FROM feat")
def below_quantile_flag(spark, sf_dir):
    return feature_rows(spark, sf_dir).select("entity_id", "grade_deflation_flag")


@check("leave_one_out_mean", f"""WITH {SUBJ} SELECT entity_id,
  round((sum(d) OVER w - d) / nullif(count(*) OVER w - 1, 0), 4) AS other_rate
  FROM (SELECT entity_id, course, CAST(target = 'Dropout' AS INTEGER) AS d FROM subj)
  WINDOW w AS (PARTITION BY course)""")
def leave_one_out_mean(spark, sf_dir):
    rows = entity_table(spark, sf_dir).withColumn("d", F.when(F.col("target") == "Dropout", 1).otherwise(0))
    return statistics.with_leave_one_out_mean(rows, ["course"], "d", "other_rate", 4).select("entity_id", "other_rate")


# --- order ------------------------------------------------------------------------------------


@check("priority_rank", f"""WITH {SCORED} SELECT entity_id, risk_score,
  row_number() OVER (ORDER BY risk_score DESC, entity_id) AS priority_rank FROM scored""")
def full_rank(spark, sf_dir):
    scored = scored_rows(spark, sf_dir).select("entity_id", "risk_score")
    return priority_rank(scored, "risk_score", "entity_id").select("entity_id", "risk_score", "priority_rank")


@check("running_totals", """SELECT event_id, CAST(sum(k) OVER (ORDER BY ts, event_id) AS BIGINT) AS upto
  FROM (SELECT event_id, ts, CAST(value * 100 AS BIGINT) AS k FROM events)""")
def running_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("k"))
    return with_running_totals(rows, ["ts", "event_id"], {"upto": "k"}).select("event_id", "upto")


@check("top_n", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100")
def best_customers(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return top_n(rows, [F.col("c_acctbal").desc(), "c_custkey"], 100)


@check("recent_log", """SELECT user_id AS entity_id, event_id, ts AS sent_ts FROM events ORDER BY ts DESC, event_id LIMIT 50""")
def recent_log(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), "event_id", F.col("ts").alias("sent_ts"))
    return alerts.recent_log(log, 50, "event_id")


@check("stack_reports", """SELECT 'status' AS attribute, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def stack_reports(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return statistics.stack_reports([
        orders.groupBy(F.lit(name).alias("attribute"), F.col(column).alias("value")).agg(F.count("*").alias("n"))
        for name, column in (("status", "o_orderstatus"), ("priority", "o_orderpriority"))
    ])


# --- alerts -----------------------------------------------------------------------------------

PENDING = f"""pending AS (SELECT s.*, t.counselor_name, t.counselor_email FROM queue s JOIN teams t USING (entity_id)
  WHERE s.predicted = 1 AND s.risk_score >= 0.7 AND coalesce(active_flag, 1) = 1 AND NOT EXISTS (
    SELECT 1 FROM recent r WHERE r.entity_id = s.entity_id AND r.counselor_email = t.counselor_email))"""


def register_alerts():
    from casewright.plans.checks.sql import QUEUE

    @check("eligible_alerts", f"WITH {QUEUE} SELECT entity_id, risk_score FROM queue WHERE predicted = 1 AND risk_score >= 0.7")
    def eligible_alerts(spark, sf_dir):
        return alerts.eligible(scored_rows(spark, sf_dir)).select("entity_id", "risk_score")

    @check("pending_alerts", f"""WITH {QUEUE}, {TEAMS}, {RECENT}, {PENDING}
      SELECT entity_id, counselor_name, counselor_email, risk_score, recommended_action, top_risk_factor_1 FROM pending""")
    def pending_alerts(spark, sf_dir):
        queue = decided(spark, sf_dir)
        due = alerts.pending_alerts(queue, teams(queue), send_log(spark, sf_dir), now())
        return due.select(
            "entity_id", "counselor_name", "counselor_email", "risk_score", "recommended_action", "top_risk_factor_1"
        )

    body = (
        "'Hello ' || counselor_name || ',' || chr(10) || chr(10) || "
        "'This is an automated student risk alert generated from the dropout monitoring workflow.' || chr(10) || chr(10) || "
        f"'Student ID: ' || entity_id || chr(10) || 'Risk score: ' || printf('%.3f', {half_up('risk_score', 3)}) || chr(10) || "
        "'Recommended action: ' || recommended_action || chr(10) || 'Top reasons:' || chr(10) || "
        "'1. ' || top_risk_factor_1 || chr(10) || '2. ' || top_risk_factor_2 || chr(10) || '3. ' || top_risk_factor_3 || "
        "chr(10) || chr(10) || 'Queue timestamp: 2024-01-31 00:00:00' || chr(10) || chr(10) || "
        "'Please review the student record and take the recommended next step.' || chr(10)"
    )

    @check("outbox_rows", f"""WITH {QUEUE}, {TEAMS}, {RECENT}, {PENDING}
      SELECT entity_id, counselor_email, risk_score, recommended_action, top_risk_factor_1, top_risk_factor_2,
        top_risk_factor_3, printf('Student Risk Alert: Student %d score %.3f', entity_id, {half_up('risk_score', 3)}) AS alert_subject,
        {body} AS alert_body, 'pending' AS sent_status, CAST(NULL AS VARCHAR) AS sent_error,
        TIMESTAMP '2024-01-31 00:00:00' AS sent_ts FROM pending""")
    def outbox_rows(spark, sf_dir):
        queue = decided(spark, sf_dir)
        due = alerts.pending_alerts(queue, teams(queue), send_log(spark, sf_dir), now())
        return alerts.outbox_rows(alerts.render_alerts(due), now())


register_alerts()
