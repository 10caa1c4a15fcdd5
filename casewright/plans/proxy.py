"""Entity view over the generic order/customer/line tables, used to exercise every operator.

An order plays the entity, the customer's nation its group, line items with status O and F its two
periods. Orders without lines give the NULL paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.operators.explain import linear_contributions, top_reasons_wide
from casewright.operators.fairness import fairness_audit
from casewright.operators.joins import audit_frame
from casewright.operators.queue import decisions, intervention_queue
from casewright.plans.features import Entity, Money, Period, composite_risk, feature_table
from casewright.session import staged

FIRST = Period("enr1", "eval1", "appr1", "grade1", "noeval1")
SECOND = Period("enr2", "eval2", "appr2", "grade2", "noeval2")
MONEY = Money("debtor", "paid", "scholar")
SUBJECT = Entity("entity_id", FIRST, SECOND, MONEY, "course", "admission", "app_order")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items folded into two periods per order; map-side combine absorbs a hot order."""
    line = table(spark, sf_dir, "lineitem")
    columns = []
    for number, status in ((1, "O"), (2, "F")):
        inside = F.col("l_linestatus") == status
        columns += [
            F.count_if(inside).alias(f"enr{number}"),
            F.count_if(inside & (F.col("l_returnflag") != "A")).alias(f"eval{number}"),
            F.count_if(inside & (F.col("l_quantity") >= 20)).alias(f"appr{number}"),
            F.count_if(inside & (F.col("l_returnflag") == "A")).alias(f"noeval{number}"),
            F.coalesce(F.avg(F.when(inside, F.col("l_quantity"))), F.lit(0.0)).alias(f"grade{number}"),
        ]
    return line.groupBy(F.col("l_orderkey").alias("entity_id")).agg(*columns)


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    status = F.col("o_orderstatus")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    people = placed.select(
        F.col("o_orderkey").alias("entity_id"),
        F.col("c_nationkey").alias("course"),
        F.col("c_mktsegment").alias("segment"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("app_order"),
        F.col("o_totalprice").alias("admission"),
        F.col("c_acctbal").alias("prior_grade"),
        (F.col("c_custkey") % 2).cast("int").alias("gender"),
        (F.lit(17) + F.col("c_custkey") % 40).cast("int").alias("age"),
        F.when(status == "F", "Dropout").when(status == "P", "Enrolled").otherwise("Graduate").alias("target"),
        (F.col("c_acctbal") < 0).cast("int").alias("debtor"),
        (F.col("o_totalprice") < 400000).cast("int").alias("paid"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("scholar"),
    )
    return people.join(periods(spark, sf_dir), "entity_id", "left")


# Fixed linear model over feature columns, for explanations that need no training.
COEFFICIENTS = {
    "financial_stress_index": 0.25,
    "absenteeism_index": 0.15,
    "overall_approval_ratio": -0.30,
    "sem_grade_delta": -0.01,
    "overall_grade_avg": -0.02,
    "engagement_risk_proxy": 0.05,
    "total_approved_units": -0.04,
    "evaluation_delta": -0.03,
    "academic_load_delta": 0.02,
    "course_rigor_score": 0.50,
    "gender": 0.30,
    "is_primary_choice": -0.10,
}
# The same columns under the names a one-hot / scaling transformer gives them.
MODEL_NAMES = {name: f"num__{name}" for name in COEFFICIENTS} | {"gender": "cat__gender_1"}


def entity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``subjects`` written once: several passes then read a narrow table instead of the line items."""
    return staged(subjects(spark, sf_dir))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(entity_table(spark, sf_dir), SUBJECT)


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows with a capped composite risk, its 0.5 decision and the true outcome."""
    rows = feature_rows(spark, sf_dir).withColumn(
        "_approval_rate", F.round(F.col("overall_approval_ratio") * F.lit(100.0), 2)
    )
    risk = composite_risk(
        "financial_stress_index", "absenteeism_index", "_approval_rate", "overall_grade_avg", "grade_deflation_flag"
    )
    return (
        rows.withColumn("risk_score", F.least(F.lit(1.0), risk))
        .withColumns({
            "predicted": F.when(F.col("risk_score") >= 0.5, 1).otherwise(0),
            "actual": F.when(F.col("target") == "Dropout", 1).otherwise(0),
        })
        .drop("_approval_rate")
    )


def explained_rows(scored: DataFrame) -> DataFrame:
    """Contributions of the fixed linear model for the rows predicted positive; background: all rows."""
    return linear_contributions(scored.where(F.col("predicted") == 1), COEFFICIENTS, background=scored)


def explanations(scored: DataFrame) -> DataFrame:
    columns = {MODEL_NAMES[name]: f"contrib_{name}" for name in COEFFICIENTS}
    return top_reasons_wide(explained_rows(scored), columns, ["entity_id", "risk_score"])


def audit(scored: DataFrame) -> DataFrame:
    frame = scored.select("entity_id", "actual", "predicted", "gender", "financial_segment", "scholar")
    prepared = audit_frame(
        frame, [], "entity_id", ["gender", "financial_segment", "scholar"],
        {"gender_x_financial_segment": ["gender", "financial_segment"]},
    )
    return fairness_audit(prepared, AUDITED, "composite_risk", F.lit(AS_OF))


AUDITED = ["gender", "financial_segment", "scholar", "gender_x_financial_segment"]
AS_OF = "2024-01-31 00:00:00"


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: features, score, explanation, audit, decision and global rank for every entity."""
    scored = staged(score_columns(scored_rows(spark, sf_dir)))
    return intervention_queue(
        scored, explanations(scored), audit(scored), F.lit(AS_OF).cast("timestamp")
    )


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue without its global rank, for reports that do not read it."""
    scored = staged(score_columns(scored_rows(spark, sf_dir)))
    return decisions(scored, explanations(scored), audit(scored), F.lit(AS_OF).cast("timestamp"))


def score_columns(scored: DataFrame) -> DataFrame:
    """What scoring hands on: id, score, decision, outcome, audited attributes and model features."""
    return scored.select(
        "entity_id", "risk_score", "predicted", "actual", "target", "gender", "financial_segment", "scholar",
        *[c for c in COEFFICIENTS if c != "gender"],
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows from labelled texts: language and source as groups, length as the decision."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return documents.select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id").select(
        "doc_id", "lang", "source",
        F.col("quality").alias("actual"),
        F.when(F.col("n_chars") >= 600, 1).otherwise(0).alias("predicted"),
    )


def send_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert log from the event stream: an error event plays a delivered alert."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity_id"),
        F.concat(F.lit("team"), F.col("event_id") % 7, F.lit("@example.org")).alias("counselor_email"),
        F.when(F.col("event_type") == "error", "sent").otherwise("failed").alias("sent_status"),
        F.col("ts").alias("sent_ts"),
    )


def teams(queue: DataFrame) -> DataFrame:
    """Assignments: seven teams, one of them without an address, some not active."""
    team = F.col("entity_id") % 7
    return queue.select(
        "entity_id",
        F.concat(F.lit("Team "), team).alias("counselor_name"),
        F.when(team != 3, F.concat(F.lit("team"), team, F.lit("@example.org"))).alias("counselor_email"),
        F.when(F.col("entity_id") % 11 == 0, 0).when(F.col("entity_id") % 2 == 0, 1).alias("active_flag"),
    )
