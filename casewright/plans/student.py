"""The complete batch flow on the student source: file to tables, model, audit, queue and outbox.

Each stage is a function from DataFrames to DataFrames; ``run`` writes every layer once and continues
from the stored table, so no stage recomputes an earlier one.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.functions.actions import recommend_action
from casewright.operators import alerts, learning, metrics
from casewright.operators.explain import top_reasons_array
from casewright.operators.fairness import fairness_audit
from casewright.operators.identity import with_lineage, with_record_hash
from casewright.operators.joins import audit_frame, semi, star_join
from casewright.operators.ordering import with_arrival_id
from casewright.operators.quality import (
    Rule, apply_rules, require_columns, rule_in_set, rule_le, rule_min, with_flags,
)
from casewright.operators.queue import FACTORS, intervention_queue
from casewright.operators.treeshap import tree_contributions
from casewright.plans.features import (
    Entity, Money, Period, feature_table, financial_risk_band, ratio_columns, split_tables,
)
from casewright.session import staged, staging_root
from casewright.sources.catalog import (
    TABLES, default_assignments, ensure_schemas, layer_names, write_run, write_table,
)
from casewright.sources.files import read_csv
from casewright.sources.literals import reason_mapping
from casewright.sources.names import normalize_columns
from casewright.vocabulary import SENSITIVE_FEATURES

KEY = "student_id"


def _period(number: str) -> Period:
    stem = f"curricular_units_{number}_sem"
    return Period(*[f"{stem}_{part}" for part in ("enrolled", "evaluations", "approved", "grade", "without_evaluations")])


FIRST, SECOND = _period("1st"), _period("2nd")
MONEY = Money("debtor", "tuition_fees_up_to_date", "scholarship_holder")
STUDENT = Entity(KEY, FIRST, SECOND, MONEY, "course", "admission_grade", "application_order")
CREDITED = ["curricular_units_1st_sem_credited", "curricular_units_2nd_sem_credited"]
MACRO = ["unemployment_rate", "inflation_rate", "gdp"]
OUTCOMES = ["Dropout", "Graduate", "Enrolled"]
YES_NO = [*MONEY, "displaced", "educational_special_needs", "international"]


def _typed(kind: str, *names: str) -> dict[str, tuple[str, str]]:
    return {name: (name, kind) for name in names}


COUNTS = [c for p, credited in zip((FIRST, SECOND), CREDITED) for c in (credited, p.enrolled, p.evaluated, p.approved, p.missed)]

# Subject tables: output column -> (input column, type).
SUBJECTS: Mapping[str, Mapping[str, tuple[str, str]]] = {
    "profile": _typed("int", "course", "application_mode", "application_order", "daytime_evening_attendance"),
    "demographic": _typed(
        "int", "marital_status", "nacionality", "gender", "age_at_enrollment", "international", "displaced",
        "educational_special_needs",
    ),
    "background": _typed("int", "previous_qualification")
    | _typed("double", "previous_qualification_grade", "admission_grade"),
    "family": _typed("int", "mothers_qualification", "fathers_qualification", "mothers_occupation", "fathers_occupation"),
    "financial": _typed("int", *MONEY),
    "performance": _typed("int", *COUNTS) | _typed("double", FIRST.grade, SECOND.grade),
    "context": _typed("double", *MACRO) | _typed("string", "target"),
}
REQUIRED = list(dict.fromkeys([KEY, *[source for spec in SUBJECTS.values() for source, _ in spec.values()]]))

# Columns the model treats as categories.
CATEGORICAL = [
    "course", "application_mode", "application_order", "daytime_evening_attendance", "previous_qualification",
    "debtor", "tuition_fees_up_to_date", "scholarship_holder", "financial_risk_band", "financial_segment",
    "academic_momentum_band", "grade_drop_flag", "approval_drop_flag", "engagement_drop_flag", "is_ghosting",
    "is_primary_choice", "grade_deflation_flag",
]
NOT_FEATURES = [KEY, "target", "target_dropout", "feature_ts", "silver_created_ts", "is_test", "class_weight"]
FOREST, LOGISTIC = "random_forest_baseline", "logistic_regression_baseline"
AUDITED = ["gender", "financial_segment", "scholarship_holder", "gender_x_financial_segment"]


def ingest(spark: SparkSession, path: str, as_of: Column, schema: str | None = None) -> DataFrame:
    """CSV to bronze rows: clean names, dense ids, fingerprint and lineage."""
    numbered = normalize_columns(with_arrival_id(read_csv(spark, path, schema), KEY))
    hashed = with_record_hash(numbered, exclude=[KEY])
    return with_lineage(hashed, as_of, path)


def validation_rules() -> list[Rule]:
    non_negative = ["age_at_enrollment", "admission_grade", "previous_qualification_grade", *COUNTS]
    return [
        rule_in_set("invalid_binary_flag", YES_NO, [0, 1]),
        rule_min("negative_numeric_flag", non_negative, 0),
        rule_le("sem1_inconsistent_flag", [FIRST.approved, FIRST.missed], FIRST.enrolled),
        rule_le("sem2_inconsistent_flag", [SECOND.approved, SECOND.missed], SECOND.enrolled),
        rule_in_set("invalid_target_flag", ["target"], OUTCOMES),
    ]


def validate(bronze: DataFrame, on_null: str = "drop") -> DataFrame:
    rules = validation_rules()
    return with_flags(apply_rules(require_columns(bronze, REQUIRED), rules, on_null), rules)


def subject_tables(validated: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The seven typed tables with their derived columns."""
    tables = split_tables(validated, SUBJECTS, KEY)
    tables["financial"] = tables["financial"].withColumn("financial_risk_band", financial_risk_band(MONEY))
    tables["performance"] = tables["performance"].withColumns(ratio_columns(FIRST, SECOND))
    tables["context"] = tables["context"].withColumn(
        "target_dropout", F.when(F.col("target") == "Dropout", 1).otherwise(0)
    )
    return {name: df.withColumn("silver_created_ts", as_of.cast("timestamp")) for name, df in tables.items()}


def features(tables: Mapping[str, DataFrame], as_of: Column, state: str | None = None) -> DataFrame:
    """Join the subject tables on the key, mark the held-out rows and add every derived feature.

    Group statistics are fitted on the rows that are not held out; ``state`` names a table to keep them in.
    """
    parts = [tables[name].drop("silver_created_ts") for name in SUBJECTS]
    joined = staged(learning.stratified_split(star_join(parts[0], parts[1:], KEY), "target_dropout", KEY))
    rows = feature_table(joined, STUDENT, fit_on=joined.where(F.col("is_test") == 0), state=state)
    return rows.withColumn("feature_ts", as_of.cast("timestamp"))


class Trained(NamedTuple):
    models: Mapping[str, object]
    columns: learning.ModelColumns
    metrics: DataFrame
    best: str
    scores: DataFrame


def train_and_score(
    feature_rows: DataFrame, as_of: Column, trees: int = learning.FOREST_TREES,
    iterations: int = learning.LOGISTIC_ITERATIONS, run_id: str = "latest",
) -> Trained:
    """Fit both models on the rows with ``is_test`` 0, keep the better one by AUC, score the others."""
    spark = feature_rows.sparkSession
    columns = learning.ml_columns(feature_rows, CATEGORICAL, NOT_FEATURES, SENSITIVE_FEATURES)
    parts = feature_rows
    train = staged(learning.class_weights(parts.where(F.col("is_test") == 0), "target_dropout"))
    test = parts.where(F.col("is_test") == 1)
    stages = learning.build_preprocessor(train, columns)
    models = {
        LOGISTIC: learning.fit_lr(train, stages, "target_dropout", max_iter=iterations),
        FOREST: learning.fit_rf(train, stages, "target_dropout", trees=trees),
    }
    scored = {
        name: staged(
            learning.score(model, test, predicted="predicted_dropout").select(
                KEY, F.col("target_dropout").alias("actual_dropout"), "risk_score", "predicted_dropout"
            )
        )
        for name, model in models.items()
    }
    evaluated = {
        name: metrics.evaluate(df, "actual_dropout", "predicted_dropout", "risk_score") for name, df in scored.items()
    }
    root = f"{staging_root(spark)}/models/{run_id}"
    locations = {name: learning.save_model(model, f"{root}/{name}") for name, model in models.items()}
    table = metrics.metrics_table(spark, evaluated, FOREST, as_of, locations)
    best = metrics.best_name(table)
    rows = scored[best].withColumns({"model_name": F.lit(best), "score_ts": as_of.cast("timestamp")})
    return Trained(models, columns, table, best, rows)


def audit(scores: DataFrame, demographic: DataFrame, feature_rows: DataFrame, model: str, as_of: Column) -> DataFrame:
    frame = audit_frame(
        scores.select(KEY, "actual_dropout", "predicted_dropout"),
        [demographic.select(KEY, "gender"), feature_rows.select(KEY, "financial_segment", "scholarship_holder")],
        KEY, AUDITED[:3], {AUDITED[3]: ["gender", "financial_segment"]},
    )
    return fairness_audit(frame, AUDITED, model, as_of, "actual_dropout", "predicted_dropout")


def explain(trained: Trained, feature_rows: DataFrame) -> DataFrame:
    """Top three reasons for everyone predicted positive."""
    flagged = trained.scores.where(F.col("predicted_dropout") == 1)
    model = trained.models[trained.best]
    rows = semi(feature_rows, flagged, KEY).join(flagged.select(KEY, "risk_score"), KEY)
    vectors = model.transform(rows)
    names = learning.feature_names(model, trained.columns)
    if trained.best == FOREST:
        explained, _ = tree_contributions(model.stages[-1], vectors, [KEY, "risk_score"])
    else:
        explained = learning.linear_vector_contributions(model, vectors, vectors)
    return top_reasons_array(explained, names, [KEY, "risk_score"])


def build_queue(scores: DataFrame, explanations: DataFrame, fairness: DataFrame, as_of: Column) -> DataFrame:
    return intervention_queue(
        scores, explanations, fairness, as_of, KEY, "predicted_dropout", "actual_dropout",
        recommend_action("risk_score", FACTORS),
    )


def build_alerts(queue: DataFrame, assignments: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Outbox rows for everyone due; nothing is sent from here."""
    due = alerts.pending_alerts(queue, assignments, log, as_of, KEY, predicted="predicted_dropout")
    return alerts.outbox_rows(alerts.render_alerts(due, KEY), as_of, key=KEY)


ALERT_LOG_SCHEMA = (
    "student_id BIGINT, counselor_email STRING, risk_score DOUBLE, recommended_action STRING, "
    "top_risk_factor_1 STRING, top_risk_factor_2 STRING, top_risk_factor_3 STRING, alert_subject STRING, "
    "alert_body STRING, sent_status STRING, sent_error STRING, sent_ts TIMESTAMP"
)


def run(
    spark: SparkSession, path: str, as_of: str, trees: int = learning.FOREST_TREES,
    iterations: int = learning.LOGISTIC_ITERATIONS,
    contact: tuple[str, str] = ("Default Counselor", "counselor@example.org"), run_id: str | None = None,
) -> dict[str, DataFrame]:
    """All stages in order; returns the stored tables by name.

    ``run_id`` names the run, by default after ``as_of``: its alerts and models are kept beside those of other runs, and a run
    that is started again replaces its own.
    """
    run_id = run_id or "".join(c if c.isalnum() else "-" for c in as_of)
    now = F.lit(as_of).cast("timestamp")
    ensure_schemas(spark, layer_names())
    out: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame, mode: str = "overwrite", key: str | None = KEY) -> DataFrame:
        out[name] = write_table(df, TABLES[name], mode, key)
        return out[name]

    store("reasons", reason_mapping(spark).drop("ordinal"), key=None)
    bronze = store("bronze", ingest(spark, path, now))
    validated = store("validated", validate(bronze))
    silver = {name: store(name, df) for name, df in subject_tables(validated, now).items()}
    rows = store("features", features(silver, now, TABLES["feature_state"]))
    trained = train_and_score(rows, now, trees, iterations, run_id)
    store("metrics", trained.metrics, key=None)
    scores = store("scores", trained.scores)
    fairness = store("fairness", audit(scores, silver["demographic"], rows, trained.best, now), key=None)
    explanations = store("explanations", explain(trained._replace(scores=scores), rows))
    queue = store("queue", build_queue(scores, explanations, fairness, now))
    names = {"counselor_name": contact[0], "counselor_email": contact[1]}
    assignments = default_assignments(queue, KEY, names, TABLES["assignment"])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {TABLES['alerts']} ({ALERT_LOG_SCHEMA}, run_id STRING) USING PARQUET PARTITIONED BY (run_id)")
    # What this run has written itself, if it is started again, does not hold its alerts back.
    log = spark.table(TABLES["alerts"]).where(F.col("run_id") != run_id).drop("run_id")
    due = staged(build_alerts(queue, assignments, log, now))
    out["alerts"] = write_run(due, TABLES["alerts"], run_id, KEY)
    return out


