"""Catalog tables: one database per layer, Parquet storage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casewright.operators.identity import cast_key

# Layer databases and table names.
TABLES = {
    "bronze": "dropout_bronze.student_dropout_raw",
    "validated": "dropout_silver.student_source_validated",
    "profile": "dropout_silver.student_profile",
    "demographic": "dropout_silver.student_demographic_features",
    "background": "dropout_silver.student_academic_background",
    "family": "dropout_silver.student_family_background",
    "financial": "dropout_silver.student_financial_status",
    "performance": "dropout_silver.student_academic_performance",
    "context": "dropout_silver.student_context",
    "assignment": "dropout_silver.student_counselor_assignment",
    "features": "dropout_feature.student_dropout_risk_features",
    "metrics": "dropout_gold.model_metrics",
    "scores": "dropout_gold.model_test_scores",
    "fairness": "dropout_gold.fairness_audit",
    "explanations": "dropout_gold.student_explanations",
    "queue": "dropout_gold.student_intervention_queue",
    "reasons": "dropout_gold.feature_reason_mapping",
    "alerts": "dropout_gold.counselor_email_alert_log",
}
#: Tables of our own beside them.
TABLES["feature_state"] = "dropout_feature.fitted_group_statistics"


def ensure_schemas(spark: SparkSession, names: Iterable[str], root: str | None = None) -> None:
    """Create the databases that are missing, in folders under ``root`` if it is given, else in the warehouse."""
    for name in names:
        place = "" if root is None else f" LOCATION '{root}/{name}'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def layer_names(tables: Iterable[str] = TABLES.values()) -> list[str]:
    return list(dict.fromkeys(t.split(".")[0] for t in tables))


def write_table(df: DataFrame, name: str, mode: str = "overwrite", key: str | None = None) -> DataFrame:
    """Save as a table (overwriting replaces the schema) and return it as read back."""
    rows = df if key is None else cast_key(df, key)
    rows.write.format("parquet").mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Save as a table whose rows lie in ``buckets`` files by the key, sorted by it.

    Tables with equal buckets are joined on the key where they lie, without an exchange or a sort. Buckets are filled by one shuffle here.
    """
    rows = df.repartition(buckets, key)
    rows.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_run(df: DataFrame, name: str, run_id: str, key: str | None = None) -> DataFrame:
    """Put the rows of one run into a table that is partitioned by ``run_id``, all of them or none, once.

    Only the run's own partition is replaced, and it is moved into place when all tasks have ended, so a run that is repeated, or that
    failed half-way and is started again, leaves each of its rows once. A repeated run without rows changes nothing.
    """
    rows = df if key is None else cast_key(df, key)
    rows = rows.withColumn("run_id", F.lit(run_id))
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        ordered = rows.select(*spark.table(name).columns)
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")  # only partitions that have rows, and only when the job commits
        try:
            ordered.write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(setting, before)
    else:
        rows.write.format("parquet").partitionBy("run_id").saveAsTable(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ensure_table(spark: SparkSession, name: str, schema: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING PARQUET")


def reset_tables(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def default_assignments(
    queue: DataFrame, key: str, constants: dict[str, object], existing: str | None = None
) -> DataFrame:
    """The assignment table if there is one, else every queued entity with the same constants."""
    if existing is not None and queue.sparkSession.catalog.tableExists(existing):
        return queue.sparkSession.table(existing)
    rows = queue.select(F.col(key).cast("bigint").alias(key)).dropDuplicates()
    return rows.withColumns({name: F.lit(value) for name, value in constants.items()}).withColumn(
        "active_flag", F.lit(1)
    )


def preview(df: DataFrame, n: int = 5, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*(columns or df.columns)).limit(n)
