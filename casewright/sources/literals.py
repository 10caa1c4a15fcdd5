"""Fixed lookup tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casewright.vocabulary import FEATURE_REASONS, INTERVENTION_SCHEMA, INTERVENTIONS


def reason_mapping(spark: SparkSession) -> DataFrame:
    rows = [(i, key, reason) for i, (key, reason) in enumerate(FEATURE_REASONS)]
    return spark.createDataFrame(rows, "ordinal int, raw_feature_key string, mapped_reason string")


def intervention_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INTERVENTIONS, INTERVENTION_SCHEMA)
