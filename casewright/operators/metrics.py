"""Classifier quality from counts; no score column ever reaches the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.operators.fairness import confusion, rate
from casewright.operators.joins import null_safe_lookup
from casewright.operators.ordering import with_running_totals

# Columns of the metrics table.
METRICS_SCHEMA = (
    "model_name string, run_id string, is_best_model bigint, registered_model_name string, "
    "registered_model_version bigint, accuracy double, precision double, recall double, f1 double, "
    "roc_auc double, training_ts timestamp"
)


def binary_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Accuracy, precision, recall and F1 in one row; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return df.agg(*confusion(actual, predicted)).select(
        rate(tp + tn, F.col("population_count")).alias("accuracy"),
        rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"),
        rate(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str = "actual", score: str = "risk_score", keys: Sequence[str] = ()) -> DataFrame:
    """Tie-aware area under the ROC curve, NULL when only one class occurs: one row, or one per group of ``keys``.

    Rows are first counted per distinct score; every positive beats the negatives below it and half of
    those it ties with. The running count is distributed, so the scores may be all different.
    """
    by_score = df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    running = with_running_totals(by_score, [*keys, "score"], {"neg_upto": "neg"})
    if keys:
        # The running count goes on through the groups in order; take off what stands before each group.
        first = running.groupBy(*keys).agg(F.min(F.col("neg_upto") - F.col("neg")).alias("neg_before"))
        running = null_safe_lookup(running, first, list(keys)).withColumn("neg_upto", F.col("neg_upto") - F.col("neg_before"))
    wins = F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg") / F.lit(2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return running.groupBy(*keys).agg(F.try_divide(F.sum(wins), pairs).alias("roc_auc"))


def select_best(metrics: DataFrame, preferred: str) -> DataFrame:
    """The row with the highest AUC; ``preferred`` wins a tie."""
    return metrics.orderBy(
        F.col("roc_auc").desc(), (F.col("model_name") == preferred).desc(), F.col("model_name")
    ).limit(1)


def metrics_table(
    spark: SparkSession, evaluated: Mapping[str, Mapping[str, float]], preferred: str, as_of: Column,
    locations: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed metrics rows, one per model, with the best one flagged; ``run_id`` holds its location."""
    best = max(evaluated, key=lambda m: (evaluated[m]["roc_auc"], m == preferred))
    rows = [
        (name, (locations or {}).get(name, name), int(name == best), "", -1,
         *(float(values[m]) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")))
        for name, values in evaluated.items()
    ]
    untimed = METRICS_SCHEMA.rsplit(",", 1)[0]
    return spark.createDataFrame(rows, untimed).withColumn("training_ts", as_of.cast("timestamp"))


def evaluate(scored: DataFrame, actual: str, predicted: str, score: str) -> dict[str, float]:
    """All five metrics as numbers (two one-row results)."""
    return {
        **binary_metrics(scored, actual, predicted).first().asDict(),
        **roc_auc(scored, actual, score).first().asDict(),
    }


def best_name(metrics: DataFrame) -> str:
    """Name of the flagged model."""
    return metrics.where(F.col("is_best_model") == 1).select("model_name").first()[0]


