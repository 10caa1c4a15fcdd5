"""Training and scoring with ``pyspark.ml``; nothing is pulled to the driver but model metadata."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.operators import forest as forests
from casewright.operators.joins import null_safe_lookup
from casewright.operators.ordering import with_global_rank
from casewright.operators.selection import Cut, select_cuts
from casewright.session import staged

# Training settings.
SEED = 42
TEST_FRACTION = 0.2
LOGISTIC_ITERATIONS = 1000
FOREST_TREES = 300
FOREST_DEPTH = 8
FOREST_MIN_LEAF = 5
#: Training rows up to which Spark's estimator grows a forest.
FOREST_ROWS_IN_SPARK = 50_000


class ModelColumns(NamedTuple):
    numeric: list[str]
    categorical: list[str]


def ml_columns(
    df: DataFrame, categorical: Sequence[str], ids_and_labels: Sequence[str], audit_only: Sequence[str]
) -> ModelColumns:
    """Feature columns: everything that is not an id, a label, a timestamp or audit-only."""
    excluded = {*ids_and_labels, *audit_only}
    usable = [c for c in df.columns if c not in excluded]
    return ModelColumns(
        [c for c in usable if c not in categorical], [c for c in usable if c in categorical]
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _modes(train: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value of each column (the smaller on ties), counted before anything is gathered."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = train.select(values.alias("v")).select("v.*").where("value IS NOT NULL").groupBy("name", "value").count() if columns else None
    best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value")).collect() if columns else []
    return dict.fromkeys(columns) | {r["name"]: r["value"] for r in best}


def build_preprocessor(train: DataFrame, columns: ModelColumns, drop_first: bool = False) -> list:
    """Pipeline stages: numeric median fill and standardisation, categorical mode fill and one-hot.

    ``train`` is a stored table; the medians are exact. A level that was not seen in training becomes all zeros. ``drop_first`` leaves out the
    alphabetically first level of each category, as in a dummy coding.
    """
    modes = _modes(train, columns.categorical)
    numbers = train.select(*[F.col(c).cast("double").alias(c) for c in columns.numeric])
    numbers = numbers.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns.numeric])
    medians = select_cuts(numbers, {c: Cut(c, 0.5) for c in columns.numeric}, reread=True)
    known = {c: f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE))" for c in columns.numeric}
    # A column without any value is 0 everywhere.
    casts = [f"coalesce({known[c]}, CAST('{medians[c] or 0.0!r}' AS DOUBLE)) AS `num__{c}`" for c in columns.numeric]
    for c in columns.categorical:
        fill = _sql_text(modes[c] if modes[c] is not None else "missing")
        casts.append(f"coalesce(CAST(`{c}` AS STRING), {fill}) AS `cat__{c}`")
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__")]
    assembled = []
    if columns.numeric:
        names = [f"num__{c}" for c in columns.numeric]
        stages += [
            VectorAssembler(inputCols=names, outputCol="numeric"),
            StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
        ]
        assembled.append("scaled")
    if columns.categorical:
        names = [f"cat__{c}" for c in columns.categorical]
        index = [f"index__{c}" for c in columns.categorical]
        hot = [f"hot__{c}" for c in columns.categorical]
        # The last index is dropped: the bucket of unseen levels, or with drop_first the first level.
        order = "alphabetDesc" if drop_first else "alphabetAsc"
        unseen = "error" if drop_first else "keep"
        stages += [
            StringIndexer(inputCols=names, outputCols=index, handleInvalid=unseen, stringOrderType=order),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
        assembled += hot
    return [*stages, VectorAssembler(inputCols=assembled, outputCol="features")]


def feature_names(model: PipelineModel, columns: ModelColumns) -> list[str]:
    """Names of the vector positions: ``num__x`` and ``cat__x_level``."""
    names = [f"num__{c}" for c in columns.numeric]
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            dropped = 1 if stage.getHandleInvalid() == "error" else 0
            for name, labels in zip(columns.categorical, stage.labelsArray):
                names += [f"cat__{name}_{level}" for level in labels[: len(labels) - dropped]]
    return names


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: float = TEST_FRACTION, seed: int = SEED, exact: bool = True
) -> DataFrame:
    """Mark ``is_test`` for a repeatable share of every class.

    Exact: the ``round(fraction * n)`` smallest hashes per class. Only (label, hash, key) is sorted,
    over range partitions, to find one boundary per class; the wide rows are not shuffled. Not exact:
    a hash threshold, no shuffle at all.
    """
    if not exact:
        million = 1_000_000
        draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(million))
        return df.withColumn("is_test", F.when(draw < int(fraction * million), 1).otherwise(0))
    hashed = df.withColumn("_digest", _digest(key, seed))
    placed = with_global_rank(hashed.select(label, "_digest", key), [label, "_digest", key], "_pos")
    sizes = placed.groupBy(label).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_last", F.col("_first") + F.round(F.lit(fraction) * F.col("_n")) - 1)
    inside = null_safe_lookup(placed, sizes, [label]).where(F.col("_pos") <= F.col("_last"))
    cuts = inside.groupBy(label).agg(F.max(F.struct("_digest", key)).alias("_cut"))
    marked = null_safe_lookup(hashed, cuts, [label])
    is_test = F.struct(F.col("_digest"), F.col(key)) <= F.col("_cut")
    return marked.withColumn("is_test", F.when(is_test, 1).otherwise(0)).drop("_digest", "_cut")


def class_weights(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)`` on every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    everything = counts.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))
    total, classes = everything.select("n").scalar(), everything.select("k").scalar()
    weights = counts.select(label, (total / (classes * F.col("_n"))).alias(name))
    return null_safe_lookup(df, weights, [label])


def _fit_last(train: DataFrame, stages: list, fit: Callable[[DataFrame], Model], label: str, weight: str) -> PipelineModel:
    """The stages fitted on ``train``, then what ``fit`` makes of its vectors, dealt evenly over all cores.

    A stored table comes back in as many tasks as it has files of a certain size, whatever a row of it costs; an estimator reads its rows
    many times and would leave the other cores idle. The vectors are worked out once and stored in as many files as there are cores.
    """
    fitted = Pipeline(stages=stages).fit(train)
    vectors = fitted.transform(train).select("features", label, weight)
    dealt = staged(vectors.repartition(train.sparkSession.sparkContext.defaultParallelism))
    return PipelineModel([*fitted.stages, fit(dealt)])


def fit_lr(
    train: DataFrame, stages: list, label: str, weight: str = "class_weight", max_iter: int = LOGISTIC_ITERATIONS
) -> PipelineModel:
    """Logistic regression with an L2 penalty of strength 1/n."""
    lr = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol=weight, maxIter=max_iter,
        regParam=1.0 / max(train.count(), 1), standardization=False,
    )
    return _fit_last(train, stages, lr.fit, label, weight)


def fit_rf(
    train: DataFrame, stages: list, label: str, weight: str = "class_weight",
    trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, min_leaf: int = FOREST_MIN_LEAF, seed: int = SEED,
) -> PipelineModel:
    """Random forest; with many rows by ``forest.fit``, whose trees differ from those of Spark's estimator as those of another seed do."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed,
    )

    def fit(vectors: DataFrame) -> Model:
        return forest.fit(vectors) if vectors.count() <= FOREST_ROWS_IN_SPARK else forests.fit(forest, vectors)

    return _fit_last(train, stages, fit, label, weight)


def score(
    model: PipelineModel, df: DataFrame, cut: float = 0.5, score_name: str = "risk_score", predicted: str = "predicted"
) -> DataFrame:
    """Probability of the positive class and the decision at ``cut``."""
    scored = model.transform(df).withColumn(score_name, vector_to_array("probability")[1])
    return scored.withColumn(predicted, F.when(F.col(score_name) >= cut, 1).otherwise(0))


def linear_vector_contributions(
    model: PipelineModel, rows: DataFrame, background: DataFrame, name: str = "contributions"
) -> DataFrame:
    """``coef * (x - mean)`` per vector position, as an array column; ``rows`` are transformed rows."""
    coefficients = [float(c) for c in model.stages[-1].coefficients.toArray()]
    means = background.agg(vector_to_array(Summarizer.mean(F.col("features"))).alias("m")).scalar()
    weights = F.array(*[F.lit(c) for c in coefficients])
    centred = F.zip_with(vector_to_array("features"), F.col("_means"), lambda v, m: v - m)
    with_means = rows.withColumn("_means", means)
    return with_means.withColumn(name, F.zip_with(centred, weights, lambda v, c: v * c)).drop("_means")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_best(spark: SparkSession, metrics: DataFrame) -> tuple[PipelineModel, Mapping[str, object]]:
    """The stored pipeline of the best metrics row, found through its ``run_id`` path."""
    row = metrics.orderBy(F.col("is_best_model").desc(), F.col("roc_auc").desc(), "model_name").first()
    return PipelineModel.load(row["run_id"]), row.asDict()
