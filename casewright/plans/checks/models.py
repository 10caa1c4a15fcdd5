"""Models of a label that can be learned: text quality from the shape of the text. What they promise is checked as rows of truths."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casewright.operators import learning, metrics, treeshap
from casewright.plans.checks.registry import check
from casewright.plans.proxy import table
from casewright.session import staged

#: The least area under the ROC curve on held-out rows, far below what is reached and far above chance.
LEAST_AUC = 0.9
TREES = 60
OUTSIDE = ["doc_id", "quality", "is_test", "class_weight"]


def quality_rows(spark, sf_dir):
    """Labelled documents with the shares of symbols, capitals, distinct words and distinct lines."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = documents.join(labels.select("doc_id", "quality"), "doc_id").withColumns({"words": F.split("text", " "), "lines": F.split("text", "\n")})
    share = lambda kept: F.length(F.regexp_replace("text", kept, "")) / F.greatest(F.length("text"), F.lit(1))
    distinct = lambda c: F.size(F.array_distinct(c)) / F.size(c)
    return rows.select(
        "doc_id", "quality", "lang", "n_chars", F.size("words").alias("n_words"), share("[^#*$%&|<>]").alias("symbols"), share("[^A-Z]").alias("capitals"),
        distinct("words").alias("different_words"), distinct("lines").alias("different_lines"),
    )


def prepared(spark, sf_dir):
    parts = staged(learning.stratified_split(quality_rows(spark, sf_dir), "quality", "doc_id"))
    train = staged(learning.class_weights(parts.where("is_test = 0"), "quality"))
    columns = learning.ml_columns(parts, ["lang"], OUTSIDE, [])
    return parts, train, learning.build_preprocessor(train, columns), columns


SPLIT = """labelled AS (SELECT doc_id, quality, lang FROM documents JOIN labels USING (doc_id)),
split AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '-42'), doc_id) <= round(0.2 * count(*) OVER (PARTITION BY quality)) AS is_test FROM labelled)"""


@check("quality_model_floors", f"""WITH {SPLIT} SELECT unnest(['logistic_regression_baseline', 'random_forest_baseline']) AS model_name, n AS test_rows,
  true AS auc_reached, true AS scores_in_range, true AS decided_at_half FROM (SELECT count(*) AS n FROM split WHERE is_test)""")
def quality_model_floors(spark, sf_dir):
    parts, train, stages, _ = prepared(spark, sf_dir)
    test, out = parts.where("is_test = 1"), None
    models = {"logistic_regression_baseline": learning.fit_lr(train, stages, "quality"), "random_forest_baseline": learning.fit_rf(train, stages, "quality", trees=TREES)}
    for name, model in models.items():
        scored = staged(learning.score(model, test).select("quality", "risk_score", "predicted"))
        right = F.bool_and((F.col("risk_score") >= 0.5) == (F.col("predicted") == 1))
        told = scored.agg(F.count(F.lit(1)).alias("test_rows"), F.bool_and(F.col("risk_score").between(0, 1)).alias("scores_in_range"), right.alias("decided_at_half"))
        auc = metrics.roc_auc(scored, "quality", "risk_score").select("roc_auc").scalar()
        row = told.select(F.lit(name).alias("model_name"), "test_rows", (auc >= LEAST_AUC).alias("auc_reached"), "scores_in_range", "decided_at_half")
        out = row if out is None else out.union(row)
    return out


@check("quality_tree_additivity", f"WITH {SPLIT} SELECT doc_id, true AS additive FROM split WHERE is_test")
def quality_tree_additivity(spark, sf_dir):
    """Base value and contributions of every held-out row add up to its score within a millionth."""
    parts, train, stages, _ = prepared(spark, sf_dir)
    model = learning.fit_rf(train, stages, "quality", trees=TREES)
    scored = learning.score(model, parts.where("is_test = 1"))
    rows, base = treeshap.tree_contributions(model.stages[-1], scored, ["doc_id", "risk_score"])
    total = F.aggregate("contributions", F.lit(base), lambda a, c: a + c)
    return rows.select("doc_id", (F.abs(total - F.col("risk_score")) < 1e-6).alias("additive"))


@check("quality_vectors", f"""WITH {SPLIT} SELECT doc_id, 6 + (SELECT count(DISTINCT lang) FROM split WHERE NOT is_test) AS width, 1.0::DOUBLE AS levels_set FROM split
  WHERE lang IN (SELECT lang FROM split WHERE NOT is_test)""")
def quality_vectors(spark, sf_dir):
    """Six numbers and one place a language, of which one is set."""
    parts, train, stages, columns = prepared(spark, sf_dir)
    vectors = Pipeline(stages=stages).fit(train).transform(parts).withColumn("v", vector_to_array("features"))
    hot = F.aggregate(F.slice("v", len(columns.numeric) + 1, 1000), F.lit(0.0), lambda a, c: a + c)
    return vectors.select("doc_id", F.size("v").cast("bigint").alias("width"), hot.alias("levels_set")).where("levels_set > 0")
