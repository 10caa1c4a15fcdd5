"""Forests grown from blocks of rows, and tree SHAP by the outcomes of tests."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from casewright.operators import forest, learning, treeshap
from casewright.session import staged


def rows_of(spark, n=1500, even=True, seed=1):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 20, n), rng.integers(0, 2, n), rng.integers(0, 30, n), np.full(n, 3), rng.integers(-5, 5, n)].astype(float)
    y = ((x[:, 0] > 8).astype(int) + (x[:, 2] > 14) + (rng.random(n) < 0.3) >= 2).astype(float)
    w = np.where(y == 1, 1.3, 0.7) if even else rng.integers(1, 5, n) / 4
    rows = [(i, Vectors.dense(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w))]
    return staged(spark.createDataFrame(rows, ["id", "features", "y", "w"]).repartition(4))


def estimator(**settings):
    return RandomForestClassifier(featuresCol="features", labelCol="y", weightCol="w", maxDepth=5, minInstancesPerNode=5, seed=42, **settings)


@pytest.mark.parametrize("even", [True, False])
def test_without_draws_the_tree_is_that_of_spark(spark, even):
    rows, whole = rows_of(spark, even=even), estimator(numTrees=1, bootstrap=False, featureSubsetStrategy="all")
    ours, theirs = forest.fit(whole, rows), whole.fit(rows)
    assert ours.trees[0].numNodes > 5
    assert ours.toDebugString.split("\n", 1)[1] == theirs.toDebugString.split("\n", 1)[1]


def test_a_forest_repeats_itself_and_scores_like_that_of_spark(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 100)
    rows, many = rows_of(spark), estimator(numTrees=30, featureSubsetStrategy="sqrt")
    ours, again, theirs = forest.fit(many, rows), forest.fit(many, rows), many.fit(rows)
    assert ours.getNumTrees == 30 and ours.numFeatures == 5 and ours.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
    scores = [np.array([r[0] for r in m.transform(rows).orderBy("id").select(vector_to_array("probability")[1]).collect()]) for m in (ours, theirs)]
    assert np.sqrt(np.mean((scores[0] - scores[1]) ** 2)) < 0.05


def test_draws_are_those_of_poisson():
    how = forest.Settings(0, 1, 5, 32, 1, 0.0, 0.0, 1.0, True, 42, 1, 2, 1, None)
    rows, times = forest.drawn(how, forest.poisson_steps(1.0), 0, 7, 200_001)
    assert abs(times.sum() / 200_001 - 1) < 0.01 and abs(len(rows) / 200_001 - (1 - np.exp(-1))) < 0.005
    shares = np.bincount(times.astype(int), minlength=4)[1:4] / 200_001
    assert np.allclose(shares, np.exp(-1) / np.array([1, 2, 6]), atol=0.005)


def test_cuts_leave_like_weights_and_keep_rare_values():
    values = np.random.default_rng(3).permutation(np.arange(100_000.0))
    points, weights = forest.column_points(values, np.ones(100_000))
    assert len(points) == forest.POINTS and weights.sum() == 100_000
    assert np.allclose(forest.cuts_of(points, weights, 3), [25_000, 50_000, 75_000], atol=200)
    assert forest.cuts_of(*forest.column_points(np.array([0.0] * 99_999 + [5.0, 9.0]), np.ones(100_001)), 31) == [2.5, 7.0]


def test_many_rows_do_not_reach_sparks_estimator(spark, monkeypatch):
    rows = spark.range(0, 400, 1, 2).select((F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 7 + F.col("id") % 2 * 9).cast("double").alias("a"), F.lit(1.0).alias("class_weight"))
    seen, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    monkeypatch.setattr(learning, "FOREST_ROWS_IN_SPARK", 399)
    model = learning.fit_rf(rows, learning.build_preprocessor(rows, learning.ModelColumns(["a"], [])), "y", trees=5)
    assert max(seen) <= 2 and model.stages[-1].getNumTrees == 5
    assert all(r["predicted"] == r["y"] for r in learning.score(model, rows).collect())


def test_wrong_labels_and_lengths_are_refused(spark):
    kind = "features array<double>, y double, w double"
    for bad in ([([1.0], 0.5, 1.0)], [([1.0], 0.0, -1.0)], [([1.0], 0.0, 1.0), ([1.0, 2.0], 1.0, 1.0)], [([1.0], None, 1.0)]):
        rows = spark.createDataFrame(bad, kind).toDF("x", "y", "w")
        with pytest.raises(ValueError, match="labels|lengths"):
            forest.settings(estimator(), rows)


@pytest.mark.parametrize("bits", [10, 3])
def test_outcomes_give_the_contributions_of_the_leaves(spark, bits):
    rows = rows_of(spark)
    model = forest.fit(estimator(numTrees=4, featureSubsetStrategy="all"), rows)
    nodes = treeshap.forest_nodes(spark, model)
    matrix = np.array([r[0] for r in rows.select(vector_to_array("features")).limit(200).collect()])
    tests, want, out = {}, np.zeros_like(matrix), np.zeros_like(matrix)
    cut_up = [treeshap.subtrees(n, tests, bits=bits) for n in nodes]
    treeshap.subtree_contributions([tree for found, _ in cut_up for tree in found], list(tests), matrix, out)
    for pack in treeshap.packed([deep for _, deep in cut_up]):
        treeshap.pack_contributions(pack, matrix, out)
    for pack in treeshap.packed([treeshap.tree_leaves(n) for n in nodes]):
        treeshap.pack_contributions(pack, matrix, want)
    assert any(deep for _, deep in cut_up) == (bits == 3)
    assert np.abs(want).max() > 0.1 and np.allclose(out, want, atol=1e-12)


def test_many_rows_are_explained_by_outcomes_and_add_up(spark, monkeypatch):
    monkeypatch.setattr(treeshap, "MANY", 10)
    monkeypatch.setattr(treeshap, "ROWS", 300)
    rows = rows_of(spark)
    model = forest.fit(estimator(numTrees=6, featureSubsetStrategy="sqrt"), rows)
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    explained, base = treeshap.tree_contributions(model, scored, ["id", "score"])
    told = explained.select("id", "score", F.aggregate("contributions", F.lit(base), lambda a, c: a + c).alias("sum")).collect()
    assert sorted(r["id"] for r in told) == list(range(1500))
    assert max(abs(r["score"] - r["sum"]) for r in told) < 1e-9
