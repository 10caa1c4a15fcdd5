"""Random forests for many rows: ``pyspark.ml``'s method and model, grown level by level from counts in NumPy.

Spark's estimator visits the rows one by one and, for each of them, a node in every tree, so that nearly every count it adds to lies outside
the processor's caches. Here rows are stored once as blocks of bin numbers, and a task takes the trees one by one over the blocks it has: what
it adds to is one level of one tree. Counts are summed by tree on the executors; the driver gets the splits, whose number is the model's size.

As in Spark: Poisson draws of rows for each tree, weighted Gini gain over the cuts between at most ``maxBins`` bins, new features for each
node, limits on rows, weight and gain, and sibling leaves of one class merged. Other than in Spark, cuts are quantiles of all rows, not of some
10,000, and draws come from NumPy by seed, tree and block.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.session import staged, staging_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points that describe a column of some rows; rows that are described at once; rows of a block; bytes of bin numbers a task holds.
POINTS, CHUNK, BLOCK, TASK_BYTES = 1024, 1 << 17, 1 << 14, 1 << 26
#: As in Spark: an impurity below this is none.
EPSILON = 2.220446049250313e-16


class Settings(NamedTuple):
    """What the estimator was asked for, and what its rows have."""

    rows: int
    trees: int
    depth: int
    bins: int
    min_rows: int
    min_weight: float
    min_gain: float
    rate: float
    bootstrap: bool
    seed: int
    features: int
    classes: int
    chosen: int
    #: Weight of each class where rows of a class all weigh the same, else None.
    weights: tuple[float, ...] | None


# --- rows as blocks of bin numbers ------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column; all lists have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def column_points(values: np.ndarray, weights: np.ndarray, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Ascending values and the weight up to each: every distinct one, or ``points`` of them a like weight apart."""
    low, high = values.min(), values.max()
    if low == high:
        return np.array([low]), np.array([weights.sum()])
    at_high = values == high
    if (at_high | (values == low)).all():
        return np.array([low, high]), np.array([weights[~at_high].sum(), weights[at_high].sum()])
    order = np.argsort(values)
    ranked, upto = values[order], np.cumsum(weights[order])
    last = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True))
    ranked, upto = ranked[last], upto[last]
    if len(ranked) > points:
        kept = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, points + 1) / points).clip(max=len(upto) - 1))
        ranked, upto = ranked[kept], upto[kept]
    return ranked, np.diff(upto, prepend=0.0)


def cuts_of(values: np.ndarray, weights: np.ndarray, most: int) -> list[float]:
    """Cuts midway between ascending values: all, or ``most`` that leave like weights between them, as Spark chooses them."""
    if len(values) - 1 <= most:
        return ((values[1:] + values[:-1]) / 2).tolist()
    stride, upto, cuts = weights.sum() / (most + 1), np.cumsum(weights).tolist(), []
    target = stride
    for before, now, low, high in zip(upto, upto[1:], values.tolist(), values[1:].tolist()):
        if abs(before - target) < abs(now - target):
            cuts.append((low + high) / 2)
            target += stride
    return cuts[:most]


def find_cuts(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Cuts of each feature, from all rows; ``rows`` has the columns x (array), y and w."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def described() -> pa.RecordBatch:
            x, w = (np.concatenate(parts) for parts in zip(*held))
            found = [column_points(np.ascontiguousarray(x[:, f]), w) for f in range(features)]
            return pa.RecordBatch.from_arrays(
                [pa.array(range(features), pa.int32()), pa.array([v.tobytes() for v, _ in found], pa.binary()), pa.array([n.tobytes() for _, n in found], pa.binary())],
                names=["feature", "points", "held"],
            )

        for batch in batches:
            if batch.num_rows:
                held.append((_matrix(batch.column("x")), batch.column("w").to_numpy(zero_copy_only=False)))
            if sum(len(w) for _, w in held) >= CHUNK:
                yield described()
                held.clear()
        if held:
            yield described()

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        values, weights = (np.concatenate([np.frombuffer(b.as_py()) for b in table[c]]) for c in ("points", "held"))
        ranked, inverse = np.unique(values, return_inverse=True)
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "cuts": pa.array([cuts_of(ranked, np.bincount(inverse, weights=weights), bins - 1)], pa.list_(pa.float64()))})

    described = rows.mapInArrow(describe, "feature int, points binary, held binary")
    found = described.groupBy("feature").applyInArrow(cut, "feature int, cuts array<double>").collect()
    return [np.array(r["cuts"], dtype=np.float64) for r in sorted(found, key=lambda r: r["feature"])]


def code_type(how: Settings) -> type:
    """The type of bin numbers times classes plus class."""
    return np.uint8 if how.bins * how.classes <= 256 else np.uint16


def binned(rows: DataFrame, cuts: list[np.ndarray], how: Settings) -> DataFrame:
    """Blocks of rows: codes (bin numbers times classes plus class) row by row, and weights. The number of a block is that of its task and its place there."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, w = _matrix(batch.column("x")), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            for first in range(0, batch.num_rows, BLOCK):
                part = slice(first, first + BLOCK)
                codes = np.empty(x[part].shape, code_type(how))
                for f, c in enumerate(cuts):
                    codes[:, f] = np.searchsorted(c, x[part, f]) * how.classes + y[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([codes.tobytes()], pa.binary()), pa.array([w[part].astype(np.float64).tobytes()], pa.binary())],
                    names=["block", "codes", "weights"],
                )
                number += 1

    return rows.mapInArrow(blocks, "block bigint, codes binary, weights binary")


# --- counting a level ---------------------------------------------------------------------------


def poisson_steps(rate: float) -> list[int]:
    """Where a 32-bit number begins to stand for 1, 2, ... draws."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while (step := round((total := total + term) * 2**32)) < 2**32:
        steps.append(step)
        k += 1
        term *= rate / k
        if term < 2**-40 and k > rate:
            break
    return steps


def drawn(how: Settings, steps: list[int], tree: int, block: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a block that a tree draws and how often; the same whenever it is asked."""
    if not how.bootstrap and how.rate >= 1:
        return np.arange(rows), np.ones(rows)
    u = np.random.SFC64([how.seed % 2**64, tree, block]).random_raw((rows + 1) // 2).view(np.uint32)[:rows]
    if not how.bootstrap:
        held = np.flatnonzero(u < how.rate * 2**32)
        return held, np.ones(len(held))
    held = np.flatnonzero(u >= steps[0])
    u, times, again = u[held], np.ones(len(held)), slice(None)
    for step in steps[1:]:
        if not len(more := np.flatnonzero(u >= step)):
            break
        u, again = u[more], more if isinstance(again, slice) else again[more]
        times[again] += 1
    return held, times


class Level(NamedTuple):
    """The forest above a level and the nodes to split on it; nodes are numbered 1, then 2n and 2n + 1 below n."""

    level: int
    feature: np.ndarray  # (trees, nodes) the feature that a node splits
    cut: np.ndarray  # (trees, nodes) the last bin that goes left
    place: np.ndarray  # (trees, nodes of the level) place among the tree's open nodes, or -1
    chosen: list[np.ndarray]  # a tree: (open nodes, features) that may be split


def counted(blocks: list[tuple], level: Level, how: Settings, tree: int, steps: list[int]) -> np.ndarray:
    """For each open node, chosen feature, bin and class of a tree: draws; where weights vary within a class, draws times weight too, first.

    A block is its number, codes (bin numbers times classes plus class) row by row, and weights.
    """
    chosen = np.ascontiguousarray(level.chosen[tree].T.astype(np.int64))
    width, cells = how.bins * how.classes, chosen.shape[1] * how.bins * how.classes
    kinds = 1 if how.weights is not None else 2
    # Few cells are added to in turns of several copies: adding to a number at once again waits for the sum before.
    copies = max(1, 8 >> level.level)
    out = np.zeros((kinds, len(chosen), copies * cells))
    feature, place = level.feature[tree].astype(np.int64), level.place[tree]
    for number, codes, weights in blocks:
        cut = np.minimum(level.cut[tree].astype(np.int64) * how.classes + how.classes - 1, np.iinfo(codes.dtype).max).astype(codes.dtype)
        rows, times = drawn(how, steps, tree, number, len(weights))
        at, node = rows * how.features, np.ones(len(rows), np.int64)
        for depth in range(level.level):
            right = codes.take(at + (feature.take(node) if depth else feature[1]), mode="clip") > cut.take(node)
            node += node
            node += right
        if level.level:
            at_place = place.take(node - (1 << level.level))
            if (at_place < 0).any():
                held = np.flatnonzero(at_place >= 0)
                rows, times, at, at_place = rows[held], times[held], at[held], at_place[held]
            cell = at_place * width
        else:
            cell = np.zeros(len(rows), np.int64)
        if copies > 1:
            cell += (np.arange(len(rows)) & (copies - 1)) * cells
        amounts = [times] if kinds == 1 else [times * weights.take(rows), times]
        for j, names in enumerate(chosen):
            index = cell + codes.take(at + (names.take(at_place) if level.level else names[0]), mode="clip")
            for kind, amount in enumerate(amounts):
                out[kind, j] += np.bincount(index, weights=amount, minlength=copies * cells)
    return out.reshape(kinds, len(chosen), copies, cells).sum(axis=2)


def best_splits(counts: np.ndarray, chosen: np.ndarray, cuts: list[int], how: Settings) -> dict[str, np.ndarray]:
    """The best split of each node from its counts (kinds, features, nodes, bins, classes); gain 0 where there is none."""
    upto = np.cumsum(counts, axis=3).transpose(0, 2, 1, 3, 4)
    left, left_rows = upto[-1] * np.array(how.weights) if how.weights is not None else upto[0], upto[-1].sum(axis=3)
    whole, rows = left[:, :1, -1:, :], left_rows[:, :1, -1:]
    right, right_rows = np.maximum(whole - left, 0.0), rows - left_rows

    def gini(stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = stats.sum(axis=-1)
        share = stats / np.where(total > 0, total, 1)[..., None]
        return np.where(total > 0, 1 - (share * share).sum(axis=-1), 0.0), total

    (impurity, total), (left_impurity, left_total), (right_impurity, right_total) = gini(whole), gini(left), gini(right)
    safe = np.where(total > 0, total, 1)
    gain = impurity - left_total / safe * left_impurity - right_total / safe * right_impurity
    allowed = np.arange(how.bins) < np.array(cuts)[chosen][:, :, None]
    allowed &= (left_rows >= how.min_rows) & (right_rows >= how.min_rows)
    allowed &= (left_total >= how.min_weight) & (right_total >= how.min_weight) & (gain >= how.min_gain)
    gain = np.where(allowed, gain, -np.inf).reshape(len(chosen), -1)
    best = gain.argmax(axis=1)
    nodes, which, at = np.arange(len(chosen)), best // how.bins, best % how.bins
    return {
        "gain": np.maximum(gain[nodes, best], 0.0), "feature": chosen[nodes, which], "bin": at,
        "stats": whole[:, 0, 0], "left": left[nodes, which, at], "right": right[nodes, which, at],
        "rows": rows[:, 0, 0], "left_rows": left_rows[nodes, which, at], "impurity": impurity[:, 0, 0],
        "left_impurity": left_impurity[nodes, which, at], "right_impurity": right_impurity[nodes, which, at],
    }


RESULT = ("gain", "feature", "bin", "rows", "left_rows", "impurity", "left_impurity", "right_impurity", "stats", "left", "right")


def split_level(blocks: DataFrame, level: Level, how: Settings, cuts: list[int], partitions: int) -> list[tuple[int, dict[str, np.ndarray]]]:
    """Counts of all blocks, summed by tree, and the best splits: (tree, what ``best_splits`` found)."""
    spark, steps = blocks.sparkSession, poisson_steps(how.rate)
    shared = spark.sparkContext.broadcast(tuple(level))
    stored = np.uint32 if how.weights is not None else np.float64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, kind = [], Level(*shared.value), code_type(how)
        for batch in batches:
            for number, *parts in zip(batch.column("block").to_pylist(), batch.column("codes"), batch.column("weights")):
                held.append((number, *(np.frombuffer(p.as_buffer(), t) for p, t in zip(parts, (kind, np.float64)))))
        for tree in range(how.trees if held else 0):
            if len(now.chosen[tree]):
                sums = counted(held, now, how, tree, steps).astype(stored)
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["tree", "counts"])

    def split(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, total = key[0].as_py(), 0.0
        for batch in batches:
            for part in batch.column("counts"):
                total = total + np.frombuffer(part.as_buffer(), stored)
        chosen = Level(*shared.value).chosen[tree].astype(np.int64)
        shape = (-1, how.chosen, len(chosen), how.bins, how.classes)
        found = best_splits(total.reshape(shape), chosen, cuts, how)
        yield pa.RecordBatch.from_arrays(
            [pa.array([tree], pa.int32()), *(pa.array([found[c].astype(np.float64).tobytes()], pa.binary()) for c in RESULT)], names=["tree", *RESULT]
        )

    sums = blocks.mapInArrow(count, "tree int, counts binary").repartition(partitions, "tree")
    found = sums.groupBy("tree").applyInArrow(split, "tree int, " + ", ".join(f"{c} binary" for c in RESULT)).collect()
    shared.unpersist()
    wide = lambda c, a: a.reshape(-1, how.classes) if c in ("stats", "left", "right") else a
    return [(r["tree"], {c: wide(c, np.frombuffer(bytes(r[c]))) for c in RESULT}) for r in sorted(found, key=lambda r: r["tree"])]


# --- the forest -----------------------------------------------------------------------------------


class Node:
    """A node as it grows: class weights, and the split once there is one."""

    __slots__ = ("gain", "impurity", "left", "right", "rows", "split", "stats")

    def __init__(self, stats: np.ndarray, rows: float, impurity: float) -> None:
        self.stats, self.rows, self.impurity = stats, rows, impurity
        self.gain, self.split, self.left, self.right = -1.0, None, None, None

    @property
    def prediction(self) -> int:
        return int(self.stats.argmax())


def merged(node: Node) -> Node:
    """Sibling leaves that predict one class make their parent a leaf, from the bottom up."""
    if node.split is not None:
        left, right = merged(node.left), merged(node.right)
        if left.split is None and right.split is None and left.prediction == right.prediction:
            node.split, node.left, node.right, node.gain = None, None, None, -1.0
    return node


def node_rows(root: Node, tree: int, cuts: list[np.ndarray]) -> list[tuple]:
    """Rows of the stored model, numbered from the root on, left before right."""
    out: list[list] = []

    def add(node: Node) -> int:
        number = len(out)
        out.append([])
        left, right = (add(node.left), add(node.right)) if node.split is not None else (-1, -1)
        split = (node.split[0], [float(cuts[node.split[0]][node.split[1]])], -1) if node.split is not None else (-1, [], -1)
        out[number] = (number, float(node.prediction), float(node.impurity), [float(v) for v in node.stats], int(node.rows), float(node.gain), left, right, split)
        return number

    add(root)
    return [(tree, row) for row in out]


def chosen_features(rng: np.random.Generator, nodes: int, how: Settings) -> np.ndarray:
    """For each node as many features as may be split, without repetition, in ascending order."""
    if how.chosen == how.features:
        return np.tile(np.arange(how.features, dtype=np.int16), (nodes, 1))
    return np.sort(rng.random((nodes, how.features)).argpartition(how.chosen - 1, axis=1)[:, : how.chosen], axis=1).astype(np.int16)


def grow(blocks: DataFrame, cuts: list[np.ndarray], how: Settings, partitions: int) -> list[Node]:
    """The roots of all trees."""
    size = 1 << (how.depth + 1)
    feature, cut = np.zeros((how.trees, size), np.int16), np.full((how.trees, size), 255, np.uint8)
    known: list[dict[int, Node]] = [{} for _ in range(how.trees)]
    opened: list[list[int]] = [[1] for _ in range(how.trees)]
    rng = np.random.default_rng(how.seed % 2**64)
    sizes = [len(c) for c in cuts]
    for depth in range(max(how.depth, 1)):
        place = np.full((how.trees, 1 << depth), -1, np.int64)
        for tree, numbers in enumerate(opened):
            place[tree, np.array(numbers, np.int64) - (1 << depth)] = np.arange(len(numbers))
        chosen = [chosen_features(rng, len(numbers), how) for numbers in opened]
        level = Level(depth, feature, cut, place, chosen)
        following: list[list[int]] = [[] for _ in range(how.trees)]
        for tree, found in split_level(blocks, level, how, sizes, partitions):
            nodes = known[tree]
            for i, number in enumerate(opened[tree]):
                node = nodes.setdefault(number, Node(found["stats"][i], found["rows"][i], found["impurity"][i]))
                if found["gain"][i] <= 0 or depth >= how.depth:
                    continue
                node.gain, node.split = found["gain"][i], (int(found["feature"][i]), int(found["bin"][i]))
                feature[tree, number], cut[tree, number] = node.split
                rows = found["left_rows"][i]
                for side, child, n in (("left", 2 * number, rows), ("right", 2 * number + 1, found["rows"][i] - rows)):
                    impurity = found[f"{side}_impurity"][i]
                    nodes[child] = Node(found[side][i], n, impurity)
                    setattr(node, side, nodes[child])
                    if depth + 1 < how.depth and abs(impurity) >= EPSILON:
                        following[tree].append(child)
        opened = following
        if not any(opened):
            break
    # A tree that drew no row at all is one leaf without weight.
    return [merged(nodes.get(1) or Node(np.zeros(how.classes), 0, 0.0)) for nodes in known]


def stored_model(estimator: RandomForestClassifier, vectors: DataFrame, roots: list[Node], cuts: list[np.ndarray], how: Settings) -> RandomForestClassificationModel:
    """The trees as Spark's model, in the form in which it is saved: all but the nodes is written by Spark, for a forest of as many trees on a row a class."""
    spark = vectors.sparkSession
    names = [estimator.getOrDefault(p) for p in ("featuresCol", "labelCol", "weightCol")]
    small = spark.createDataFrame([(Vectors.sparse(how.features, []), float(c), 1.0) for c in range(how.classes)], names).coalesce(1)
    first, path = (f"{staging_root(spark)}/forest-{uuid.uuid4().hex}" for _ in range(2))
    estimator.fit(small).write().save(first)
    spark.read.text(f"{first}/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.read.parquet(f"{first}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    rows = [row for tree, root in enumerate(roots) for row in node_rows(root, tree, cuts)]
    spark.createDataFrame(rows, spark.read.parquet(f"{first}/data").schema, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def settings(estimator: RandomForestClassifier, rows: DataFrame) -> Settings:
    """What is asked for, and what the rows (x, y, w) have: their length, classes and weights; raises for what cannot be a class or a weight."""
    per_class = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("low"), F.max("w").alias("high"), F.sum("w").alias("sum"), F.min(F.size("x")).alias("size"), F.max(F.size("x")).alias("most")).collect()
    if any(r["y"] is None or r["y"] < 0 or r["y"] != int(r["y"]) or r["y"] > 99 or r["low"] is None or not 0 <= r["low"] <= r["high"] < math.inf for r in per_class):
        raise ValueError("labels must be 0, 1, ... below 100 and weights must not be negative")
    if len(sizes := {v for r in per_class for v in (r["size"], r["most"])}) != 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    features, classes = sizes.pop(), max(2, int(max(r["y"] for r in per_class)) + 1)
    get = lambda name: estimator.getOrDefault(name)
    if get("impurity") != "gini" or not 2 <= get("maxBins") <= 256:
        raise ValueError("the impurity must be gini, with 2 to 256 bins")
    chosen = {"all": features, "auto": math.ceil(math.sqrt(features)), "sqrt": math.ceil(math.sqrt(features))}[get("featureSubsetStrategy")]
    one = {int(r["y"]): r["low"] for r in per_class} if all(r["low"] == r["high"] for r in per_class) else None
    n = sum(r["n"] for r in per_class)
    return Settings(
        n, get("numTrees"), get("maxDepth"), min(get("maxBins"), n), get("minInstancesPerNode"),
        get("minWeightFractionPerNode") * sum(r["sum"] for r in per_class), get("minInfoGain"), get("subsamplingRate"), get("bootstrap"), get("seed"),
        features, classes, chosen, None if one is None else tuple(float(one.get(c, 1.0)) for c in range(classes)),
    )


def fit(estimator: RandomForestClassifier, vectors: DataFrame) -> RandomForestClassificationModel:
    """The estimator's forest on ``vectors``, a stored table with its columns of features, label and weight."""
    x, y, w = (estimator.getOrDefault(p) for p in ("featuresCol", "labelCol", "weightCol"))
    rows = vectors.select(vector_to_array(F.col(x)).alias("x"), F.col(y).cast("double").alias("y"), F.col(w).cast("double").alias("w"))
    how = settings(estimator, rows)
    cuts = find_cuts(rows, how.features, how.bins)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = staged(binned(rows, cuts, how).repartition(cores * math.ceil(how.rows * how.features / (TASK_BYTES * cores))))
    roots = grow(blocks, cuts, how, cores)
    return stored_model(estimator, vectors, roots, cuts, how)
