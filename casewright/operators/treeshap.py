"""Path-dependent tree SHAP for a Spark forest, computed per Arrow batch on the executors.

Every leaf contributes to the features on its path. With cover ratio z and match o (0/1) per feature,
the share of feature i is ``(o_i - z_i) * value * integral over [0, 1] of prod_{j != i} (z_j (1-t) + o_j t)``.
The integrand is a polynomial, so a few Gauss-Legendre nodes integrate it exactly.

What a row gets depends only on which of the tests of a tree it passes. Many rows are explained by subtrees with at most ``BITS`` tests on the
way to and in them: the amounts are worked out once for every outcome of the tests and looked up by the outcomes of each row.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.session import staging_root


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Leaf(NamedTuple):
    """Features on the path, the interval each must lie in, their cover ratios, and the leaf value."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cover: np.ndarray
    value: float


def forest_nodes(spark: SparkSession, forest) -> list[dict]:
    """Node rows per tree. Their number is bounded by the model size, not by the data."""
    path = f"{staging_root(spark)}/forest-{uuid.uuid4().hex}"
    forest.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, object]] = {}
    for row in rows:
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    return [trees[t] for t in sorted(trees)]


def _cover(node) -> float:
    return float(sum(node["impurityStats"]))


def _interval(split, left: bool) -> tuple[float, float]:
    """Interval of the feature on one side of a split; one-hot columns split at 0.5."""
    values = list(split["leftCategoriesOrThreshold"])
    if split["numCategories"] == -1:
        cut, low_side = values[0], left
    elif split["numCategories"] <= 2:
        cut, low_side = 0.5, left == (0.0 in values)
    else:
        raise ValueError("categorical splits must be one-hot encoded")
    return (-np.inf, cut) if low_side else (cut, np.inf)


def tree_leaves(nodes: dict[int, object], positive: int = 1) -> list[Leaf]:
    leaves = []
    stack: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while stack:
        number, path = stack.pop()
        node = nodes[number]
        if node["leftChild"] < 0:
            features = np.array(sorted(path), dtype=np.int64)
            parts = np.array([path[f] for f in features], dtype=np.float64).reshape(-1, 3)
            share = float(node["impurityStats"][positive]) / _cover(node)
            leaves.append(Leaf(features, parts[:, 0], parts[:, 1], parts[:, 2], share))
            continue
        feature = node["split"]["featureIndex"]
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            low, high = _interval(node["split"], left)
            was_low, was_high, was_cover = path.get(feature, (-np.inf, np.inf, 1.0))
            ratio = _cover(nodes[child]) / _cover(node)
            step = (max(low, was_low), min(high, was_high), was_cover * ratio)
            stack.append((child, {**path, feature: step}))
    return leaves


class Pack(NamedTuple):
    """Leaves with paths of one length: arrays (leaves, length) and the values."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cover: np.ndarray
    value: np.ndarray


#: Numbers in the largest array that a batch works on.
ARRAY = 1 << 21
#: Nodes and weights by their number, for paths of up to 31 features: a Spark tree has at most 30 levels.
GAUSS = {n: np.polynomial.legendre.leggauss(n) for n in range(1, 17)}


def packed(trees: list[list[Leaf]]) -> list[Pack]:
    """The leaves of all trees by the length of their path; a leaf without a path contributes nothing."""
    by_length: dict[int, list[Leaf]] = {}
    for leaf in (leaf for leaves in trees for leaf in leaves):
        by_length.setdefault(len(leaf.features), []).append(leaf)
    stack = lambda leaves, field: np.stack([getattr(leaf, field) for leaf in leaves])
    return [
        Pack(*[stack(leaves, field) for field in ("features", "low", "high", "cover")], np.array([leaf.value for leaf in leaves]))
        for length, leaves in sorted(by_length.items()) if length
    ]


def _contributions(match: np.ndarray, cover: np.ndarray, value: np.ndarray) -> np.ndarray:
    """What each feature of each leaf contributes for each row of matches (rows, leaves, length)."""
    # Along the path first: products over a short last axis are slow.
    o, cover = np.ascontiguousarray(np.moveaxis(match, 2, 0)).astype(np.float64), cover.T[:, None, :]
    nodes, weights = GAUSS[len(o) // 2 + 1]
    share = np.zeros_like(o)
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = cover * (1 - t) + o * t
        share += w * factor.prod(axis=0) / factor
    return np.moveaxis((o - cover) * share * value, 0, 2)


def pack_contributions(pack: Pack, matrix: np.ndarray, out: np.ndarray) -> None:
    """Add the contributions of a pack for all rows, many leaves at a time.

    Rows can match a path in two to the power of its length ways; where there are more rows than that, each way is worked out once.
    """
    length = pack.features.shape[1]
    ways = 1 << length if length < 16 else len(matrix)
    table = len(matrix) > ways
    patterns = (np.arange(ways)[:, None, None] >> np.arange(length)) & 1 if table else None
    at_once = max(1, ARRAY // (length * max(len(matrix), 1)))
    for first in range(0, len(pack.value), at_once):
        features, low, high, cover, value = (part[first : first + at_once] for part in pack)
        x = matrix[:, features]
        match = (x > low) & (x <= high)
        if table:
            known = _contributions(np.broadcast_to(patterns, (ways, *features.shape)), cover, value)
            amounts = known[match @ (1 << np.arange(length)), np.arange(len(value))]
        else:
            amounts = _contributions(match, cover, value)
        order = np.argsort(features, axis=None, kind="stable")
        names, starts = np.unique(features.ravel()[order], return_index=True)
        out[:, names] += np.add.reduceat(amounts.reshape(len(matrix), -1)[:, order], starts, axis=1)


class Part(NamedTuple):
    """Leaves of a subtree with paths of one length: where their features are among the subtree's, which tests of a feature decide and how they must end."""

    places: np.ndarray
    tests: np.ndarray
    ends: np.ndarray
    cover: np.ndarray
    value: np.ndarray


class Subtree(NamedTuple):
    """Numbers of the tests on the way to a subtree and in it, the features of its leaves' paths, and its leaves."""

    tests: list[int]
    features: np.ndarray
    parts: list[Part]


#: Tests of a subtree; rows from which its outcomes are worked out beforehand; rows that are explained at once; rows looked up at once.
BITS, MANY, ROWS, SLICE = 10, 1 << 11, 1 << 16, 1 << 13


def subtrees(nodes: dict[int, object], tests: dict[tuple[int, float], int], positive: int = 1, bits: int = BITS) -> tuple[list[Subtree], list[Leaf]]:
    """A tree as subtrees of at most ``bits`` tests, and its leaves below more tests than that; ``tests`` numbers (feature, cut), passed up to the cut."""
    inner: dict[int, int] = {}
    for number in sorted(nodes, reverse=True):  # children have higher numbers
        node = nodes[number]
        inner[number] = 0 if node["leftChild"] < 0 else 1 + inner[node["leftChild"]] + inner[node["rightChild"]]
    found: list[Subtree] = []
    deep: list[Leaf] = []

    def sides(number: int) -> list[tuple[int, int, int, bool, float, float]]:
        """Child, feature, test, how it must end, the cut and the share of the rows, on both sides."""
        node, out = nodes[number], []
        feature = node["split"]["featureIndex"]
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            low, high = _interval(node["split"], left)
            cut = high if low == -np.inf else low
            test = tests.setdefault((feature, cut), len(tests))
            out.append((child, feature, test, low == -np.inf, cut, _cover(nodes[child]) / _cover(node)))
        return out

    def leaf_of(number: int, path: list[tuple]) -> tuple[dict[int, list], float]:
        """The conditions on each feature of a path, in order of features, and the leaf's value."""
        by_feature: dict[int, list] = {}
        for condition in path:
            by_feature.setdefault(condition[1], []).append(condition)
        return dict(sorted(by_feature.items())), float(nodes[number]["impurityStats"][positive]) / _cover(nodes[number])

    def subtree(number: int, path: list[tuple]) -> Subtree:
        at = {test: i for i, test in enumerate(dict.fromkeys(c[2] for c in path))}
        leaves, stack = [], [(number, path)]
        while stack:
            number, path = stack.pop()
            if nodes[number]["leftChild"] < 0:
                leaves.append(leaf_of(number, path))
                continue
            for condition in sides(number):
                at.setdefault(condition[2], len(at))
                stack.append((condition[0], [*path, condition]))
        features = sorted({f for by_feature, _ in leaves for f in by_feature})
        by_length: dict[int, list[tuple]] = {}
        for by_feature, value in leaves:
            if by_feature:
                mask = [sum(1 << bit for bit in {at[c[2]] for c in cs}) for cs in by_feature.values()]
                ends = [sum(1 << bit for bit in {at[c[2]] for c in cs if c[3]}) for cs in by_feature.values()]
                cover = [float(np.prod([c[5] for c in cs])) for cs in by_feature.values()]
                by_length.setdefault(len(by_feature), []).append(([features.index(f) for f in by_feature], mask, ends, cover, value))
        kinds = (np.int64, np.int32, np.int32, np.float64, np.float64)
        return Subtree(list(at), np.array(features, np.int64), [Part(*map(np.array, zip(*same), kinds)) for same in by_length.values()])

    stack: list[tuple[int, list[tuple]]] = [(0, [])]
    while stack:
        number, path = stack.pop()
        if len(path) + inner[number] <= bits:
            found.append(subtree(number, path))
        elif inner[number]:
            stack += [(condition[0], [*path, condition]) for condition in sides(number)]
        else:
            by_feature, value = leaf_of(number, path)
            low = [max((c[4] for c in cs if not c[3]), default=-np.inf) for cs in by_feature.values()]
            high = [min((c[4] for c in cs if c[3]), default=np.inf) for cs in by_feature.values()]
            deep.append(Leaf(np.array(list(by_feature)), np.array(low), np.array(high), np.array([np.prod([c[5] for c in cs]) for cs in by_feature.values()]), value))
    return [tree for tree in found if tree.parts], deep


def outcome_amounts(tree: Subtree) -> np.ndarray:
    """What each feature of a subtree gets (features, outcomes): bit i of an outcome tells whether test i is passed."""
    outcomes = np.arange(1 << len(tree.tests), dtype=np.int32)
    amounts = np.zeros((len(tree.features), len(outcomes)))
    for places, tests, ends, cover, value in tree.parts:
        length = tests.shape[1]
        ways = ((np.arange(1 << length)[:, None] >> np.arange(length)) & 1)[:, None, :]
        known = _contributions(np.broadcast_to(ways, (1 << length, *tests.shape)), cover, value)
        way = np.zeros((len(value), len(outcomes)), np.int32)
        for i in range(length):
            way |= ((outcomes & tests[:, i : i + 1]) == ends[:, i : i + 1]).astype(np.int32) << np.int32(i)
        for leaf, place in enumerate(places):
            amounts[place] += np.ascontiguousarray(known[:, leaf].T).take(way[leaf], axis=1)
    return amounts


def subtree_contributions(trees: list[Subtree], tests: list[tuple[int, float]], matrix: np.ndarray, out: np.ndarray) -> None:
    """Add the contributions of all subtrees for all rows."""
    passed = [(matrix[:, feature] <= cut).astype(np.uint16) for feature, cut in tests]
    sums = np.zeros((matrix.shape[1], len(matrix)))
    for tree in trees:
        amounts = outcome_amounts(tree)
        for first in range(0, len(matrix), SLICE):
            part = slice(first, first + SLICE)
            outcome = passed[tree.tests[0]][part].copy()
            for bit, test in enumerate(tree.tests[1:], 1):
                outcome |= passed[test][part] << np.uint16(bit)
            outcome = outcome.astype(np.intp)
            for feature, amount in zip(tree.features, amounts):
                sums[feature, part] += amount.take(outcome)
    out += sums.T


def base_value(trees: list[list[Leaf]]) -> float:
    """Expected score when no feature is known."""
    return float(np.mean([sum(leaf.value * leaf.cover.prod() for leaf in t) for t in trees]))


def tree_contributions(
    forest, rows: DataFrame, keep: list[str], name: str = "contributions"
) -> tuple[DataFrame, float]:
    """(kept columns, contributions array) for transformed rows, and the base value.

    Contributions of a row add up to its score minus the base value.
    """
    spark = rows.sparkSession
    nodes = forest_nodes(spark, forest)
    trees, tests = [tree_leaves(n) for n in nodes], {}
    cut_up = [subtrees(n, tests) for n in nodes]
    # Plain tuples, and functions pickled by value: workers need not have this package installed.
    shared, count = spark.sparkContext.broadcast((
        [tuple(pack) for pack in packed(trees)], [tuple(pack) for pack in packed([deep for _, deep in cut_up])],
        [(tree.tests, tree.features, [tuple(part) for part in tree.parts]) for found, _ in cut_up for tree in found], list(tests),
    )), len(trees)

    def contributions(matrix: np.ndarray) -> np.ndarray:
        packs, deep, found, numbered = shared.value
        out = np.zeros_like(matrix)
        if len(matrix) >= MANY:
            subtree_contributions([Subtree(*tree) for tree in found], numbered, matrix, out)
        for pack in deep if len(matrix) >= MANY else packs:
            pack_contributions(Pack(*pack), matrix, out)
        return out / count

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def explained() -> pd.DataFrame:
            batch = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            result = batch[keep].copy()
            result[name] = list(contributions(np.stack(batch["_x"].to_numpy()))) if len(batch) else []
            return result

        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) >= ROWS:
                yield explained()
                held.clear()
        if held:
            yield explained()

    narrow = rows.select(*keep, vector_to_array(F.col("features")).alias("_x"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.select(*keep).schema)
    return narrow.mapInPandas(explain, f"{fields}, {name} array<double>"), base_value(trees)
