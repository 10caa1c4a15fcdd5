"""Exact selection against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from casewright.operators import selection
from casewright.operators.selection import Cut, select_cuts


def by_sorting(rows, fraction):
    """The first value, NaN last, up to which the share of the weight lies."""
    counted = sorted(((v, w) for v, w in rows if v is not None and w is not None and w > 0), key=lambda x: (math.isnan(x[0]), x[0]))
    wanted, upto = fraction * float(sum(w for _, w in counted)), 0
    for v, w in counted:
        upto += w
        if upto >= wanted:
            return v
    return None


@pytest.mark.parametrize("finish,buckets", [(1 << 18, 1 << 14), (20, 16)])
def test_cuts_of_many_columns_equal_sorting(spark, monkeypatch, finish, buckets):
    monkeypatch.setattr(selection, "FINISH", finish)
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        rows.append((
            rng.choice([None, rng.gauss(0, 1), rng.lognormvariate(0, 9), 1e-300, -1e300, 1e308, 7.0]), rng.randrange(9), rng.choice([None, 2**62 + rng.randrange(50), -5]),
            rng.choice([None, 0, 1, 3, 11]), rng.choice([float("-inf"), float("inf"), float("nan"), 0.5, 2.5]),
        ))
    df = spark.createDataFrame(rows, "x double, few int, big bigint, w int, odd double").repartition(5)
    cuts = {f"{c}{weight}{q}": Cut(c, q, weight) for c in ("x", "few", "big", "odd") for weight in (None, "w") for q in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)}
    got = select_cuts(df, cuts)
    names = ["x", "few", "big", "w", "odd"]
    for name, cut in cuts.items():
        want = by_sorting([(r[names.index(cut.value)], 1 if cut.weight is None else r[3]) for r in rows], cut.fraction)
        assert got[name] == want or math.isnan(got[name]) and math.isnan(want), name


def test_steps_that_do_not_part_values_end_in_a_sort(spark, monkeypatch):
    monkeypatch.setattr(selection, "FINISH", 3)
    monkeypatch.setattr(selection, "BUCKETS", 2)
    monkeypatch.setattr(selection, "ROUNDS", 2)
    rows = [(float(10.0 ** (i - 150)),) for i in range(300)]
    df = spark.createDataFrame(rows, "x double")
    got = select_cuts(df, {q: Cut("x", q) for q in (0.1, 0.5, 0.99)}, reread=True)
    assert got == {q: by_sorting([(v, 1) for (v,) in rows], q) for q in (0.1, 0.5, 0.99)}


def test_cuts_without_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 0)], "x double, w int")
    assert select_cuts(df, {"a": Cut("x", 0.5), "b": Cut("w", 0.5, "w")}) == {"a": None, "b": 1}
    assert select_cuts(df.limit(0), {"a": Cut("x", 0.5)}) == {"a": None}
    assert select_cuts(df, {}) == {}


def test_a_pass_counts_each_value_once_and_reads_few_columns(spark, monkeypatch):
    """Five cuts of nine columns: a row is not repeated for each cut, and no pass holds all columns."""
    monkeypatch.setattr(selection, "FINISH", 20)
    monkeypatch.setattr(selection, "BUCKETS", 64)
    names = [f"c{i}" for i in range(9)]
    df = spark.range(400).select(*[((F.col("id") * (2 * i + 7)) % 401).cast("double").alias(c) for i, c in enumerate(names)])
    passes = []
    between = selection._between

    def seen(rows, *args):
        out = between(rows, *args)
        passes.append(out.count())
        return out

    monkeypatch.setattr(selection, "_between", seen)
    fractions = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = select_cuts(df, {f"{c} {q}": Cut(c, q) for c in names for q in fractions})
    for c in names:
        values = sorted(r[0] for r in df.select(c).collect())
        assert [got[f"{c} {q}"] for q in fractions] == [values[math.ceil(q * len(values)) - 1] for q in fractions]
    assert passes and max(passes) <= 400 * 4
