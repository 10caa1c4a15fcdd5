"""Best catalogue rows under two thresholds, found through a staircase index instead of comparing everything.

A row fits an entity if its risk threshold and its level are at most the entity's. Only rows that fewer than ``k`` better rows
with thresholds as low stand before can ever be among the k best. For each level the k best change at a few risk thresholds; these steps, in
the order (level, risk), are the index. An entity finds its step by binary search in a bounded array of every m-th step
and joins the stretch of steps that begins there, an equality join.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.expressions import ColumnLike
from casewright.operators.ordering import with_global_rank
from casewright.session import staged

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Starts of cells in the array that is searched in each row; bits of a position in it or among the levels.
SEARCHED, BITS = 1 << 16, 24


class Staircase(NamedTuple):
    """The stored index: stretches (cell, steps), and the arrays that find a cell."""

    cells: DataFrame  # cell bigint, steps array<struct<level, risk, best array<struct>>>
    finder: DataFrame  # one row: starts array<struct<level, risk>>, levels array<double>
    fields: tuple[str, ...]


def _kept(k: int):
    """Rows, best first, that fewer than k better ones with thresholds as low stand before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        risk, level = np.zeros(0), np.zeros(0)
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            new_risk, new_level = [], []
            for i, (r, s) in enumerate(zip(batch["risk"].to_numpy(), batch["level"].to_numpy())):
                before = int(((risk <= r) & (level <= s)).sum()) + sum(a <= r and b <= s for a, b in zip(new_risk, new_level))
                if before < k:
                    keep[i] = True
                    new_risk.append(r)
                    new_level.append(s)
                    if len(new_risk) >= 64:
                        risk, level, new_risk, new_level = np.append(risk, new_risk), np.append(level, new_level), [], []
            risk, level = np.append(risk, new_risk), np.append(level, new_level)
            yield batch[keep]

    return run


def _steps(k: int):
    """(cell, level, risk, best): of all that may be chosen, best first, the steps of every level, dealt to cells in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in _kept(k)(batches) if len(b)]
        if not parts:
            return
        rows = pd.concat(parts).sort_values(["risk", "place"])
        out = []
        for level in np.unique(rows["level"]):
            mine = rows[rows["level"] <= level]
            best: list[int] = []
            for risk, places in mine.groupby("risk", sort=True)["place"]:
                now = sorted(best + places.tolist())[:k]
                if now != best:
                    best = now
                    out.append((level, risk, best))
        width = -(-len(out) // SEARCHED)
        yield pd.DataFrame([(i // width, *step) for i, step in enumerate(out)], columns=["cell", "level", "risk", "best"])

    return run


def staircase(catalog: DataFrame, risk: str, level: str, order: Sequence[ColumnLike], fields: Sequence[str], k: int) -> Staircase:
    """The index of the ``k`` best rows by ``order`` for any pair of limits; ``fields`` are what is returned of a row.

    Rows without a threshold or a level fit nobody. Rows that can never be chosen are dropped on many executors first, each task keeping only what
    may still be chosen; what is left, some k times the squared logarithm of the catalogue if the columns are unrelated, is worked on once more
    as a whole. Rows equal in ``order`` stand in the order of ``fields``.
    """
    limits = {"_risk": F.col(risk).cast("double"), "_level": F.col(level).cast("double")}
    usable = catalog.withColumns(limits).where("_risk IS NOT NULL AND _level IS NOT NULL AND NOT isnan(_risk) AND NOT isnan(_level)")
    placed = with_global_rank(usable, [*order, *fields, "_risk", "_level"], "_place").select("_risk", "_level", "_place", *fields)
    narrow = placed.select(F.col("_risk").alias("risk"), F.col("_level").alias("level"), F.col("_place").alias("place"))
    # Every task keeps what may be chosen of its rows; the rest is few rows, and one task makes the steps of them.
    spread = narrow.repartition("place").sortWithinPartitions("place").mapInPandas(_kept(k), narrow.schema)
    merged = spread.repartition(1).sortWithinPartitions("place")
    steps = staged(merged.mapInPandas(_steps(k), "cell bigint, level double, risk double, best array<bigint>"))
    chosen = steps.select("cell", "level", "risk", F.posexplode("best").alias("nth", "_place")).join(placed, "_place")
    told = chosen.groupBy("cell", "level", "risk").agg(F.sort_array(F.collect_list(F.struct("nth", F.struct(*fields).alias("row")))).alias("b"))
    step = F.struct("level", "risk", F.transform("b", lambda x: x["row"]).alias("best"))
    # A step is told apart from the others of its cell by level and risk alone, so rows need no order of their own.
    cells = staged(told.groupBy("cell").agg(F.collect_list(step).alias("s")).select("cell", F.array_sort("s", _by_place).alias("steps")))
    firsts = steps.groupBy("cell").agg(F.min(F.struct("level", "risk")).alias("at"))
    levels = steps.select("level").distinct().agg(F.sort_array(F.collect_list("level")).alias("levels"))
    finder = firsts.agg(F.sort_array(F.collect_list("at")).alias("starts")).withColumn("levels", levels.scalar())
    return Staircase(cells, finder, tuple(fields))


def _by_place(a: Column, b: Column) -> Column:
    one, two = F.struct(a["level"], a["risk"]), F.struct(b["level"], b["risk"])
    return F.when(one < two, -1).when(one > two, 1).otherwise(0)


def found_upto(values: Column, fits: Callable[[Column], Column]) -> Column:
    """How many leading elements of a sorted array fit, by binary search."""
    jumps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    size = F.size(values)
    return F.aggregate(jumps, F.lit(0), lambda at, jump: F.when((at + jump <= size) & fits(F.get(values, at + jump - 1)), at + jump).otherwise(at))


def best_fitting(entities: DataFrame, index: Staircase, risk: Column, level: Column, name: str = "best") -> DataFrame:
    """``entities`` with an array of the rows that fit, best first; empty if none fits or a limit is NULL."""
    levels, starts = index.finder.select("levels").scalar(), index.finder.select("starts").scalar()
    limits = entities.withColumns({"_cw_risk": risk.cast("double"), "_cw_levels": levels, "_cw_starts": starts, "_cw_level": level.cast("double")})
    known = found_upto(F.col("_cw_levels"), lambda v: v <= F.col("_cw_level"))
    limits = limits.withColumn("_cw_level", F.get(F.col("_cw_levels"), known - 1))
    at = F.struct(F.col("_cw_level").alias("level"), F.col("_cw_risk").alias("risk"))
    usable = F.col("_cw_level").isNotNull() & F.col("_cw_risk").isNotNull()
    cell = found_upto(F.col("_cw_starts"), lambda s: s <= at) - 1
    limits = limits.withColumn("_cw_cell", F.when(usable, cell.cast("bigint"))).drop("_cw_levels", "_cw_starts")
    joined = limits.join(index.cells.withColumnsRenamed({"cell": "_cw_of", "steps": "_cw_steps"}), F.col("_cw_cell") == F.col("_cw_of"), "left")
    reached = F.element_at(F.filter("_cw_steps", lambda s: F.struct(s["level"], s["risk"]) <= at), -1)
    own = F.when(reached["level"] == F.col("_cw_level"), reached["best"])
    none = F.array().cast(index.cells.schema["steps"].dataType.elementType["best"].dataType)
    extra = ["_cw_risk", "_cw_level", "_cw_cell", "_cw_of", "_cw_steps"]
    return joined.withColumn(name, F.coalesce(own, none)).drop(*extra)


def flat_steps(index: Staircase) -> DataFrame:
    """(cell, level, low, high, nth, *fields): each step of the index with its range of risk, a row for each of its best."""
    steps = index.cells.select("cell", F.posexplode("steps").alias("at", "s")).select("cell", "at", "s.*")
    following = Window.partitionBy("level").orderBy("risk")
    ranged = steps.withColumn("high", F.coalesce(F.lead("risk").over(following), F.lit(float("inf"))))
    return staged(ranged.select("cell", "level", F.col("risk").alias("low"), "high", F.posexplode("best").alias("nth", "b")).select("cell", "level", "low", "high", "nth", "b.*"))
