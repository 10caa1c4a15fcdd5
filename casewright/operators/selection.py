"""Exact quantiles of many columns at once, selected where the rows are.

The wanted value of a cut lies between two bounds. Each round counts the rows between them in ``BUCKETS`` equal steps (added up
before anything is shuffled, so a task sends one row a bucket) and keeps the step in which the running weight passes the
wanted share; its smallest and largest value are the next bounds. All cuts of a column share a round, and cuts with the same bounds
are counted once; a pass reads a few columns. Once few rows are left, or one value, their distinct values are added up in order. No column is sorted and nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import staged

BUCKETS = 1 << 14
#: Columns that one pass works on; only they are read in it.
WIDTH = 4
#: Rows between two bounds that are added up by value in one window.
FINISH = 1 << 18
#: Rounds before rows that steps of equal width do not part are put in order on many executors.
ROUNDS = 8


class Cut(NamedTuple):
    """The smallest ``value`` up to which at least ``fraction`` of the weight of all rows with a value lies."""

    value: str
    fraction: float
    weight: str | None = None


class _Bounds(NamedTuple):
    low: object
    high: object
    wanted: float  # weight up to and with the value that is looked for
    below: float  # weight below ``low``
    rows: int


def _weight(cut: Cut) -> Column:
    return F.lit(1).cast("bigint") if cut.weight is None else F.col(cut.weight)


def _counts(cut: Cut) -> Column:
    return F.col(cut.value).isNotNull() & F.coalesce(_weight(cut) > 0, F.lit(False))


def _floating(df: DataFrame, cut: Cut) -> bool:
    return df.schema[cut.value].dataType.simpleString() in ("double", "float")


def _inside(df: DataFrame, cut: Cut) -> Column:
    """Rows that count and have a number between the infinities."""
    v = F.col(cut.value)
    return _counts(cut) & (~F.isnan(v) & (F.abs(v) < float("inf")) if _floating(df, cut) else F.lit(True))


def _chunks(items: Sequence) -> list[Sequence]:
    """``WIDTH`` columns at a time: the code that Spark generates for more of them is too long to be compiled by the JVM."""
    return [items[i : i + WIDTH] for i in range(0, len(items), WIDTH)]


def _first_bounds(df: DataFrame, cuts: Mapping[str, Cut]) -> tuple[dict[str, _Bounds], dict[str, object]]:
    """Bounds of each cut from one aggregation a chunk; cuts without rows, or at an infinity or NaN, have their value already."""
    first: dict[tuple[str, str | None], list] = {}
    for chunk in _chunks(list({(c.value, c.weight): c for c in cuts.values()}.values())):
        columns = []
        for cut in chunk:
            v, w, inside = F.col(cut.value), _weight(cut), _inside(df, cut)
            special = [F.lit(float("-inf")), F.lit(float("inf"))] if _floating(df, cut) else []
            columns += [F.sum(F.when(_counts(cut), w)), F.sum(F.when(inside, w)), F.count_if(inside), F.min(F.when(inside, v)), F.max(F.when(inside, v))]
            columns += [F.sum(F.when(_counts(cut) & (v == s), w)) for s in special] or [F.lit(0), F.lit(0)]
        row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        first |= {(cut.value, cut.weight): row[7 * i : 7 * i + 7] for i, cut in enumerate(chunk)}
    bounds, known = {}, {}
    for name, cut in cuts.items():
        total, finite, rows, low, high, least, most = (x or 0 if k not in (3, 4) else x for k, x in enumerate(first[cut.value, cut.weight]))
        wanted = cut.fraction * float(total)
        if not total:
            known[name] = None
        elif least and wanted <= least:
            known[name] = float("-inf")
        elif not rows or wanted > float(least) + float(finite) and (most or total > least + finite):
            known[name] = float("inf") if most and wanted <= float(least) + float(finite) + float(most) else float("nan")
        elif low == high:
            known[name] = low
        else:
            bounds[name] = _Bounds(low, high, wanted, float(least), rows)
    return bounds, known


class _Range(NamedTuple):
    """What one pass counts once: the values of a column between two bounds, for all cuts that have them."""

    value: str
    weight: str | None
    low: object
    high: object


def _ranges(cuts: Mapping[str, Cut], bounds: Mapping[str, _Bounds]) -> dict[str, _Range]:
    return {name: _Range(cuts[name].value, cuts[name].weight, b.low, b.high) for name, b in bounds.items()}


def _between(df: DataFrame, ranges: Mapping[_Range, int], step: bool) -> DataFrame:
    """(range, step, v, w): the rows of each range. Ranges of a column are equal or disjoint, so a row is in one of them at most."""
    columns: dict[tuple[str, str | None], list[_Range]] = {}
    for r in ranges:
        columns.setdefault((r.value, r.weight), []).append(r)
    entries, wanted = [], []
    for (value, weight), mine in columns.items():
        cut, v = Cut(value, 0.0, weight), F.col(value)
        number = low = high = F.lit(None)
        for r in mine:
            here = v.between(F.lit(r.low), F.lit(r.high))
            # Halves: the distance stays finite.
            number = F.when(here, F.lit(ranges[r])).otherwise(number)
            low = F.when(here, F.lit(r.low).cast("double") / 2).otherwise(low)
            high = F.when(here, F.lit(r.high).cast("double") / 2).otherwise(high)
        # Whole numbers that are one double are not parted here.
        share = F.coalesce(F.try_divide(v.cast("double") / 2 - low, high - low), F.lit(0.0))
        place = F.floor(share * F.lit(float(BUCKETS))) if step else F.lit(0)
        entry = F.struct(number.cast("int").alias("range"), F.least(F.lit(BUCKETS - 1), place).cast("int").alias("step"), v.alias("v"), _weight(cut).alias("w"))
        among = _inside(df, cut) & reduce(or_, [v.between(F.lit(r.low), F.lit(r.high)) for r in mine])
        wanted.append(among)
        entries.append(F.when(among, entry))
    needed = dict.fromkeys(c for column in columns for c in column if c)
    rows = df.select(*needed).where(reduce(or_, wanted))
    if len(entries) == 1:
        return rows.select(entries[0].alias("e")).select("e.*")
    return rows.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")


def _passes(cuts: Mapping[str, Cut], bounds: Mapping[str, _Bounds], kinds: Mapping[str, str]) -> Iterator[dict[str, _Bounds]]:
    """The bounds that are worked on in one pass: a few columns of one type."""
    for kind in sorted({kinds[name] for name in bounds}):
        names = [name for name in bounds if kinds[name] == kind]
        for chunk in _chunks(list(dict.fromkeys((cuts[name].value, cuts[name].weight) for name in names))):
            yield {name: bounds[name] for name in names if (cuts[name].value, cuts[name].weight) in chunk}


def _goals(spark, bounds: Mapping[str, _Bounds], of: Mapping[str, _Range], ranges: Mapping[_Range, int]) -> DataFrame:
    """One row a cut, with the range that it is looked for in."""
    rows = [(i, ranges[of[name]], float(b.wanted), float(b.below)) for i, (name, b) in enumerate(bounds.items())]
    return F.broadcast(spark.createDataFrame(rows, "cut int, range int, wanted double, below double"))


def _narrowed(df: DataFrame, cuts: Mapping[str, Cut], bounds: Mapping[str, _Bounds]) -> dict[str, _Bounds]:
    """Each cut's bounds after a round: the step that its value lies in."""
    of = _ranges(cuts, bounds)
    ranges = {r: i for i, r in enumerate(dict.fromkeys(of.values()))}
    steps = _between(df, ranges, True).groupBy("range", "step").agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    upto = Window.partitionBy("range").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # BUCKETS rows at most
    summed = steps.withColumn("upto", F.sum("w").over(upto)).join(_goals(df.sparkSession, bounds, of, ranges), "range").where(F.col("below") + F.col("upto") >= F.col("wanted"))
    first = summed.groupBy("cut").agg(F.min(F.struct("step", "low", "high", "rows", (F.col("below") + F.col("upto") - F.col("w")).alias("under"))).alias("s"))
    names = list(bounds)
    found = {names[r["cut"]]: r["s"] for r in first.collect()}  # one row a cut
    return {name: _Bounds(s["low"], s["high"], bounds[name].wanted, float(s["under"]), s["rows"]) for name, s in found.items()}


def _finished(df: DataFrame, cuts: Mapping[str, Cut], bounds: Mapping[str, _Bounds]) -> dict[str, object]:
    from casewright.operators.ordering import with_running_totals

    of = _ranges(cuts, bounds)
    ranges = {r: i for i, r in enumerate(dict.fromkeys(of.values()))}
    values = _between(df, ranges, False).groupBy("range", "v").agg(F.sum("w").alias("w"))
    if max(b.rows for b in bounds.values()) <= FINISH:
        running = Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = values.withColumn("upto", F.sum("w").over(running))
    else:
        summed = with_running_totals(values, ["range", "v"], {"_all": "w"})
        begin = summed.groupBy("range").agg(F.min(F.col("_all") - F.col("w")).alias("_begin"))  # one row a range
        summed = summed.join(F.broadcast(begin), "range").withColumn("upto", F.col("_all") - F.col("_begin"))
    passed = summed.join(_goals(df.sparkSession, bounds, of, ranges), "range").where(F.col("below") + F.col("upto") >= F.col("wanted"))
    names = list(bounds)
    return {names[r["cut"]]: r["v"] for r in passed.groupBy("cut").agg(F.min("v").alias("v")).collect()}


def select_cuts(df: DataFrame, cuts: Mapping[str, Cut], reread: bool = False) -> dict[str, object]:
    """The value of every cut, by name; None for a column without values.

    NULL values, and rows with a weight that is NULL or not above 0, do not count; NaN is the largest value. Whole-number weights give
    the same result however the rows are dealt. ``df`` is read in one pass, which stores the columns that the cuts need;
    with ``reread`` (for a stored table) its columns are read for each round instead. Only bounds, a few numbers a cut, reach the driver.
    """
    if not cuts:
        return {}
    needed = dict.fromkeys(c for cut in cuts.values() for c in (cut.value, cut.weight) if c)
    rows = df.select(*needed) if reread else staged(df.select(*needed))
    out: dict[str, object] = {}
    kinds = {name: rows.schema[cut.value].dataType.simpleString() for name, cut in cuts.items()}
    bounds, known = _first_bounds(rows, cuts)
    out |= known
    for _ in range(ROUNDS):
        large = {name: b for name, b in bounds.items() if b.rows > FINISH}
        if not large:
            break
        for part in _passes(cuts, large, kinds):
            bounds |= _narrowed(rows, cuts, part)
        out |= {name: b.low for name, b in bounds.items() if b.low == b.high}
        bounds = {name: b for name, b in bounds.items() if name not in out}
    for part in _passes(cuts, bounds, kinds):
        out |= _finished(rows, cuts, part)
    return {name: out.get(name) for name in cuts}


def cut_column(df: DataFrame, cut: Cut, value: object) -> Column:
    """A selected value as a literal of its column's type."""
    return F.lit(value).cast(df.schema[cut.value].dataType)
