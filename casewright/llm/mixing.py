"""Operator 11, mixing sources to target weights by Pareto order sampling.

Targets in words are shared among sources by weight and stop at a multiple of what a source has. A source whose
target is r times its words takes each of its documents floor(r) times for certain. The rest of its target
is a sample: every document has the inclusion probability ``r - floor(r)``, documents are ranked by random
odds divided by inclusion odds, and the first ones are taken up to the size that is missing. Only DataFrame functions.

Ranks of all sources come from one range partitioning by (source, rank key), so a source with a third of
all documents is spread over many tasks; what is shuffled has a few numbers a document and no text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.operators.ordering import with_global_rank, with_running_totals
from casewright.session import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: As many documents of a source may follow its ranked sample until it is as near to its target as ``NEAR``.
CLOSING, NEAR = 8, 0.002


def word_count(text: str) -> Column:
    """Words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = 150, most: int = 2) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with one row per source.

    Sources in the order of their code points, null last, have the ``weights`` in turn and share ``percent`` of
    all words by weight. Nobody gets over ``most`` times its words; what is above goes to the others by weight until
    none is above. That fixed point is the level c with sum(min(most * size, c * weight)) = the words to share, found
    in one pass over the sources in the order in which a rising level fills them: a source is full if all
    sources up to it are filled at its own level without using up the words. A source without words has the target 0.
    """
    turn = F.get(F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights)).cast("int"))
    placed = with_global_rank(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], "_place")
    weighed = placed.select("source", "source_size", turn.cast("bigint").alias("_w"), (F.col("source_size") * most).alias("_cap"))
    weighed = weighed.withColumn("_level", F.col("_cap") / F.col("_w"))
    filled = with_running_totals(weighed, ["_level", F.col("source").asc_nulls_last()], {"_caps": "_cap", "_ws": "_w"})
    totals = weighed.agg(F.sum("source_size").alias("s"), F.sum("_w").alias("w"))
    goal, all_w = F.lit(percent) * totals.select("s").scalar() / F.lit(100.0), totals.select("w").scalar()
    full = (F.col("_caps") + F.col("_level") * (all_w - F.col("_ws")) <= goal) | (F.col("_cap") == 0)
    marked = staged(filled.select("source", "source_size", "_w", "_cap", full.alias("_full"), goal.alias("_goal"), all_w.alias("_all")))
    used = marked.where("_full").agg(F.coalesce(F.sum("_cap"), F.lit(0)).alias("c"), F.coalesce(F.sum("_w"), F.lit(0)).alias("w"))
    level = (F.col("_goal") - used.select("c").scalar()) / F.nullif(F.col("_all") - used.select("w").scalar(), F.lit(0))
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.least(F.col("_cap").cast("double"), level * F.col("_w")))
    return marked.select("source", "source_size", target.alias("target"))


def order_key(seed: int, key: str, size: str, chance: str) -> Column:
    """Random odds over inclusion odds; the draw depends on seed, key and size alone, so a rerun draws the same."""
    mark = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(size).cast("string"))
    draw = (F.conv(F.substring(F.sha2(mark.cast("binary"), 256), 1, 12), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 48))
    return draw / (F.lit(1.0) - draw) * ((F.lit(1.0) - F.col(chance)) / F.col(chance))


def _closing(chosen: DataFrame, rounds: int, near: float) -> DataFrame:
    """(_row, _add): documents that close the gap between a source's sample and what is missing, one a source and round.

    Of the documents left, in each round the largest that fits into the gap, else the smallest if that brings the
    source nearer; of equal ones the first in rank. A source is done when its gap is at most ``near`` of its target.
    """
    taken = F.coalesce(F.sum(F.when(F.col("_in"), F.col("_size"))), F.lit(0))
    gaps = chosen.where("_q IS NOT NULL").groupBy(F.col("_source").alias("_of"))
    gaps = gaps.agg((F.first("_missing") - taken).alias("_gap"), F.greatest(F.first("target") * near, F.lit(0.5)).alias("_fine"))
    gaps = staged(gaps.where("_gap > _fine"))
    added = gaps.select(F.lit(0).cast("bigint").alias("_row"), F.lit(True).alias("_add")).limit(0)
    free = chosen.where("_q IS NOT NULL AND NOT _in").select("_source", "_size", "_q", "_row")
    for _ in range(rounds):
        if gaps.isEmpty():
            break
        left = free.join(gaps, free["_source"].eqNullSafe(F.col("_of"))).where("_size < 2 * _gap")
        pick = F.struct((F.col("_size") > F.col("_gap")).alias("over"), F.abs(F.col("_gap") - F.col("_size")).alias("d"), "_q", "_row", "_size", "_gap", "_fine")
        best = staged(left.groupBy("_of").agg(F.min(pick).alias("p")).select("_of", "p.*"))
        added = added.union(best.select("_row", F.lit(True)))
        gaps = best.select("_of", (F.col("_gap") - F.col("_size")).alias("_gap"), "_fine").where("_gap > _fine")
        free = free.join(best.select("_row"), "_row", "left_anti")
    return added


def mixed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = 150, most: int = 2, seed: int = 11,
    key: str = "doc_id", text: str = "text", source: str = "source", closing: int = CLOSING, near: float = NEAR,
) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for each document row; ``taken = copies * size``.

    The ranked sample of a source ends before the document that would exceed its target. If that is off by more than
    the share ``near`` of the target, as it may be for few documents, up to ``closing`` documents are added that fit into
    what is missing. No document has more than ``most`` copies.

    Null texts and texts without words have size 0 and take 0 words, with the certain copies only. A null source is a source.
    Documents with a null key are drawn by their size; equal (key, size) rows have equal odds, and any of them
    may be the one taken. Repeated rows count each. An empty table gives no rows; other columns are ignored.
    """
    read = staged(docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(text).alias("_size")))
    sizes = read.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    goals = staged(source_targets(sizes, weights, percent, most))
    # Spark knows the size of the stored table of sources: it is broadcast if small, else both sides are shuffled.
    with_goal = read.join(goals, read["_source"].eqNullSafe(goals["source"])).drop("source")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    certain = F.least(F.lit(most), F.floor(rate)).cast("bigint")
    rated = with_goal.withColumn("_sure", certain).withColumn("_chance", rate - F.col("_sure"))
    rated = rated.withColumn("_missing", F.col("target") - F.col("_sure") * F.col("source_size"))
    drawn = (F.col("_chance") > 0) & (F.col("_chance") < 1) & (F.col("_size") > 0)
    ranked = rated.withColumn("_q", F.when(drawn, order_key(seed, "_key", "_size", "_chance"))).withColumn("_measure", F.when(drawn, F.col("_size")).otherwise(0))
    # The last key cuts runs of repeated rows; which of them comes first makes no difference to the result.
    ranked = ranked.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("_source").asc_nulls_last(), F.col("_q").asc_nulls_last(), F.col("_key").asc_nulls_last(), "_size", "_row"]
    summed = with_running_totals(ranked, order, {"_upto": "_measure"})
    # Where a source begins in the one running total: the end of the sources before it.
    begin = staged(summed.groupBy("_source").agg(F.min(F.col("_upto") - F.col("_measure")).alias("_begin")))
    begin = begin.select(F.col("_source").alias("_of"), "_begin")
    summed = summed.join(begin, summed["_source"].eqNullSafe(F.col("_of"))).drop("_of")
    inside = F.col("_q").isNotNull() & (F.col("_upto") - F.col("_begin") <= F.col("_missing"))
    chosen = staged(summed.withColumn("_in", inside).drop("_begin", "_upto", "_measure"))
    extra = _closing(chosen, closing, near)
    chosen = chosen.join(extra, "_row", "left").withColumn("_in", F.col("_in") | F.coalesce("_add", F.lit(False)))
    copies = F.col("_sure") + F.when(F.col("_in"), 1).otherwise(0)
    return chosen.select(
        F.col("_key").alias(key), F.col("_source").alias(source), F.col("_size").alias("size"), "source_size", "target",
        copies.cast("bigint").alias("copies"), (copies * F.col("_size")).cast("bigint").alias("taken"),
    )


def expanded(docs: DataFrame, mix: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mix itself: each document as many times as it is taken. ``mix`` has one row for each ``key``, which is unique."""
    times = mix.where("copies > 0").select(F.col(key).alias("_mixed_key"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return docs.join(times, docs[key] == F.col("_mixed_key")).select(*[docs[c] for c in docs.columns])
