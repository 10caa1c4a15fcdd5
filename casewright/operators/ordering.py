"""Global order on many executors: dense ids, full ranks, running totals, exact quantiles, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.expressions import ColumnLike, as_column
from casewright.operators.selection import Cut, cut_column, select_cuts
from casewright.session import staged

# monotonically_increasing_id keeps the row's position inside its partition in the low 33 bits.
POSITION_MASK = (1 << 33) - 1


def _placed(df: DataFrame, order: Sequence[ColumnLike]) -> DataFrame:
    """Rows with (partition, position) in global order, staged so that the placement cannot change."""
    if order:
        keys = [as_column(c) for c in order]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return staged(
        df.withColumn("_cw_part", F.spark_partition_id()).withColumn(
            "_cw_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK))
        )
    )


def _with_offsets(placed: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Attach what all earlier partitions add up to.

    The offsets have one row per partition, so the single-task window over them and the broadcast
    are bounded by the partition count, not by the data.
    """
    per_part = placed.groupBy("_cw_part").agg(*[total.alias(name) for name, total in sums.items()])
    before = Window.orderBy("_cw_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_cw_part", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums]
    )
    return placed.join(F.broadcast(offsets), "_cw_part")


def with_global_rank(df: DataFrame, order: Sequence[ColumnLike], name: str) -> DataFrame:
    """Dense 1..n position in ``order`` without sorting everything in one task.

    ``order`` should end in a unique key: it makes the result repeatable and lets the range
    partitioning cut through long runs of equal scores.
    """
    ranked = _with_offsets(_placed(df, order), {"_cw_offset": F.count(F.lit(1))})
    position = (F.col("_cw_offset") + F.col("_cw_pos") + 1).cast("bigint")
    return ranked.withColumn(name, position).drop("_cw_part", "_cw_pos", "_cw_offset")


def with_row_id(df: DataFrame, order_by: Sequence[ColumnLike] | None = None, name: str = "entity_id") -> DataFrame:
    """Dense 1..n id, in arrival order unless ``order_by`` is given."""
    return with_global_rank(df, order_by or [], name)


def with_arrival_id(read: DataFrame, name: str = "entity_id") -> DataFrame:
    """Dense 1..n id in the order of the files: by path, place of the block in the file, and row in the block.

    ``read`` comes straight from a file source. Which task read which block, and how large blocks are, makes no difference.
    """
    place = {"_cw_file": F.col("_metadata.file_path"), "_cw_block": F.col("_metadata.file_block_start"), "_cw_row": F.monotonically_increasing_id()}
    marked = read.select("*", *[value.alias(column) for column, value in place.items()])
    return with_global_rank(marked, list(place), name).drop(*place)


def with_unique_id(df: DataFrame, name: str = "entity_id") -> DataFrame:
    """Unique id with gaps; costs nothing."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_running_totals(df: DataFrame, order: Sequence[ColumnLike], totals: Mapping[str, str]) -> DataFrame:
    """Running sum (current row included) of columns in global order: ``{new_name: column}``."""
    offset = {f"_before_{name}": F.sum(column) for name, column in totals.items()}
    placed = _with_offsets(_placed(df, order), offset)
    window = Window.partitionBy("_cw_part").orderBy("_cw_pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumns(
        {name: F.col(f"_before_{name}") + F.sum(column).over(window) for name, column in totals.items()}
    )
    return summed.drop("_cw_part", "_cw_pos", *offset)


def priority_rank(df: DataFrame, score: str, tie: str, extra: Sequence[ColumnLike] = ()) -> DataFrame:
    """Full ranking by score, highest first; ties go by ``extra`` and then by the entity id."""
    order = [F.col(score).desc_nulls_last(), *map(as_column, extra), F.col(tie).asc()]
    return with_global_rank(df, order, "priority_rank")


def top_n(df: DataFrame, order: Sequence[ColumnLike], n: int) -> DataFrame:
    """First ``n`` rows in order: each task keeps ``n`` rows, no full sort."""
    return df.orderBy(*map(as_column, order)).limit(n)


def top_rows(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the highest score, ties to the smaller key, in no order, for any ``n``; rows without a score are left out.

    ``score`` and ``key`` are numbers, and the key is unique. The n-th score is selected, then the n-th key among rows with that score; what
    remains is a filter, so no task holds the result. ``df`` is a stored table.
    """
    scored = df.where(F.col(score).isNotNull())
    total = scored.count()
    if n >= total or n <= 0:
        return scored if n > 0 else scored.where(F.lit(False))
    place = Cut(score, (total - n + 0.5) / total)
    limit = cut_column(df, place, select_cuts(scored, {"cut": place}, reread=True)["cut"])
    ties = scored.where(F.col(score) == limit)
    above, equal = scored.agg(F.count_if(F.col(score) > limit), F.count_if(F.col(score) == limit)).first()
    last = Cut(key, (n - above - 0.5) / equal)
    key_limit = cut_column(df, last, select_cuts(ties, {"cut": last}, reread=True)["cut"])
    return scored.where((F.col(score) > limit) | ((F.col(score) == limit) & (F.col(key) <= key_limit)))


def queue_head(queue: DataFrame, n: int, rank: str = "priority_rank") -> DataFrame:
    """The first ``n`` entries of an already ranked queue."""
    return queue.where(F.col(rank) <= n)


def quantile(df: DataFrame, column: str, q: float, relative_error: float = 0.0) -> DataFrame:
    """One-row DataFrame ``(cut)`` with a quantile of the non-NULL values.

    With an error bound it is a mergeable sketch in one pass; with 0 it is the exact discrete quantile, selected in rounds.
    """
    if relative_error > 0:
        accuracy = int(round(1 / relative_error))
        return df.agg(F.percentile_approx(column, q, accuracy).alias("cut"))
    cut = Cut(column, q)
    return df.sparkSession.range(1).select(cut_column(df, cut, select_cuts(df, {"cut": cut})["cut"]).alias("cut"))
