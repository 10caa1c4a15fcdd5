"""Statistics that are fitted on some rows and applied to all: stored group tables and out-of-fold means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.operators.joins import null_safe_lookup
from casewright.operators.selection import Cut, cut_column, select_cuts
from casewright.operators.statistics import group_stats
from casewright.session import staged
from casewright.sources.catalog import read_table, write_table

ROWS = "fitted_rows"


class GroupStatistics(NamedTuple):
    """Group averages of the rows they were fitted on, one stored row a group, with the group's number of rows."""

    keys: tuple[str, ...]
    table: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        """The averages on every row of ``df``; NULL for a group that was not fitted. NULL keys are a group."""
        return null_safe_lookup(df, self.table.drop(ROWS), self.keys, stored=True)

    def quantile(self, name: str, fraction: float) -> Column:
        """A quantile of an average over the fitted rows: groups weigh as much as they have rows."""
        cut = Cut(name, fraction, ROWS)
        return cut_column(self.table, cut, select_cuts(self.table, {name: cut}, reread=True)[name])


def fit_group_statistics(
    train: DataFrame, keys: Sequence[str], stats: Mapping[str, Column],
    digits: int | Mapping[str, int] | None = 6, name: str | None = None,
) -> GroupStatistics:
    """Fit on ``train``; kept as the catalog table ``name``, else in the staging folder."""
    table = group_stats(train, keys, stats, digits, rows=ROWS)
    return GroupStatistics(tuple(keys), staged(table) if name is None else write_table(table, name))


def load_group_statistics(spark: SparkSession, keys: Sequence[str], name: str) -> GroupStatistics:
    return GroupStatistics(tuple(keys), read_table(spark, name))


def fold_of(key: str, folds: int, seed: int) -> Column:
    """A repeatable fold 0 .. folds - 1 from a hash of the key."""
    digest = F.md5(F.concat_ws("-fold-", F.col(key).cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def with_out_of_fold_mean(
    df: DataFrame, keys: Sequence[str], value: Column, key: str, name: str,
    fit_rows: Column | None = None, folds: int = 5, seed: int = 42, digits: int | None = 6,
) -> DataFrame:
    """Group mean of ``value`` that no row has contributed to itself.

    A row that is fitted on gets the mean over the fitted rows of its group in all other folds, every other row the mean
    over all fitted rows of its group; NULL where there are none. Sums are taken a (group, fold) first, so a hot group is added up
    before the shuffle, and the lookup has at most folds + 1 rows a group.
    """
    fitted = F.lit(True) if fit_rows is None else F.coalesce(fit_rows, F.lit(False))
    marked = df.withColumn("_fold", F.when(fitted, fold_of(key, folds, seed)))
    sums = staged(
        marked.where(F.col("_fold").isNotNull()).groupBy(*keys, "_fold")
        .agg(F.coalesce(F.sum(value.cast("double")), F.lit(0.0)).alias("_sum"), F.count(value).alias("_n"))
    )
    whole = sums.groupBy(*keys).agg(F.sum("_sum").alias("_all"), F.sum("_n").alias("_rows"))
    other = null_safe_lookup(sums, whole, keys).select(
        *keys, "_fold", F.try_divide(F.col("_all") - F.col("_sum"), (F.col("_rows") - F.col("_n")).cast("double")).alias(name)
    )
    every = whole.select(*keys, F.lit(None).cast("int").alias("_fold"), F.try_divide("_all", F.col("_rows").cast("double")).alias(name))
    means = other.union(every)
    if digits is not None:
        means = means.withColumn(name, F.round(name, digits))
    return null_safe_lookup(marked, staged(means), [*keys, "_fold"], stored=True).drop("_fold")
