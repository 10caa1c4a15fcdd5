"""Many small (owner, token) entries through a shuffle as a few array rows.

Counting who shares which token takes one entry for each distinct token of each document. As rows of
a DataFrame their overhead would exceed their content, so each task sends one row per bin of tokens:
arrays of the owners and their tokens. All entries of a token meet in one bin; the number of bins is
``spark.sql.shuffle.partitions``, so the size of a bin is governed like that of any shuffle partition.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from casewright.llm.text import flat, lists

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "bin int, owners array<bigint>, runs array<int>, tokens array<bigint>, extra array<int>"


def bin_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def packed(owners: np.ndarray, tokens: np.ndarray, extra: np.ndarray, bins: int, by_owner: bool = False) -> pa.RecordBatch:
    """One row per bin of tokens or of owners. ``owners`` has one value per entry; equal owners stand together."""
    where = (((owners if by_owner else tokens).view(np.uint64) & np.uint64(0xFFFFFFFF)) * np.uint64(bins)) >> np.uint64(32)
    order = np.argsort(where.astype(np.int32), kind="stable")
    where, owners, tokens, extra = where[order], owners[order], tokens[order], extra[order]
    change = np.ones(len(where), bool)
    change[1:] = (where[1:] != where[:-1]) | (owners[1:] != owners[:-1])
    first = np.flatnonzero(change)
    runs = np.diff(np.append(first, len(where)))
    names, per_bin = np.unique(where, return_counts=True)
    _, runs_per_bin = np.unique(where[first], return_counts=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names.astype(np.int32)),
            lists(owners[first], runs_per_bin, pa.int64()),
            lists(runs.astype(np.int32), runs_per_bin, pa.int32()),
            lists(tokens.view(np.int64), per_bin, pa.int64()),
            lists(extra.astype(np.int32), per_bin, pa.int32()),
        ],
        names=["bin", "owners", "runs", "tokens", "extra"],
    )


def dealt(packed_rows: DataFrame) -> DataFrame:
    """All rows of a bin in one partition."""
    return packed_rows.repartition(bin_count(packed_rows.sparkSession), "bin")


def entries(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, token, extra) of every entry of a partition."""
    parts = [(flat(b.column("owners"))[0], flat(b.column("runs"))[0], flat(b.column("tokens"))[0], flat(b.column("extra"))[0]) for b in batches]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    owners = np.concatenate([np.repeat(owner, runs) for owner, runs, _, _ in parts])
    return owners, np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
