"""Record fingerprints, lineage columns and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_record_hash(
    df: DataFrame, exclude: Sequence[str] = (), sep: str = "||", null_token: str = "NULL", name: str = "record_hash"
) -> DataFrame:
    """SHA-256 over all business columns as text; a NULL counts as the text ``null_token``."""
    parts = [
        F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in df.columns if c not in exclude
    ]
    return df.withColumn(name, F.sha2(F.concat_ws(sep, *parts), 256))


def with_lineage(df: DataFrame, as_of: Column, source: str | Column) -> DataFrame:
    """When and from where a row was ingested; ``as_of`` is passed in so a rerun gives the same rows."""
    origin = F.lit(source) if isinstance(source, str) else source
    return df.withColumns({"ingestion_ts": as_of.cast("timestamp"), "source_file": origin})


def cast_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.col(key).cast("bigint"))


def diff_by_hash(old: DataFrame, new: DataFrame, key: str, name: str = "record_hash") -> DataFrame:
    """(key, change) over two loads: new, gone, changed or same. Only key and hash are exchanged."""
    left = old.select(F.col(key), F.col(name).alias("_old"))
    right = new.select(F.col(key), F.col(name).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "gone")
        .when(F.col("_old") == F.col("_new"), "same")
        .otherwise("changed")
    )
    return left.join(right, key, "full").select(key, change.alias("change"))
