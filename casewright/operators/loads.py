"""Loads of a table compared by stored fingerprints, reading only what differs."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.session import staging_root

BUCKETS = 1024


class Fingerprints(NamedTuple):
    """A load's (key, hash) rows in folders by bucket of the key, and one digest row a bucket."""

    rows: DataFrame
    digests: DataFrame
    key: str
    buckets: int


def store_fingerprints(load: DataFrame, key: str, name: str = "record_hash", buckets: int = BUCKETS, path: str | None = None) -> Fingerprints:
    """Store the fingerprints of a load under ``path``, by default in the staging folder.

    Two loads can be compared if they have the same number of buckets. A bucket is one task's file, so choose it with the
    size of the table. A NULL key is a key.
    """
    path = path or f"{staging_root(load.sparkSession)}/fingerprints-{uuid.uuid4().hex}"
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    load.select(F.col(key), F.col(name).alias("hash"), bucket.alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    rows = load.sparkSession.read.parquet(f"{path}/rows")
    mark = lambda seed: F.xxhash64(F.lit(seed), key, "hash")
    # Whatever the order of rows; a row that is there twice is counted and added up, so it does not cancel itself out.
    digest = [F.count(F.lit(1)).alias("n"), F.bit_xor(mark(1)).alias("x"), F.sum(mark(2).bitwiseAND(F.lit(0xFFFFFFFF))).alias("s")]
    rows.groupBy("bucket").agg(*digest).coalesce(1).write.parquet(f"{path}/digests")
    return load_fingerprints(load.sparkSession, key, buckets, path)


def load_fingerprints(spark: SparkSession, key: str, buckets: int, path: str) -> Fingerprints:
    return Fingerprints(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/digests"), key, buckets)


def differing_buckets(old: Fingerprints, new: Fingerprints) -> list[int]:
    """Buckets whose digests differ, from one row a bucket."""
    if old.buckets != new.buckets:
        raise ValueError("the loads have different buckets")
    changed = old.digests.exceptAll(new.digests).union(new.digests.exceptAll(old.digests)).select("bucket").distinct()
    return sorted(r[0] for r in changed.collect())


def changed_rows(old: Fingerprints, new: Fingerprints, unchanged: bool = False) -> DataFrame:
    """(key, change) for rows that are new, gone or changed; with ``unchanged`` also same.

    Only folders of buckets that differ are read and joined; the keys of all others, if wanted, are read from the new load alone.
    """
    key, differing = old.key, differing_buckets(old, new)
    mine = lambda load, name: load.rows.where(F.col("bucket").isin(differing)).select(F.col(key).alias(f"_{name}_key"), F.col("hash").alias(f"_{name}"))
    left, right = mine(old, "old"), mine(new, "new")
    joined = left.join(right, left["_old_key"].eqNullSafe(right["_new_key"]), "full")
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone").when(F.col("_old") == F.col("_new"), "same").otherwise("changed")
    known = F.when(F.col("_new").isNull(), F.col("_old_key")).otherwise(F.col("_new_key"))
    out = joined.select(known.alias(key), change.alias("change"))
    if not unchanged:
        return out.where("change <> 'same'")
    return out.union(new.rows.where(~F.col("bucket").isin(differing)).select(key, F.lit("same")))
