"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("casewright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # One input file is one map task here. Exchanging anything but small lookups, and not reading
        # exchanges locally, spreads what follows over all cores.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, or a scratch folder on a local master only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="casewright-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Whatever was not deterministic in the plan (partition ids, sampled range bounds) is now data, so a
    lost executor re-reads the same rows; later reads still prune columns.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> DataFrame:
    """Cache a reduced DataFrame and count it, so the planner knows its true size.

    Used for lookup sides such as per-group statistics: below
    ``spark.sql.autoBroadcastJoinThreshold`` Spark then broadcasts it without shuffling the large
    side, above it Spark shuffles both sides and splits skewed partitions.
    """
    cached = df.persist()
    cached.count()
    return cached
