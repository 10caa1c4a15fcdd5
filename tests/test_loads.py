"""Arrival order, changes between stored loads, and runs that are repeated or fail."""

import pytest
from pyspark.sql import functions as F

from casewright.operators import loads
from casewright.operators.identity import with_record_hash
from casewright.operators.joins import star_join
from casewright.operators.ordering import with_arrival_id
from casewright.sources.catalog import write_bucketed, write_run
from casewright.sources.files import read_csv


def test_ids_follow_the_files_however_they_are_split(spark, tmp_path):
    lines, n = [], 0
    for name, size in (("a", 30), ("b", 4000), ("c", 400)):
        mine = [f"{n + i},{'x' * (i % 7)}" for i in range(size)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["v,t", *mine]) + "\n")
        lines += mine
        n += size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for limit in ("128m", "4k", "17k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
            rows = with_arrival_id(read_csv(spark, str(tmp_path), "v int, t string"), "id").collect()
            assert sorted((r["id"], r["v"]) for r in rows) == [(i + 1, i) for i in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_changed_buckets_are_read(spark):
    old = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    new = old.where("k <> 5").withColumn("v", F.when(F.col("k") == 11, 99).otherwise(F.col("v"))).union(spark.createDataFrame([(5000, 1)], "k bigint, v bigint"))
    first, second = (loads.store_fingerprints(with_record_hash(df), "k", buckets=64) for df in (old, new))
    differing = loads.differing_buckets(first, second)
    assert 1 <= len(differing) <= 3
    changes = loads.changed_rows(first, second)
    assert sorted(map(tuple, changes.collect())) == [(5, "gone"), (11, "changed"), (5000, "new")]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2 and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    every = loads.changed_rows(first, second, unchanged=True)
    assert every.count() == 2001 and every.where("change = 'same'").count() == 1998
    assert loads.changed_rows(first, first).count() == 0
    twice = loads.store_fingerprints(with_record_hash(old.union(old.where("k = 3"))), "k", buckets=64)
    assert len(loads.differing_buckets(first, twice)) == 1
    with pytest.raises(ValueError):
        loads.changed_rows(first, loads.store_fingerprints(with_record_hash(old), "k", buckets=8))


def test_bucketed_tables_join_without_an_exchange(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS star_test")
    parts = [spark.range(500).select(F.col("id").alias("k"), (F.col("id") * n).alias(f"v{n}")) for n in range(8)]
    plain = star_join(parts[0], parts[1:], "k")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [write_bucketed(p, f"star_test.part{n}", "k", 4) for n, p in enumerate(parts)]
        for how in ("inner", "left"):
            joined = star_join(stored[0], stored[1:], "k", how)
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            assert sorted(joined.collect()) == sorted(plain.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.sql("DROP DATABASE star_test CASCADE")


def test_a_run_is_written_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS runs_test")
    name = "runs_test.log"
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(20)], "id int, what string").repartition(3)
    write_run(rows, name, "one")
    write_run(rows, name, "two")
    for _ in range(2):
        assert write_run(rows, name, "two").count() == 40
    broken = rows.withColumn("what", F.when(F.col("id") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("what")))
    for run in ("two", "three"):
        with pytest.raises(Exception, match="lost"):
            write_run(broken, name, run)
        assert spark.table(name).count() == 40
    assert write_run(rows, name, "three").groupBy("run_id").count().collect() and spark.table(name).count() == 60
    assert write_run(rows.limit(0), name, "three").count() == 60
    spark.sql("DROP DATABASE runs_test CASCADE")
