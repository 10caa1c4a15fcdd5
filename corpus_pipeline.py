"""From documents to tokens: five stages, each written and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm import decontaminate, jaccard, pieces, pii, toxicity
from casewright.llm.queries import held_out, table
from casewright.llm.text import fresh
from casewright.session import staged, staging_root


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learned from the labels of documents in the stage's input."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    weights = toxicity.trained(docs, labels)
    (row,) = fresh([*docs.columns, "predicted", "score"], "whole_row")
    marked = toxicity.scored(docs.select("text", F.struct(*docs.columns).alias(row)), weights, key=row)
    return marked.where("predicted = 0").select(f"{row}.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, of texts under one id the one with the smallest hash.

    Texts that have one id but are not alike are documents of their own. Repeated rows of the document that stays are copies of
    it; any one stays. Rows without an id, and texts without words, stay.
    """
    own, of, mark = fresh(docs.columns, "own_hash", "drop_key", "drop_hash")
    groups = staged(jaccard.near_duplicates(docs, marks=True).where("group_mark IS NOT NULL").select("doc_id", "text_mark", "group_mark"))
    document = F.struct("doc_id", "text_mark")
    several = staged(groups.groupBy("group_mark").agg(F.min(document).alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = groups.join(several, "group_mark")
    named = lambda df: staged(df.select(F.col("doc_id").alias(of), F.col("text_mark").alias(mark)).distinct())
    dropped = named(members.where(document != F.col("stays")))
    repeated = named(members.where(document == F.col("stays")).groupBy("doc_id", "text_mark").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    marked = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = (F.col("doc_id") == F.col(of)) & (F.col(own) == F.col(mark))
    kept = marked.join(dropped, same, "left_anti")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", own])
    return kept.join(repeated, same, "left_anti").union(once).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"), "documents")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; ``n_chars`` follows where a text changed."""
    own, of, mark, places = fresh(docs.columns, "own_hash", "found_key", "found_hash", "found_spans")
    found = pii.personal_data(docs.select("doc_id", "text")).where("size(spans) > 0")
    found = found.select(F.col("doc_id").alias(of), F.col("_text").alias(mark), F.col("spans").alias(places)).dropDuplicates([of, mark])
    mine = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = mine.join(found, F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(own) == F.col(mark)), "left")
    changed = joined.withColumn("text", F.when(F.col(places).isNotNull(), pii.redacted("text", places)).otherwise(F.col("text")))
    changed = changed.withColumn("n_chars", F.when(F.col(places).isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, n_bytes, log_score, decoded) of every document."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("SentencePiece", tokens),
]

#: Training, near-duplicate groups by connected components and segmentation are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored in the shared folder."""
    root = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
