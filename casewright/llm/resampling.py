"""Operator 12, target-distribution importance resampling with segment deduplication.

Features of a text are all runs of 1 to n consecutive words, hashed into buckets. The gain of a bucket is the log ratio of its
share in a target set to its share in the raw documents; a document's weight is the sum over its features. Documents
are drawn by the largest weights plus Gumbel noise from a hash of their key, which is sampling without replacement in
proportion to exp(weight).

Texts are cut into lines at newlines, which no word contains. For the corpus counts Spark groups equal lines (counted before the
shuffle, so a line that is everywhere is a few rows), the features of each distinct line are counted once and multiplied by its
occurrences. Runs of words that reach over a newline are counted from the texts and added separately; single words never
do. Weights of documents are sums over their lines too, each distinct line of a batch worked out once; going back from
corpus-wide lines to documents instead would shuffle a key for each line of each document, which costs more than its features.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.text import ragged, slices, spans, utf8, word_like
from casewright.operators.ordering import with_global_rank
from casewright.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
SLICE_BYTES = 4_000_000
#: Runs of words up to this many bytes are hashed side by side, longer ones one by one.
SIDE_BY_SIDE = 96


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def crc32_of(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The unsigned crc32 of each ``body[start:end]``, byte by byte for all spans at once."""
    table = _crc_table()
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    first, sizes = starts[order], lengths[order]
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    for at in range(min(SIDE_BY_SIDE, int(sizes[0]) if len(sizes) else 0)):
        alive = int(np.searchsorted(-sizes, -at, "left"))  # spans longer than ``at``
        now = crc[:alive]
        crc[:alive] = table[(now ^ body[first[:alive] + at]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.searchsorted(-sizes, -SIDE_BY_SIDE, "left"))):
        crc[i] = zlib.crc32(body[first[i] : first[i] + sizes[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def features(body: np.ndarray, offsets: np.ndarray, n: int, buckets: int, crossing: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, words of each text): the features inside lines, or with ``crossing`` those that reach over a newline."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    starts, ends, text = spans(body, offsets, word_like())
    words = np.bincount(text, minlength=len(offsets) - 1)
    line = np.cumsum(body == 10)[starts] if len(starts) else starts
    # The words of all texts after each other, one space between them.
    lengths = ends - starts
    at = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(starts) else starts
    spaced = np.full(int((lengths + 1).sum()), 32, np.uint8)
    spaced[ragged(at, lengths)] = fold[body[ragged(starts, lengths)]]
    texts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for run in range(2 if crossing else 1, n + 1):
        low, high = np.arange(max(0, len(starts) - run + 1)), np.arange(run - 1, len(starts))
        together = (text[low] == text[high]) & ((line[low] != line[high]) == crossing)
        low, high = low[together], high[together]
        found.append(crc32_of(spaced, at[low], at[high] + lengths[high]).astype(np.int64) % buckets)
        texts.append(text[low])
    return np.concatenate(texts), np.concatenate(found), words


def bucket_counts(texts: DataFrame, text: str, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often the features of all texts fall into each bucket that has any."""
    schema = "bucket bigint, n bigint"

    def counted(column: str, times: str | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, np.int64)
            for batch in batches:
                many = batch.column(times).to_numpy(zero_copy_only=False) if times else None
                for rows, body, offsets in slices(batch, column, SLICE_BYTES):
                    owner, bucket, _ = features(body, offsets, n, buckets, crossing=times is None)
                    np.add.at(total, bucket, many[rows][owner] if times else 1)
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

        return run

    whole = texts.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    lines = whole.select(F.explode(F.split("_text", "\n")).alias("_line")).where("_line <> ''")
    once = lines.groupBy("_line").agg(F.count(F.lit(1)).alias("_times"))
    parts = once.mapInArrow(counted("_line", "_times"), schema)
    if n > 1:
        parts = parts.union(whole.mapInArrow(counted("_text", None), schema))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str, target_text: str, n: int, buckets: int) -> list[int]:
    """floor(1000 ln of (t + 1) (S + buckets) / ((s + 1) (T + buckets))) for each bucket; ``buckets`` numbers reach the driver."""
    raw = bucket_counts(docs, text, n, buckets).withColumnRenamed("n", "s")
    goal = bucket_counts(target, target_text, n, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    every = staged(every.join(raw, "bucket", "left").join(goal, "bucket", "left").fillna(0))  # one row a bucket
    totals = every.agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    d = lambda c: c.cast("double")
    above = d(F.col("t") + 1) * d(totals.select("s").scalar() + buckets)
    below = d(F.col("s") + 1) * d(totals.select("t").scalar() + buckets)
    gain = F.floor(F.lit(1000.0) * F.log(above / below))
    return [r[0] for r in every.select(gain, "bucket").orderBy("bucket").collect()]


def weighed(docs: DataFrame, gains: list[int], key: str = "doc_id", text: str = "text", n: int = 1) -> DataFrame:
    """(key, n_words, n_features, weight) for each document row; ``gains`` has a number for each bucket."""
    worth, buckets = np.array(gains, np.int64), len(gains)
    narrow = docs.select(key, text)
    schema = f"`{key}` {narrow.schema[key].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint"

    def sums(owner: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        np.add.at(out, owner, values)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(text), "")
            for rows, body, offsets in slices(batch, text, SLICE_BYTES):
                size = len(offsets) - 1
                cut = pc.split_pattern(texts[rows], "\n")
                # Distinct lines of these texts, and which one each line is.
                lines = cut.flatten().dictionary_encode()
                owner, bucket, words = features(*utf8(lines.dictionary), n, buckets)
                known = len(lines.dictionary)
                each = np.stack([words, np.bincount(owner, minlength=known), sums(owner, worth[bucket], known)])
                of = np.repeat(np.arange(size), cut.value_lengths().to_numpy(zero_copy_only=False))
                which = lines.indices.to_numpy(zero_copy_only=False)
                total = [sums(of, row[which], size) for row in each]
                if n > 1:
                    owner, bucket, _ = features(body, offsets, n, buckets, crossing=True)
                    total[1] += np.bincount(owner, minlength=size)
                    total[2] += sums(owner, worth[bucket], size)
                yield pa.RecordBatch.from_arrays([batch.column(key)[rows], *[pa.array(t, pa.int64()) for t in total]], names=[key, "n_words", "n_features", "weight"])

    return narrow.mapInArrow(run, schema)


def noise(seed: int, key: str) -> Column:
    """1000 times a Gumbel number, from the first 32 bits of a hash of seed and key, rounded down; null for a null key."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(mark, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    n: int = 1, buckets: int = BUCKETS, seed: int = 2024, min_words: int = 20, percent: int = 10,
) -> DataFrame:
    """(key, n_features, weight, score, rank) for each document row; ``rank`` is null for rows that are not drawn.

    Of the N documents with at least ``min_words`` words, floor(percent * N / 100) are drawn: the highest scores, ties to the
    smaller key. Null and empty texts have no features and weight 0. A null key has no score and is never drawn nor counted in N.
    Repeated rows are rows of their own with equal scores. An empty target set gives gains that fall with a bucket's count; an
    empty ``docs`` gives no rows. Other columns are ignored.
    """
    gains = bucket_gains(docs, target, text, target_text, n, buckets)
    scored = weighed(docs, gains, key, text, n).withColumn("score", F.col("weight") + noise(seed, key))
    scored = staged(scored.withColumn("_row", F.monotonically_increasing_id()))
    able = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    draws = scored.where(able).agg(F.floor(F.lit(percent) * F.count(F.lit(1)) / F.lit(100)).alias("k"))
    # The last key cuts runs of repeated rows, which are alike.
    order = [F.col("score").desc(), F.col(key).asc(), "weight", "n_features", "_row"]
    placed = with_global_rank(scored.where(able), order, "_place")
    rank = F.when(F.col("_place") <= draws.scalar(), F.col("_place"))
    columns = [key, "n_features", "weight", "score"]
    rest = scored.where(~F.coalesce(able, F.lit(False))).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*columns, rank.alias("rank")).union(rest)


def drawn(docs: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents that were drawn, all their columns as they are; ``key`` is unique."""
    return docs.join(ranks.where("rank IS NOT NULL").select(key), key, "left_semi").select(*docs.columns)
