"""Operator 8, toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its words; a document is toxic
unless none of its sentences is (noisy-or). Only documents carry labels, and training through the noisy-or
finds the sentences that explain them. A leak term takes up labels that no sentence explains.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.text import byte_codes, flat, lists, slices, span_hashes, spans, word_like

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 18
#: Training documents of each label, those first in the order of a hash of the id.
TRAIN_ROWS = 4_000
STEPS, RATE = 200, 0.1
#: A word's weight stays zero unless more than this, as a sum of gradients over documents, speaks for it. That is for ``POSITIVES`` toxic
#: training documents or more; with fewer, less is asked for, in proportion to the root of their number, as chance brings less together.
EVIDENCE, POSITIVES = 0.3, 300
THRESHOLD = 0.7


def sentence_words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket and sentence of each word; start, end and row of each sentence).

    Sentences end at ``.``, ``!``, ``?`` and line ends; words are runs of letters, digits and characters beyond
    ASCII, with A-Z folded.
    """
    inside = np.ones(256, bool)
    inside[[10, 13, 33, 46, 63]] = False
    s_start, s_end, s_row = spans(body, offsets, inside)
    w_start, w_end, _ = spans(body, offsets, word_like())
    bucket = span_hashes(body, w_start, w_end, byte_codes(True)) >> np.uint64(46)
    return bucket.astype(np.int64), np.searchsorted(s_start, w_start, "right") - 1, s_start, s_end, s_row


def _bags(training: DataFrame) -> DataFrame:
    """(label, words, sentence): buckets of a document's words and the number of each one's sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, body, offsets in slices(batch, "text"):
                bucket, sentence, _, _, s_row = sentence_words(body, offsets)
                pair = np.unique(sentence << 18 | bucket)  # each word once in a sentence
                bucket, sentence = pair & (BUCKETS - 1), pair >> 18
                row = s_row[sentence] if len(sentence) else sentence
                counts = np.bincount(row, minlength=len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic")[rows].cast(pa.int32()), lists(bucket.astype(np.int32), counts, pa.int32()), lists(sentence.astype(np.int32), counts, pa.int32())],
                    names=["label", "words", "sentence"],
                )

    return training.select("toxic", "text").mapInArrow(run, "label int, words array<int>, sentence array<int>")


def _descend(word: np.ndarray, sentence: np.ndarray, row: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) that fit the labels; Adam with soft thresholding."""
    used, word = np.unique(word, return_inverse=True)
    n_sentence, n_doc = len(row), len(label)
    w = np.zeros(len(used) + 2)  # words, bias, leak
    w[-2], w[-1] = -5.0, -3.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    evidence = EVIDENCE * min(1.0, (label.sum() / POSITIVES) ** 0.5)
    for step in range(1, STEPS + 1):
        z = np.clip(np.bincount(sentence, w[:-2][word], n_sentence) + w[-2], -30, 30)
        p = 1 / (1 + np.exp(-z))
        leak = 1 / (1 + np.exp(-w[-1]))
        none = np.bincount(row, np.log1p(-p), n_doc) + np.log1p(-leak)  # log of: no sentence and no leak
        clean = np.exp(none)
        # Gradient of the log loss by ``none``.
        g = np.where(label == 1, clean / np.maximum(1 - clean, 1e-9), -1.0) / n_doc
        gz = g[row] * -p
        grad = np.concatenate([np.bincount(word, gz[sentence], len(used)), [gz.sum(), (g * -leak).sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        scale = RATE / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w = w - scale * m / (1 - 0.9**step)
        words = w[:-2]
        w[:-2] = np.sign(words) * np.maximum(np.abs(words) - scale[:-2] * evidence / n_doc, 0)
    out = np.zeros(BUCKETS + 1)
    out[used], out[-1] = w[:-2], w[-2]
    return out


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Word weights and bias, from documents (doc_id, text) with labels (doc_id, toxic).

    At most ``rows`` documents of each label are used, so what reaches the driver (their words as numbers) and
    the weights are bounded. A document with several labels counts as toxic if one says so; null labels are skipped. With
    one kind of label only, every score is the bias.
    """
    once = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = [once.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))
    table = _bags(docs.select("doc_id", "text").join(chosen, "doc_id")).toArrow().combine_chunks()
    label = table["label"].to_numpy()
    if len(set(label.tolist())) < 2:
        return np.append(np.zeros(BUCKETS), -5.0)
    column = lambda name: table[name].chunk(0)
    word, counts = flat(column("words"))
    doc = np.repeat(np.arange(len(label)), counts)
    # Sentences were numbered within each slice; number the pairs (document, sentence) anew.
    pair, sentence = np.unique(doc << 32 | flat(column("sentence"))[0], return_inverse=True)
    return _descend(word, sentence, pair >> 32, label)


def scored(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, score, predicted, offending) for each document row.

    ``offending`` lists the sentences with a score of at least one half as (start, end, score), in bytes of the
    UTF-8 text. Null and empty texts have no sentences and score 0. Repeated rows each get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, score double, predicted int, offending array<struct<start:int,end:int,score:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for rows, body, offsets in slices(batch, text):
                n = len(offsets) - 1
                bucket, sentence, s_start, s_end, s_row = sentence_words(body, offsets)
                # Each word once in a sentence; words without weight need not be told apart.
                use = w[bucket] != 0
                pair = np.unique(sentence[use] << 18 | bucket[use])
                z = np.bincount(pair >> 18, w[pair & (BUCKETS - 1)], len(s_start)) + w[-1]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                score = 1 - np.exp(np.bincount(s_row, np.log1p(-p), n)) if len(p) else np.zeros(n)
                bad = np.flatnonzero(p >= 0.5)
                at = s_start[bad] - offsets[s_row[bad]]
                found = pa.StructArray.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array((at + s_end[bad] - s_start[bad]).astype(np.int32)), pa.array(p[bad])], names=["start", "end", "score"]
                )
                ends = np.concatenate(([0], np.cumsum(np.bincount(s_row[bad], minlength=n)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key)[rows], pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), found)],
                    names=[key, "score", "predicted", "offending"],
                )

    return narrow.mapInArrow(run, schema)
