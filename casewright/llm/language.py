"""Operator 10, language by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a text is
the sum over all its segmentations into pieces, by the forward algorithm; the piece probabilities come from
expected piece counts (forward and backward) over training texts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.pieces import MODEL, REMEMBERED, Edges, Memory, Vocabulary, fitting, marked, some, stretches, vocabulary
from casewright.llm.text import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Training texts per language, those first in the order of a hash of the id.
TRAIN_ROWS = 2_000
MAX_LANGUAGES = 200


def forward(e: Edges, score: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all segmentations up to each position; ``score`` is (languages, pieces)."""
    size = int(e.last[-1]) + 1 if len(e.last) else 0
    alpha = np.full((len(score), size), -np.inf)
    alpha[:, e.first] = 0.0
    for low, high in zip(e.bound[:-1], e.bound[1:]):
        if low < high:
            right = e.right[low:high]
            at = np.flatnonzero(np.append(True, right[1:] != right[:-1]))
            alpha[:, right[at]] = _summed(alpha[:, e.left[low:high]] + score[:, e.piece[low:high]], at)
    return alpha


def _summed(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log of the sum of exp over each run of columns that begins at ``at``."""
    top = np.maximum.reduceat(value, at, axis=1)
    spread = np.repeat(top, np.diff(np.append(at, value.shape[1])), axis=1)
    return top + np.log(np.add.reduceat(np.exp(value - spread), at, axis=1))


def expected_counts(e: Edges, score: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over stretches that occur ``times`` times; ``score`` is (pieces,)."""
    alpha = forward(e, score[None, :])[0]
    size = len(alpha)
    length = e.last - e.first
    beta = np.full(size, -np.inf)
    beta[e.last] = 0.0
    # Edges by the number of bytes that follow their start, so that what is to the right is known first.
    owner = np.searchsorted(e.first, e.left, "right") - 1
    rest = length[owner] - (e.left - e.first[owner])
    order = np.lexsort((e.left, rest))
    left, right, piece = e.left[order], e.right[order], e.piece[order]
    bound = np.searchsorted(rest[order], np.arange(1, int(length.max()) + 2))
    for low, high in zip(bound[:-1], bound[1:]):
        if low < high:
            at = np.flatnonzero(np.append(True, left[low + 1 : high] != left[low : high - 1]))
            beta[left[low:high][at]] = _summed((beta[right[low:high]] + score[piece[low:high]])[None, :], at)[0]
    share = np.exp(alpha[e.left] + score[e.piece] + beta[e.right] - alpha[e.last][owner]) * times[owner]
    return np.bincount(e.piece, share, len(score))


def trained(training: DataFrame, path: str = MODEL, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities (languages, pieces)) from rows (doc_id, text, lang).

    The first estimate of every piece is its score in the vocabulary; one round of expected counts gives each
    language its own, smoothed by the vocabulary's. At most ``rows`` texts per language and
    ``MAX_LANGUAGES`` languages (else an error) are learned; null languages are skipped.
    """
    spark = training.sparkSession
    v = vocabulary(path)
    known = training.where("lang IS NOT NULL AND text IS NOT NULL")
    per_lang = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(per_lang)
    if not languages:
        return [], np.zeros((0, len(v.score)))
    # A share of each language by hash, so that about ``rows`` texts are left, and never more than twice as many.
    keep = F.lit(False)
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    for lang in languages:
        keep = keep | ((F.col("lang") == lang) & (unit < min(1.0, rows / per_lang[lang])))
    shared = spark.sparkContext.broadcast(tuple(v))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        score = np.where(np.isfinite(v.score), v.score, -1e9)
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows_, body, offsets in slices(batch, "text"):
                names = np.array(batch.column("lang")[rows_].to_pylist())
                s = stretches(*marked(body, offsets), v.joined)
                if len(s.which) == 0:
                    continue
                for lang in np.unique(names):
                    use = names[s.row] == lang
                    times = np.bincount(s.which[use], minlength=len(s.start)).astype(float)
                    seen = np.flatnonzero(times)
                    if len(seen) == 0:
                        continue
                    part = fitting(some(s, seen), v)
                    totals[lang] = totals.get(lang, 0.0) + expected_counts(part, score, times[seen])
        for lang, values in totals.items():
            used = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(values[used])], names=["lang", "piece", "n"])

    counts = known.where(keep).select("text", "lang").mapInArrow(count, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # at most one row per language and piece of the vocabulary
    n = np.zeros((len(languages), len(v.score)))
    place = {lang: i for i, lang in enumerate(languages)}
    np.add.at(n, ([place[x] for x in table["lang"].to_pylist()], table["piece"].to_numpy()), table["n"].to_numpy())
    prior = np.where(np.isfinite(v.score), np.exp(np.where(np.isfinite(v.score), v.score, 0.0)), 0.0)
    prior = prior / prior.sum()
    p = (n + 1000.0 * prior) / (n.sum(axis=1, keepdims=True) + 1000.0)
    with np.errstate(divide="ignore"):
        return languages, np.maximum(np.log(p), -1e9)


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predicted(docs: DataFrame, languages: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text", path: str = MODEL) -> DataFrame:
    """(key, lang_pred, score) for each document row; score is the share of the best language.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no language was learned.
    Equal scores go to the first language by name. Repeated rows each get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tuple(vocabulary(path)), languages, model))
    narrow = docs.select(key, F.col(text).alias("_t"), has_letter(text).alias("_letter"))
    schema = f"`{key}` {narrow.schema[key].dataType.simpleString()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, names, score = shared.value
        likelihoods = Likelihoods(Vocabulary(*parts), score)
        for batch in batches:
            for rows, body, offsets in slices(batch, "_t"):
                n = len(offsets) - 1
                letter = batch.column("_letter")[rows].to_numpy(zero_copy_only=False).astype(bool)
                if not names:
                    names_out, share = ["und"] * n, np.zeros(n)
                else:
                    total = likelihoods(body, offsets)
                    best = total.argmax(axis=0)
                    share = 1 / np.exp(total - total.max(axis=0)).sum(axis=0)
                    share = np.where(letter, share, 0.0)
                    names_out = [names[b] if ok else "und" for b, ok in zip(best, letter)]
                yield pa.RecordBatch.from_arrays([batch.column(key)[rows], pa.array(names_out, pa.string()), pa.array(share)], names=[key, "lang_pred", "score"])

    return narrow.mapInArrow(run, schema)


class Likelihoods:
    """Log probability of each text of a slice in each language; known stretches are remembered."""

    def __init__(self, v: Vocabulary, score: np.ndarray) -> None:
        self.v, self.score = v, score
        self.forget()

    def forget(self) -> None:
        self.memory, self.known = Memory(), np.zeros((len(self.score), 0))

    def __call__(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        s = stretches(*marked(body, offsets), self.v.joined)
        n = len(offsets) - 1
        if len(s.which) == 0:
            return np.zeros((len(self.score), n))
        if self.known.shape[1] > REMEMBERED:
            self.forget()
        slots, fresh = self.memory.slots_of(s.hashes)
        if len(fresh):
            e = fitting(some(s, fresh), self.v)
            self.known = np.concatenate([self.known, forward(e, self.score)[:, e.last]], axis=1)
        which = slots[s.which]
        return np.stack([np.bincount(s.row, row[which], n) for row in self.known])


def identify(docs: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text", path: str = MODEL, rows: int = TRAIN_ROWS) -> DataFrame:
    """Learn from ``training`` (doc_id, text, lang), then predict every row of ``docs``."""
    languages, model = trained(training.select("doc_id", "text", "lang"), path, rows)
    return predicted(docs, languages, model, key, text, path)


