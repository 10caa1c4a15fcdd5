"""Operator 7, quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Words and word pairs are hashed into ``BUCKETS``; one multinomial is counted over every document, the other
over trusted ones. The mean log ratio over a document's n-grams is compared with a fixed threshold, so the
same document always gets the same verdict. Plain rules on length, symbols and repetition stand beside it.
Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.session import staged

BUCKETS = 1 << 16
#: Ids of trusted documents are broadcast up to this many rows.
BROADCAST_ROWS = 1_000_000
THRESHOLD = -0.1
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), "")


def hashed_ngrams(words: str) -> Column:
    """A bucket for each word and for each word with its successor."""
    bucket = lambda *c: F.xxhash64(*c).bitwiseAND(BUCKETS - 1).cast("int")
    pairs = F.transform(words, lambda w, i: bucket(F.lit(2), w, F.get(F.col(words), i + 1)))
    return F.concat(F.transform(words, lambda w: bucket(F.lit(1), w)), pairs)


def repeated_words(words: str) -> Column:
    """Words inside 3-word windows that are found at least twice in the text."""
    w = F.col(words)
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) >= 3, windows).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: str, ordered: str) -> Column:
    """Size of the union of [p, p + 3) over windows p whose hash stands next to its like in ``ordered``."""
    o = F.col(ordered)
    like = lambda e, j: F.coalesce(F.get(o, j)["h"] == e["h"], F.lit(False))
    starts = F.transform(F.filter(o, lambda e, i: ((i > 0) & like(e, i - 1)) | like(e, i + 1)), lambda e: e["p"])
    sums = F.aggregate(
        F.sort_array(starts), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
    )
    return sums["n"]


def rule_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words), all counts long."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    read = docs.select(*keep, t.alias("_t"), words_of(text).alias("words"), lines.alias("_lines"))
    counted = read.select(
        *keep, "words", F.size("words").cast("bigint").alias("n_words"), F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.when(F.col("_t").rlike(SYMBOLS), F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).otherwise(0).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"), repeated_words("words").alias("_w"),
    )
    twice = F.size(F.array_distinct("_w")) < F.size("_w")
    ordered = F.when(twice, F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    counted = counted.withColumn("_o", ordered)
    repeats = F.when(F.col("_o").isNull(), 0).otherwise(_covered("_w", "_o")).cast("bigint")
    return counted.withColumn("n_repeat_words", repeats).drop("_w", "_o")


def log_ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> list[float]:
    """Log of trusted over raw probability for every bucket, add-one smoothed; ``BUCKETS`` numbers.

    ``trusted`` has the keys of trusted documents. Raw counts are over all documents, trusted ones over all trusted.
    """
    known = staged(trusted.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct())
    read = docs.select(F.col(key).alias("_key"), words_of(text).alias("words"))
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        marked, raw = read.join(F.broadcast(known.withColumn("_good", F.lit(1))), "_key", "left"), F.count(F.lit(1))
    else:
        # All documents are counted where they are; trusted texts are shuffled to meet their ids and counted once more, with a mark.
        again = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(known, "_key", "left_semi")
        marked = read.withColumn("_good", F.lit(None).cast("int")).union(again.select("_key", words_of("_text"), F.lit(1)))
        raw = F.count_if(F.col("_good").isNull())
    grams = marked.select("_good", F.explode(hashed_ngrams("words")).alias("bucket")).groupBy("bucket")
    counts = grams.agg(raw.alias("raw"), F.count("_good").alias("good"))
    spark = docs.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0)
    every = staged(every)  # as many rows as there are buckets
    totals = every.agg(F.sum("raw").alias("r"), F.sum("good").alias("g"))
    r, g = totals.select("r").scalar(), totals.select("g").scalar()
    ratio = F.log((F.col("good") + 1) / (g + BUCKETS)) - F.log((F.col("raw") + 1) / (r + BUCKETS))
    return [r[0] for r in every.select(ratio, "bucket").orderBy("bucket").collect()]


def judged(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(key, the counts of ``rule_counts``, base_failed, log_ratio, kept) for each document row.

    ``log_ratio`` is the mean over the document's n-grams, 0 for a text without words. ``kept`` needs both:
    not base_failed and log_ratio >= threshold. Null texts have no words and fail; repeated rows each get
    their row; with no trusted documents every ratio tends to the raw one, with its smoothing.
    """
    # A constant of the plan: one parsed array, looked up by position.
    ratios = F.from_json(F.lit(str(log_ratios(docs, trusted, key, text))), "array<double>")
    counted = rule_counts(docs, text, (key,)).withColumn("_g", hashed_ngrams("words"))
    total = F.aggregate("_g", F.lit(0.0), lambda acc, b: acc + F.get(ratios, b))
    counted = counted.withColumn("log_ratio", F.when(F.size("_g") > 0, total / F.size("_g")).otherwise(0.0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.drop("words", "_g").withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("log_ratio") >= threshold))
