"""Operator 4, benchmark decontamination: test windows in a broadcast hash set, scanned by training documents.

A window is 13 consecutive words of a benchmark item, or a whole shorter item. Only DataFrame functions.

A window of L words, wherever it stands in a document, covers one whole block of ``(L + 1) // 2`` words that
begins at a multiple of that length. So the scan hashes only such blocks of each document, not every window,
and looks them up in the hash set of all blocks of benchmark windows; no occurrence can be missed. Documents
with a block in the set are then compared window by window, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.text import fresh
from casewright.session import staged

WINDOW = 13
#: Windows and hits are broadcast up to this many rows; beyond it Spark shuffles both sides.
BROADCAST_ROWS = 1_000_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), ASCII_UPPER, ASCII_LOWER)


def words_of(text: str) -> Column:
    """Normalised words; a null text has none."""
    return F.array_remove(F.split(folded(text), NOT_WORD), "")


def _small(df: DataFrame) -> DataFrame:
    """A stored table, broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _positions(words: str, length: int, step: int) -> Column:
    """Word positions (from 1) at which a run of ``length`` words begins, every ``step``."""
    size = F.size(words)
    return F.when(size >= length, F.sequence(F.lit(1), size - length + 1, F.lit(step))).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, length, window): the distinct windows of each item, words joined by a space."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), words_of(text).alias("words")).where("size(words) > 0")
    items = items.withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    windows = items.select("item", "length", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.col("length")), " "))).alias("window"))
    return windows.distinct()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(key, _text, n_words, n_hit, items, hits) for each document row.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` lists the items with such windows
    (as strings, sorted), ``hits`` the covered word positions (from 0, sorted); ``_text`` is a hash that tells
    documents with one key apart. Null and empty texts have no words and no hits; repeated rows each get
    their result; an empty benchmark hits nothing; other columns are not looked at.
    """
    windows = staged(benchmark_windows(benchmark, item, item_text))
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most 13 numbers

    blocks_of = lambda words, length, step: F.transform(
        _positions(words, length, step), lambda i: F.xxhash64(F.lit(length), F.slice(words, i, length))
    )
    parts = [blocks_of("words", (n + 1) // 2, (n + 1) // 2) for n in lengths]
    read = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"), words_of(text).alias("words"))
    blocks = F.array_distinct(F.concat(*parts)) if parts else F.array().cast("array<bigint>")
    scanned = staged(read.select(key, "_text", F.size("words").cast("bigint").alias("n_words"), blocks.alias("blocks")))

    known = windows.withColumn("words", F.split("window", " "))
    each = [
        known.where(F.col("length") == n).select(F.explode(blocks_of("words", (n + 1) // 2, 1)).alias("block")) for n in lengths
    ]
    base = scanned.select(key, "_text", "n_words")
    if not each:
        return base.select("*", F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.array().cast("array<int>").alias("hits"))
    hash_set = each[0]
    for more in each[1:]:
        hash_set = hash_set.union(more)
    hash_set = staged(hash_set.distinct())
    suspects = staged(
        scanned.select(key, "_text", F.explode("blocks").alias("block")).join(_small(hash_set), "block", "left_semi").select(F.col(key).alias("_key"), F.col("_text").alias("_hash")).distinct()
    )
    again = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"), F.col(text).alias("_words"))
    same = again[key].eqNullSafe(F.col("_key")) & (F.col("_text") == F.col("_hash"))
    again = again.join(_small(suspects), same, "left_semi").select(key, "_text", words_of("_words").alias("words"))

    def every_window(n: int) -> Column:
        window = lambda i: F.array_join(F.slice("words", i, n), " ")
        return F.transform(_positions("words", n, 1), lambda i: F.struct(i.alias("at"), F.lit(n).alias("length"), window(i).alias("window")))

    at = [every_window(n) for n in lengths]
    windows_at = again.select(key, "_text", F.explode(F.concat(*at)).alias("w")).select(key, "_text", "w.*")
    found = windows_at.join(_small(windows), ["length", "window"])
    covered = F.flatten(F.collect_set(F.sequence(F.col("at") - 1, F.col("at") + F.col("length") - 2)))
    report = found.groupBy(F.col(key).alias("_key"), F.col("_text").alias("_hash")).agg(
        F.sort_array(F.array_distinct(covered)).alias("hits"), F.sort_array(F.collect_set("item")).alias("items")
    )
    joined = base.join(report, base[key].eqNullSafe(F.col("_key")) & (base["_text"] == F.col("_hash")), "left")
    return joined.select(
        key, "_text", "n_words", F.greatest(F.size("hits"), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
    )


def contaminated() -> Column:
    """The rule on (n_hit, n_words): at least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_hits(text: str, hits: str) -> Column:
    """The text with the words at ``hits`` cut out and everything between words kept."""
    lower = folded(text)
    gaps = F.split(lower, WORD)
    # Positions come from the folded text, which has the same length; the characters from the text itself.
    words = F.filter(F.split(lower, NOT_WORD), lambda w: w != "")
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, i: Column) -> Column:
        gap, word = F.length(F.get(gaps, i)), F.coalesce(F.length(F.get(words, i)), F.lit(0))
        kept = F.when(F.array_contains(F.col(hits), i), gap).otherwise(gap + word)
        piece = F.substring(F.col(text), acc["at"], kept)
        return F.struct((acc["at"] + gap + word).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    return F.array_join(F.aggregate(F.sequence(F.lit(0), F.size(gaps) - 1), zero, step)["out"], "")


def cleaned(docs: DataFrame, benchmark: DataFrame, how: str = "documents", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents (``how="documents"``), or with hit words cut out (``"spans"``).

    All columns are kept as they are, whatever their names. With "spans" a text without words left stays as what is between them.
    """
    report = decontaminate(docs, benchmark, key, text)
    own, of, of_text, places = fresh(docs.columns, "own_hash", "hit_key", "hit_hash", "hit_places")
    named = report.select(F.col(key).alias(of), F.col("_text").alias(of_text), F.col("hits").alias(places), contaminated().alias("_bad"))
    mine = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col(key).eqNullSafe(F.col(of)) & (F.col(own) == F.col(of_text))
    if how == "documents":
        bad = named.where("_bad").select(of, of_text).distinct()
        return mine.join(_small(staged(bad)), same, "left_anti").select(*docs.columns)
    hit = _small(staged(named.where(F.size(places) > 0).select(of, of_text, places).dropDuplicates([of, of_text])))
    cut = F.when(F.col(places).isNull(), F.col(text)).otherwise(without_hits(text, places))
    return mine.join(hit, same, "left").withColumn(text, cut).select(*docs.columns)
