"""Operator 1, sharding by sampled splitters: size-weighted key samples, quantile cuts, overfull ranges divided.

Only DataFrame functions; nothing but the sampled cuts (a parameter bounds them) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import staged

FAN = 32


def byte_size(text: str) -> Column:
    """UTF-8 bytes plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def _cuts(keys: DataFrame, total: int, ranges: int, draws: int) -> list[int]:
    """Range boundaries: quantiles of keys drawn in proportion to size, about ``draws`` of them.

    Whether and how often a row is drawn depends on the row alone, so a task that runs again draws the same.
    """
    chance = F.pmod(F.xxhash64("_at", "_tie"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = F.floor(F.col("size") * F.lit(draws / total) + chance).cast("int")
    drawn = keys.select("_at", times.alias("times")).where("times > 0").select("_at", F.explode(F.sequence(F.lit(1), "times")))
    cuts = drawn.agg(F.percentile_approx("_at", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts")).first()[0]
    return sorted(set(cuts or []))


def _range_of(key: str, cuts: list[int]) -> Column:
    """Number of cuts up to the key, found in two steps of about ``FAN`` comparisons."""
    if not cuts:
        return F.lit(0)
    as_array = lambda values: F.from_json(F.lit(str(values)), "array<bigint>")
    upto = lambda values: F.size(F.filter(values, lambda x: x <= F.col(key)))
    coarse = upto(as_array(cuts[::FAN]))
    inner = F.slice(as_array(cuts), (coarse - 1) * FAN + 1, FAN)
    return F.when(F.col(key) < cuts[0], 0).otherwise((coarse - 1) * FAN + upto(inner))


def _pieces(size: Column, rows: Column, most_bytes: int, most_rows: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / most_bytes), F.ceil(rows / most_rows)).cast("int")


def assign_shards(
    records: DataFrame, text: str = "text", key: str = "doc_id", shards: int = 16, carry: Sequence[str] = (),
    ranges: int = 1024, draws: int = 32_768, part_bytes: int = 64 << 20, part_rows: int = 1 << 20,
) -> DataFrame:
    """(key, size, text_crc32, *carry, shard, slot): shards of nearly equal bytes, slots gapless from 0.

    Records are ordered by a hash of the text, cut into ``ranges`` at sampled quantiles, and each range is
    counted exactly. A range over twice its share (or over ``part_bytes`` / ``part_rows``) is divided by the
    text, and what is still overfull, that is one text with very many copies, by the record. Shards are
    consecutive stretches of this order: a text with all its copies goes where its middle lies in the running
    bytes, so they share a shard. Only copies that weigh more than a shard together are placed one by one.

    Null texts have size 1 and the checksum of an empty text; repeated rows each get a slot; rows with
    equal text and key are ordered by ``carry``; an empty table gives no rows. Other columns are ignored
    unless carried; ``carry`` may not name an output column.
    """
    taken = {"size", "text_crc32", "shard", "slot"} & {key, *carry}
    if taken:
        raise ValueError(f"rename {sorted(taken)} first")
    content = F.coalesce(F.col(text), F.lit(""))
    keys = staged(
        records.select(
            F.col(key), byte_size(text).alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"), *carry,
            F.xxhash64(content).alias("_at"), F.xxhash64(F.lit(7), F.col(key), *carry).alias("_tie"),
        )
    )
    total, count = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 1
    most_bytes, most_rows = min(2 * total // ranges + 1, part_bytes), min(2 * count // ranges + 1, part_rows)

    ranged = keys.withColumn("_range", _range_of("_at", _cuts(keys, total, ranges, draws)))
    weights = [F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")]
    pieces = _pieces(F.col("_bytes"), F.col("_rows"), most_bytes, most_rows)
    # One row per range, at most ``ranges`` of them.
    divided = ranged.groupBy("_range").agg(*weights).select("_range", pieces.alias("_n"))
    parts = ranged.join(F.broadcast(divided), "_range").withColumn("_part", F.pmod(F.xxhash64(F.lit(1), "_at"), "_n").cast("int")).drop("_n")
    overfull = parts.groupBy("_range", "_part").agg(*weights).select("_range", "_part", pieces.alias("_n")).where("_n > 1")
    salt = F.pmod(F.xxhash64(F.lit(2), "_tie"), F.coalesce("_n", F.lit(1))).cast("int")
    parts = staged(parts.join(staged(overfull), ["_range", "_part"], "left").withColumn("_salt", salt).drop("_n"))

    # Offsets in two steps: over ranges (at most ``ranges`` rows in the one task), then inside each range.
    place = ["_range", "_part", "_salt"]
    sums = parts.groupBy(*place).agg(*weights)
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over_ranges = Window.orderBy("_range")
    per_range = sums.groupBy("_range").agg(F.sum("_bytes").alias("_b"), F.sum("_rows").alias("_r"))
    per_range = per_range.select("_range", before(over_ranges, "_b").alias("_b0"), before(over_ranges, "_r").alias("_r0"))
    inside = Window.partitionBy("_range").orderBy("_part", "_salt")
    part = Window.partitionBy("_range", "_part")
    offsets = sums.join(F.broadcast(per_range), "_range").select(
        *place, "_bytes", (F.col("_b0") + before(inside, "_bytes")).alias("_b0"), (F.col("_r0") + before(inside, "_rows")).alias("_r0")
    )
    # What was divided by the record is one text; it is placed as a whole.
    offsets = offsets.select(
        *place, "_b0", "_r0", F.min("_b0").over(part).alias("_p0"), F.sum("_bytes").over(part).alias("_pw"), (F.count(F.lit(1)).over(part) > 1).alias("_divided")
    )
    run = Window.partitionBy(*place).orderBy("_at", "_tie")
    copies = Window.partitionBy(*place, "_at")
    placed = (
        parts.join(staged(offsets), place)
        .withColumn("_start", F.col("_b0") + before(run, "size"))
        .withColumn("_pos", F.col("_r0") + F.row_number().over(run) - 1)
        .withColumn("_first", F.when(F.col("_divided"), F.col("_p0")).otherwise(F.min("_start").over(copies)))
        .withColumn("_weight", F.when(F.col("_divided"), F.col("_pw")).otherwise(F.sum("size").over(copies)))
    )
    together = F.col("_weight") * shards <= total
    middle = F.when(together, 2 * F.col("_first") + F.col("_weight")).otherwise(2 * F.col("_start") + F.col("size"))
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * total))).cast("int")
    placed = staged(placed.select(key, "size", "text_crc32", *carry, shard.alias("shard"), "_pos"))
    first = placed.groupBy("shard").agg(F.min("_pos").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        key, "size", "text_crc32", *carry, "shard", (F.col("_pos") - F.col("_first")).cast("bigint").alias("slot")
    )


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Write carried records as one folder per shard, each in ``files_per_shard`` files by slot."""
    spread = placed.withColumn("_file", F.pmod("slot", F.lit(files_per_shard)))
    spread.repartition("shard", "_file").drop("_file").write.partitionBy("shard").parquet(path)
