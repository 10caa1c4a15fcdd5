"""Operator 5, chat formatting by event-sourced reconstruction.

A log holds, for each conversation, events in sequence: a message starts, deltas are streamed, a message
is edited or generated again. They are folded into the final messages and rendered with a template whose
marks cannot be confused with message text. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PART_TURNS = 64
EVENTS = "conv_id, turn, copy, seq, kind, role, text"


def escaped(text: Column, role: bool = False) -> Column:
    """Text without ``<|``; reversible, because every ``&`` is written as ``&amp;``."""
    text = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))
    return F.replace(text, F.lit("\n"), F.lit("&#10;")) if role else text


def unescaped(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("&#10;"), F.lit("\n")) if role else text
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def events_of(turns: DataFrame, chunk: int = 400) -> DataFrame:
    """Stored turns as the log that would have produced them: a start, then deltas of up to ``chunk`` characters.

    Rows with equal (conv_id, turn) are separate messages, ordered by role and text.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("copy", F.row_number().over(order))
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / chunk).cast("int")), lambda i: F.substring("text", i * chunk + 1, F.lit(chunk)))
    start = F.struct(F.lit("start").alias("kind"), F.lit("").alias("text"))
    deltas = F.transform(pieces, lambda p: F.struct(F.lit("delta").alias("kind"), p.alias("text")))
    log = rows.select("conv_id", "turn", "copy", "role", F.posexplode(F.concat(F.array(start), deltas)).alias("seq", "e"))
    return log.select("conv_id", "turn", "copy", F.col("seq").cast("bigint").alias("seq"), "e.kind", "role", "e.text")


def folded(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, copy, role, text).

    ``start`` opens a message, ``delta`` appends, ``edit`` replaces the text so far, ``regenerate`` empties
    the message and drops the messages of later turns that were started before it. Events of one message
    with equal ``seq`` are ordered by kind and text. Null text is empty; a null role takes the last known
    one, else it is empty.

    Messages are folded one by one, so a long conversation is not gathered here; what a regeneration drops
    is found from one running maximum per block of turns and one over the blocks.
    """
    message = ["conv_id", "turn", "copy"]
    reset = F.when(F.col("kind").isin("start", "edit", "regenerate"), F.col("seq"))
    grouped = events.groupBy(*message).agg(
        F.max(reset).alias("_reset"), F.min("seq").alias("_start"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("_again"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.sort_array(F.collect_list(F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")))).alias("_log"),
    )
    live = F.filter("_log", lambda e: (e["seq"] >= F.coalesce("_reset", "_start")) & (e["kind"] != "regenerate"))
    messages = grouped.select(
        *message, F.coalesce("role", F.lit("")).alias("role"), F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
        "_start", "_again", F.floor(F.col("turn") / 1024).alias("_block"),
    )
    blocks = messages.groupBy("conv_id", "_block").agg(F.max("_again").alias("_b"))
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_k"), F.max("_b").over(earlier).alias("_b"))
    blocks = blocks.where("_b IS NOT NULL")
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("_block").eqNullSafe(F.col("_k"))
    dropped = F.greatest("_in", "_b") > F.col("_start")
    return messages.withColumn("_in", F.max("_again").over(inside)).join(blocks, same, "left").where(~F.coalesce(dropped, F.lit(False))).select(*message, "role", "text")


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): up to ``PART_TURNS`` turn numbers of a conversation per row.

    ``loss`` lists the [start, end) code points of assistant text inside ``formatted``. The parts of a
    conversation, in order, are its full text; a long conversation is never one row.
    """
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), True), F.lit("\n"))
    body = escaped(F.col("text"))
    turn = F.struct(
        "turn", "copy", F.concat(head, body, F.lit(CLOSE)).alias("all"), F.length(head).alias("skip"), F.length(body).alias("chars"), (F.col("role") == "assistant").alias("loss")
    )
    parts = messages.groupBy("conv_id", F.floor(F.col("turn") / PART_TURNS).alias("part")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + t["skip"]
        span = F.struct(start.alias("start"), (start + t["chars"]).alias("end"))
        return F.struct(
            (acc["at"] + F.length(t["all"])).alias("at"), F.when(t["loss"], F.concat(acc["loss"], F.array(span))).otherwise(acc["loss"]).alias("loss")
        )

    return parts.select(
        "conv_id", "part", F.size("t").alias("n_turns"), F.array_join(F.transform("t", lambda t: t["all"]), "").alias("formatted"),
        F.aggregate("t", zero, add)["loss"].alias("loss"),
    )


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, turns: array of role and text, masked: array of assistant texts) from rendered rows."""
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda s: s != "")

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(1), F.length(piece) - len(CLOSE))
        cut = F.instr(inner, "\n")
        return F.struct(
            unescaped(F.substring(inner, F.lit(1), cut - 1), True).alias("role"), unescaped(F.substring(inner, cut + 1, F.length(inner))).alias("text")
        )

    masked = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return parts.select("conv_id", "part", "formatted", F.transform(pieces, turn).alias("turns"), masked.alias("masked"))


def format_chats(events: DataFrame) -> DataFrame:
    """Fold a log and render it; see ``folded`` and ``rendered``. An empty log gives no rows."""
    return rendered(folded(events))
