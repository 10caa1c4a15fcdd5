"""Operator 13, conversation prefix trie with a depth-band rollup.

Each distinct sequence of first turns is a node; what a node adds is summed over its subtree. Depths are cut into bands
of ``HEIGHT``. A node is exploded only to its ancestors in its own band and to the band's top, the last node of the
band above; grouping gives sums inside the band and, at each top, the sum of the band below it. The tops form a trie of
their own, ``HEIGHT`` times less deep, which is rolled up in the same way; the completed total of a top is then added to its
ancestors in its band. So no row becomes more than ``HEIGHT + 1`` rows, and a trie of depth d takes log(d) / log(HEIGHT) rounds.

A conversation may have any number of turns: they are numbered by one range partitioning over all conversations, and
the fingerprints of prefixes are running sums in blocks of ``BLOCK`` turns. Texts are never shuffled, only fingerprints.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.operators.ordering import with_global_rank
from casewright.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEIGHT, BLOCK = 8, 1024
#: Ids of 2**12 consecutive numbers are joined to one text before the ids that end at a node meet.
ID_BITS = 12
_HALF = 0xFFFFFFFF


def numbered(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, pos, one, two, chars): turns numbered from 1 inside their conversation, with a 128-bit mark of role and text.

    By ``turn``, null first; turns with equal numbers by their marks, repeated rows count each. A null role or text is empty.
    Rows with a null key belong to no conversation and are left out. Stored.
    """
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    marked = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("_key"), F.col(turn).alias("_turn"), F.xxhash64(F.lit(1), role, text).alias("one"),
        F.xxhash64(F.lit(2), role, text).alias("two"), F.length(text).cast("bigint").alias("chars"),
    )
    # The last key cuts a run of repeated rows.
    order = ["_key", F.col("_turn").asc_nulls_first(), "one", "two", F.monotonically_increasing_id()]
    placed = with_global_rank(marked, order, "_place")
    first = staged(placed.groupBy("_key").agg(F.min("_place").alias("_first")))
    joined = placed.join(first, "_key").withColumn("pos", F.col("_place") - F.col("_first") + 1)
    return staged(joined.select(F.col("_key").alias(key), "pos", "one", "two", "chars"))


def with_shared_start(steps: DataFrame, leader: Column, turns: Column, most: int, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """(steps, members): each conversation begins with the first turns of another one in place of its own.

    ``leader`` is the key of that other conversation and ``turns`` how many turns are taken over (``most`` at most), both from the
    key; if the other has fewer or does not exist, fewer or none are. The conversation's own turns after its first ``turns``
    follow. ``members`` has every key, with turns left or not. Both are stored.
    """
    sizes = staged(steps.groupBy(key).agg(F.max("pos").alias("_n")))
    wanted = sizes.select(key, leader.cast("bigint").alias("_leader"), turns.cast("bigint").alias("_h"))
    heads = steps.where(F.col("pos") <= most).withColumnRenamed(key, "_leader")
    given = sizes.select(F.col(key).alias("_leader"), F.least(F.col("_n"), F.lit(most)).alias("_given"))
    members = staged(wanted.join(given, "_leader", "left").withColumn("_kept", F.least("_h", F.coalesce("_given", F.lit(0)))).drop("_given"))
    taken = members.join(heads, "_leader").where("pos <= _h").select(key, "pos", "one", "two", "chars")
    own = steps.join(members, key).where("pos > _h").select(key, (F.col("pos") - F.col("_h") + F.col("_kept")).alias("pos"), "one", "two", "chars")
    return staged(taken.union(own)), members.select(key)


def _mark(sums: Sequence[Column], depth: Column) -> Column:
    """128 bits that name a prefix: of the sums of its turns' hashes and its length."""
    return F.struct(F.xxhash64(F.lit(5), *sums, depth).alias("a"), F.xxhash64(F.lit(6), *sums, depth).alias("b"))


def _root() -> Column:
    zero = F.lit(0).cast("bigint")
    return _mark([zero] * 4, zero)


def _chains(steps: DataFrame, key: str, within: Sequence[str], height: int) -> DataFrame:
    """Steps (key, pos, node, parent, ...) with ``chain``: the band's top, then the nodes of the band down to the row's own."""
    band = Window.partitionBy(key, *within, F.floor((F.col("pos") - 1) / height)).orderBy("pos")
    upto = band.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.withColumn("chain", F.concat(F.array(F.first("parent").over(upto)), F.collect_list("node").over(upto)))


def _prefixes(steps: DataFrame, key: str, deepest: int, height: int) -> DataFrame:
    """(key, pos, node, parent, chars, chain) of every step, stored."""
    marks = [F.xxhash64(F.lit(seed), "pos", "one", "two") for seed in (3, 4)]
    halves = [half for m in marks for half in (m.bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned(m, 32))]
    names = ["_s0", "_s1", "_s2", "_s3"]
    block = F.floor((F.col("pos") - 1) / BLOCK).alias("_block")
    cut = steps.select(key, "pos", "chars", block, *[h.alias(n) for n, h in zip(names, halves)])
    inside = Window.partitionBy(key, "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if deepest > BLOCK:
        earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sums = cut.groupBy(key, "_block").agg(*[F.sum(n).alias(n) for n in names])
        before = sums.select(key, "_block", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in names])
        cut = cut.join(before, [key, "_block"])
    else:
        cut = cut.withColumns({f"{n}_before": F.lit(0).cast("bigint") for n in names})
    total = cut.withColumns({f"{n}_all": F.sum(n).over(inside) + F.col(f"{n}_before") for n in names})
    node = _mark([F.col(f"{n}_all") for n in names], F.col("pos"))
    parent = _mark([F.col(f"{n}_all") - F.col(n) for n in names], F.col("pos") - 1)
    marked = total.select(key, "_block", "pos", "chars", node.alias("node"), parent.alias("parent"))
    return staged(_chains(marked, key, ["_block"], height).drop("_block"))


def _subtree_sums(nodes: DataFrame, steps: DataFrame, key: str, values: Sequence[str], deepest: int, height: int) -> DataFrame:
    """(node, *values): ``values`` summed over each node's subtree, itself included.

    ``nodes`` (node, chain, *values) has the root with a null chain, ``steps`` (key, pos, node, chain) are the conversations.
    """
    places = nodes.where("chain IS NOT NULL").select(*values, F.posexplode("chain").alias("at", "up"))
    inside = [F.coalesce(F.sum(F.when(F.col("at") > 0, F.col(v))), F.lit(0)).alias(v) for v in values]
    below = [F.coalesce(F.sum(F.when(F.col("at") == 0, F.col(v))), F.lit(0)).alias(f"{v}_below") for v in values]
    sums = staged(places.groupBy(F.col("up").alias("node")).agg(*inside, *below))
    tops_deepest = deepest // height
    lower = sums.select("node", *[F.col(f"{v}_below").alias(v) for v in values])
    root = nodes.where("chain IS NULL")
    if tops_deepest:
        # The tops' own trie: a conversation's steps are every ``height``-th one, and a top's parent is the top of its band.
        thinner = steps.where(F.col("pos") % height == 0).select(key, (F.col("pos") / height).cast("bigint").alias("pos"), "node", F.get("chain", F.lit(0)).alias("parent"))
        thinner = staged(_chains(thinner, key, [], height))
        tops = thinner.groupBy("node").agg(F.first("chain").alias("chain")).union(root.select("node", "chain"))
        tops = staged(tops.join(lower, "node", "left").fillna(0, subset=list(values)))
        totals = _subtree_sums(tops, thinner, key, values, tops_deepest, height)
    else:
        totals = root.select("node").join(lower, "node", "left").fillna(0, subset=list(values))
    totals = staged(totals)
    # What lies below a top counts for the top and its ancestors in its band; below the root, for the root.
    completed = nodes.select("node", "chain").join(totals, "node")
    spread = completed.where("chain IS NOT NULL").select(*values, F.explode(F.slice("chain", 2, height)).alias("node"))
    own = root.select("node", *values).union(completed.where("chain IS NULL").select("node", *values))
    every = sums.select("node", *values).join(nodes.where("chain IS NOT NULL").select("node"), "node", "left_semi")
    parts = every.union(spread.select("node", *values)).union(own)
    return parts.groupBy("node").agg(*[F.sum(v).alias(v) for v in values])


def _ends_hash(ends: DataFrame, key: str) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids (node, key), ascending and joined by commas.

    A hash needs all ids of a node after each other. They are joined in bounded stretches first; one task then reads the stretches
    of a node in order and hashes on, so its memory does not grow with them.
    """
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda x: x.cast("string")), ",")
    stretches = ends.groupBy("node.a", "node.b", F.shiftright(key, ID_BITS).alias("part")).agg(joined.alias("ids"))
    dealt = stretches.repartition("a", "b").sortWithinPartitions("a", "b", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == last:
                    digest.update(b",")
                else:
                    if last:
                        done.append((*last, digest.hexdigest()))
                    last, digest = (a, b), hashlib.sha256()
                digest.update(ids.encode())
            yield _hashes(done)
        if last:
            yield _hashes([(*last, digest.hexdigest())])

    return dealt.mapInArrow(run, "a bigint, b bigint, ends_sha256 string").select(F.struct("a", "b").alias("node"), "ends_sha256")


def _hashes(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["a", "b", "ends_sha256"])


def trie(steps: DataFrame, members: DataFrame, key: str = "conv_id", height: int = HEIGHT) -> DataFrame:
    """(key, depth, parent_<key>, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row a node.

    ``steps`` (key, pos, one, two, chars) have the turns of each conversation numbered gapless from 1, as ``numbered`` gives them;
    ``members`` (key) has each conversation once, also those without turns, which end at the root. A node is named by its
    smallest member and its depth. ``saved_tokens`` sums (n_convs - 1) * chars of the last turn over the subtree.
    Sequences are told apart by 128-bit marks. No members give no rows.
    """
    deepest = steps.agg(F.max("pos")).first()[0] or 0
    rows = _prefixes(steps, key, deepest, height)
    once = lambda c: F.first(c).alias(c)  # noqa: E731  equal in all rows of a node
    found = rows.groupBy("node").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n_convs"), F.first("pos").alias("depth"), once("chars"), once("parent"), once("chain"))
    everyone = members.agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    kind = rows.schema["chain"].dataType
    none = F.lit(None)
    root = everyone.select(
        _root().alias("node"), key, "n_convs", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("chars"),
        none.cast(kind.elementType).alias("parent"), none.cast(kind).alias("chain"),
    )
    nodes = staged(found.union(root))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = staged(nodes.join(children, "node", "left").fillna(0, subset=["n_children"]))
    own = counted.select("node", "chain", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = _subtree_sums(own, rows.select(key, "pos", "node", "chain"), key, ["n_leaves", "saved_tokens"], deepest, height)

    last = rows.select(key, "pos", "node").union(members.select(key, F.lit(0).cast("bigint"), _root()))
    last = last.groupBy(key).agg(F.max(F.struct("pos", "node")).alias("last")).select(key, F.col("last.node").alias("node"))
    hashes = _ends_hash(last, key)
    # Very many nodes may have the root as parent, whose smallest member is one number; they look themselves up instead.
    smallest = everyone.select(key).scalar()
    names = nodes.select(F.col("node").alias("_of"), F.col(key).alias("_name"))
    asked = F.when(F.col("depth") <= 1, F.col("node")).otherwise(F.col("parent"))
    named = counted.withColumn("_of", asked).join(names, "_of", "left").withColumn(
        f"parent_{key}", F.when(F.col("depth") == 1, smallest).when(F.col("depth") > 1, F.col("_name"))
    )
    return named.select("node", key, "depth", f"parent_{key}", "n_convs", "n_children").join(totals, "node").join(hashes, "node", "left").select(
        key, "depth", f"parent_{key}", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
