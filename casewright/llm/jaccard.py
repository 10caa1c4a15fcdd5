"""Operator 2, n-gram Jaccard join by prefixes under several global orders.

Documents become sets of distinct 5-word shingles (64-bit hashes). Two sets with Jaccard similarity of at
least 3/4 share a token among the first ``n - ceil(3n/4) + 1`` tokens of each, in whatever order all tokens are
ranked. The join asks for that in four orders and intersects the answers before it compares any sets:

1. The order of the hashes. Its prefixes, made a little longer so that several tokens must be shared, are
   the only tokens of all documents that are shuffled (in bins). A document of which too few of these
   tokens are found in any other document has no partner and is done.
2. For the rest, three orders by document frequency, rarest first, that break ties differently. Candidates share a
   prefix token in the first, and as many tokens that any other document has as a link needs; of those, only pairs
   that also share one in the second and third are verified.

Copies (equal sets) are one node. Among the documents with one prefix token, a pivot is compared with all others
first, then several more; after that only pairs that are not yet in one component are, so a group of near copies
costs a number of comparisons in proportion to its size, and no link between components is missed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm import bins
from casewright.llm.components import components
from casewright.llm.text import byte_codes, flat, lists, mixed, not_space, slices, span_hashes, spans
from casewright.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
#: Ids of documents to read again are broadcast up to this many rows; beyond it Spark shuffles both sides.
BROADCAST_ROWS = 1_000_000
STAR_ROUNDS = 4
#: Bits of a node's sketch.
SKETCH = 512
#: Pairs per posting up to which all remaining pairs between components are compared at once. Pivots of a token are four times as many in the second round, and again in each later one.
SETTLE = 8
#: Members of a component that a pivot of another one is compared with for each token and round, before the last.
MEMBERS = 16
#: Nodes whose prefixes are cut at once.
CUT_NODES = 2_000
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def shingle_sets(body: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, row = spans(body, offsets, not_space())
    words = span_hashes(body, starts, ends, byte_codes(True))
    bound = np.searchsorted(row, np.arange(len(offsets)))
    joined = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for i in range(WORDS):
        joined += words[i : i + len(joined)] * _STEP[i]
    joined = mixed(joined)
    for low, high in zip(bound[:-1], bound[1:]):
        if high - low >= WORDS:
            values = np.sort(joined[low : high - WORDS + 1])
            yield values[np.append(True, values[1:] != values[:-1])]
        elif high > low:
            yield mixed((words[low:high] * _STEP[: high - low]).sum(keepdims=True) + np.uint64(high - low))
        else:
            yield np.zeros(0, np.uint64)


def slack(n: np.ndarray | int) -> np.ndarray | int:
    """Tokens beyond the first that the longer prefixes of the first order must share."""
    return n // 20


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _read_sets(docs: DataFrame, key: str, text: str, whole: bool, mark: bool = False) -> DataFrame:
    """(key, [text_mark], n, node, copy, tokens): set size, 64-bit node, 128-bit mark of the set, its first tokens or all."""
    narrow = docs.select(key, text, *([F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_mark")] if mark else []))
    kept = [c for c in narrow.columns if c != text]
    schema = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in kept) + ", n bigint, node bigint, copy string, tokens array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, body, offsets in slices(batch, text):
                sizes, nodes, copies, tokens, counts = [], [], [], [], []
                for values in shingle_sets(body, offsets):
                    n = len(values)
                    one = int(mixed(values ^ np.uint64(0x5851F42D4C957F2D)).sum()) ^ n
                    two = int(mixed(values * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)).sum())
                    sizes.append(n)
                    nodes.append(one)
                    copies.append(f"{one:016x}{two:016x}" if n else None)
                    keep = n if whole else min(n, n - (3 * n + 3) // 4 + 1 + slack(n))
                    tokens.append(values[:keep])
                    counts.append(keep)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c)[rows] for c in kept], pa.array(sizes, pa.int64()), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(copies, pa.string()),
                     lists(_signed(np.concatenate(tokens)), np.array(counts), pa.int64())],
                    names=[*kept, "n", "node", "copy", "tokens"],
                )

    return narrow.mapInArrow(run, schema)


def _in_bins(sets: DataFrame) -> DataFrame:
    """Tokens of (node, tokens) rows, dealt so that all of a token meet."""
    count = bins.bin_count(sets.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, counts = flat(batch.column("tokens"))
            if len(tokens):
                owners = np.repeat(batch.column("node").to_numpy(), counts)
                yield bins.packed(owners, tokens, np.zeros(len(tokens), np.int32), count)

    return bins.dealt(sets.select("node", "tokens").mapInArrow(run, bins.SCHEMA))


def _distinct_entries(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, token, how many owners the token has), each pair once, ordered by token."""
    owners, tokens, _ = bins.entries(batches)
    if len(tokens) == 0:
        return owners, tokens, tokens
    order = np.lexsort((owners, tokens))
    owners, tokens = owners[order], tokens[order]
    new = np.append(True, (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1]))
    owners, tokens = owners[new], tokens[new]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    sizes = np.diff(np.append(first, len(tokens)))
    return owners, tokens, np.repeat(sizes, sizes)


def _shared_counts(sets: DataFrame) -> DataFrame:
    """(node, shared): how many of a node's tokens another node has too; one row for each node.

    A node has tokens in most bins, so what the bins count goes on packed, one row from each bin of tokens to each bin of nodes.
    """
    count = bins.bin_count(sets.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, _, df = _distinct_entries(batches)
        nodes, shared = np.unique(owners[df > 1], return_counts=True)
        if len(nodes):
            yield bins.packed(nodes, shared.astype(np.int64), np.zeros(len(nodes), np.int32), count, by_owner=True)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, shared, _ = bins.entries(batches)
        nodes, place = np.unique(owners, return_inverse=True)
        total = np.zeros(len(nodes), np.int64)
        np.add.at(total, place, shared)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(total)], names=["node", "shared"])

    return bins.dealt(_in_bins(sets).mapInArrow(counted, bins.SCHEMA)).mapInArrow(summed, "node bigint, shared bigint")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(node, n, s, k, p1, p2, p3): prefixes under three orders by frequency, without tokens that no other node has.

    ``s`` counts the tokens that another node has: a bound for what the node has in common with any. ``k`` is a sketch of these
    tokens, one of ``SKETCH`` bits for each: a bit that another node's sketch does not have is a token that it does not have.

    Tokens of one node only are the rarest, so they come first in each order and use up the prefix.
    The frequencies go back to the nodes packed too, one row from each bin of tokens to each bin of nodes. The sizes of the sets
    go with them, as entries of frequency zero, so that what a node has gathered need not be shuffled again to learn its size.
    """
    count = bins.bin_count(sets.sparkSession)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, tokens, df = _distinct_entries(batches)
        use = df > 1
        owners, tokens, df = owners[use], tokens[use], df[use]
        order = np.argsort(owners, kind="stable")
        if len(order):
            yield bins.packed(owners[order], tokens[order], df[order].astype(np.int32), count, by_owner=True)

    def sizes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = batch.column("n").to_numpy()
                yield bins.packed(batch.column("node").to_numpy(), n, np.zeros(len(n), np.int32), count, by_owner=True)

    found = _in_bins(sets).mapInArrow(frequencies, bins.SCHEMA)
    found = bins.dealt(found.union(sets.select("node", "n").mapInArrow(sizes_of, bins.SCHEMA)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, every, df = bins.entries(batches)
        # A node's size, then its tokens.
        order = np.lexsort((df, owners))
        owners, every, df = owners[order], every[order], df[order]
        first = np.flatnonzero(df == 0)
        ends = np.append(first[1:], len(owners))
        for low in range(0, len(first), CUT_NODES):
            use = slice(low, low + CUT_NODES)
            nodes, n, counts = owners[first[use]], every[first[use]], ends[use] - first[use] - 1
            here = slice(first[low], ends[min(low + CUT_NODES, len(first)) - 1])
            token = df[here] > 0
            tokens, f_all = every[here][token], df[here][token]
            bound = np.concatenate(([0], np.cumsum(counts)))
            out: list[list[np.ndarray]] = [[], [], []]
            used, sketches = [], np.zeros((len(n), SKETCH // 64), np.uint64)
            place = mixed(tokens.view(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(SKETCH)
            owner = np.repeat(np.arange(len(n)), counts)
            np.bitwise_or.at(sketches, (owner, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
            for i, size in enumerate(n):
                t, f = tokens[bound[i] : bound[i + 1]], f_all[bound[i] : bound[i + 1]]
                room = size - (3 * size + 3) // 4 + 1 - (size - len(t))
                used.append(max(0, room))
                if room > 0:
                    u = t.view(np.uint64)
                    for k, ranks in enumerate(((t, f), (_signed(mixed(u)), np.log2(f).astype(int)), (_signed(mixed(~u)), np.log2(f).astype(int)))):
                        out[k].append(t[np.lexsort(ranks)[:room]])
            if sum(used):
                keep = np.array(used) > 0
                sizes = np.array([u for u in used if u > 0])
                sizes = np.minimum(sizes, [len(x) for x in out[0]])
                columns = [lists(np.concatenate(o), sizes, pa.int64()) for o in out]
                own = [pa.array(x[keep].astype(np.int64)) for x in (nodes, n, counts)]
                mine = sketches[keep]
                own.append(lists(_signed(mine.ravel()), np.full(len(mine), SKETCH // 64), pa.int64()))
                yield pa.RecordBatch.from_arrays([*own, *columns], names=["node", "n", "s", "k", "p1", "p2", "p3"])

    return found.mapInArrow(cut, "node bigint, n bigint, s bigint, k array<bigint>, p1 array<bigint>, p2 array<bigint>, p3 array<bigint>")


def _may_link(n: str, s: str, k: str, r: str, other_n: str, other_s: str, other_k: str, other_r: str) -> Column:
    """A link needs 7 * common >= 3 * (n + other n); what is common is among the shared tokens of both, without those whose bit the other lacks.

    At the first prefix token that two nodes have in common, all that is common is from there on, among the ``r`` last tokens of both.
    So a pair that fails by ``r`` at some other common token is not lost: it does not fail at the first one, if it is a link.
    """
    lacking = lambda one, two: F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda a, b: a + b)
    enough = lambda common: 7 * common >= 3 * (F.col(n) + F.col(other_n))
    sketched = F.least(F.col(s) - lacking(k, other_k), F.col(other_s) - lacking(other_k, k))
    return F.when(enough(F.least(r, other_r)), enough(sketched)).otherwise(F.lit(False))


def _with_both(pairs: DataFrame, nodes: DataFrame, *cols: str) -> DataFrame:
    """Pairs (a, b) with columns of both nodes; nodes that are in no pair are not shuffled, while the pairs are few enough to tell."""
    side = lambda name: nodes.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in cols])
    if pairs.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return pairs.join(side("a"), "a").join(side("b"), "b")
    used = F.broadcast(pairs.select("b").distinct())
    return side("a").join(F.broadcast(pairs), "a").join(side("b").join(used, "b", "left_semi"), "b")


def _links(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b), those that pass the other orders and then the comparison of the sets."""
    near = _with_both(staged(pairs), prefixes, "p2", "p3")
    near = near.where(F.arrays_overlap("a_p2", "b_p2") & F.arrays_overlap("a_p3", "b_p3")).select("a", "b")
    full = _with_both(staged(near), sets, "n", "tokens")
    # 100 * common >= 75 * union, where union = n_a + n_b - common.
    return full.where(7 * F.size(F.array_intersect("a_tokens", "b_tokens")) >= 3 * (F.col("a_n") + F.col("b_n"))).select("a", "b")


def _postings(prefixes: DataFrame) -> DataFrame:
    """(node, n, s, k, r, token): who has which prefix token, and how many of its tokens are not before it in the first order by frequency.

    Entries with too small an ``r`` for even the smallest set with that token are left out. Of tokens that the same nodes still have,
    the first in that order stands for all: in the set of each of them it has the largest ``r``.
    """
    every = prefixes.select("node", "n", "s", "k", F.posexplode("p1").alias("at", "token"))
    every = every.select("node", "n", "s", "k", (F.col("s") - F.col("at")).alias("r"), "token")
    for _ in range(2):  # the smallest set may itself be left out the first time
        least = every.groupBy("token").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
        every = staged(every.join(least, "token").where("7 * r >= 3 * (n + least)").select(*every.columns))
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), "node") % (1 << 40))
    owners = every.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.sum("r").alias("r"), mark(1).alias("one"), mark(2).alias("two")).where("k > 1")
    kept = staged(owners.groupBy("k", "one", "two").agg(F.max_by("token", "r").alias("token")).select("token"))
    return staged(every.join(kept, "token"))


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after new links; only the components that they touch are worked on."""
    if labels is None:
        return staged(components(links))
    side = lambda name: labels.select(F.col("node").alias(name), F.col("component").alias(f"c{name}"))
    between = links.join(side("a"), "a", "left").join(side("b"), "b", "left")
    moved = staged(components(between.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))))
    old = labels.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    new = moved.join(labels.select("node"), "node", "left_anti")
    return staged(old.select("node", F.coalesce("to", "component").alias("component")).union(new.select("node", "component")))


def _linked(sets: DataFrame) -> DataFrame:
    """(node, component) for every node with a link."""
    prefixes = staged(_prefixes(sets))
    postings = _postings(prefixes)
    ordered = lambda df: df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    labels = None
    for turn in range(STAR_ROUNDS):
        now = postings.withColumn("component", F.col("node"))
        if labels is not None:
            now = staged(postings.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
        per = now.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
        top = per.groupBy("token").agg(F.max_by("component", F.struct("k", "component")).alias("top"), F.max("k").alias("most"), F.sum("k").alias("all"), F.count(F.lit(1)).alias("parts"))
        top = staged(top.where("parts > 1"))
        entries, cost = top.agg(F.sum("all"), F.sum(F.col("all") * (F.col("all") - F.col("most")))).first()
        if not entries:
            break
        rest = now.join(top.select("token", "top"), "token")
        renamed = {"node": "a", "component": "ca", "n": "an", "s": "as", "k": "ak", "r": "ar"}
        strays = rest.where("component <> top").select("token", *[F.col(c).alias(new) for c, new in renamed.items()])
        possible = _may_link("n", "s", "k", "r", "an", "as", "ak", "ar")
        last = cost <= SETTLE * entries or turn == STAR_ROUNDS - 1
        if last:
            pairs = strays.join(rest.select("token", "node", "component", "n", "s", "k", "r"), "token").where((F.col("ca") != F.col("component")) & possible)
        else:
            # Pivots for each token, one from each of some components outside its largest: first one that joins most of a group, then
            # several, four times as many each time. They are the first in an order of all nodes, so tokens of one group mostly have the same ones.
            most = 1 if turn == 0 else SETTLE << 2 * turn
            each = strays.groupBy("token", "ca").agg(F.min_by(F.struct("a", "an", "as", "ak", "ar"), F.xxhash64("a", F.lit(turn))).alias("p"))
            place = F.row_number().over(Window.partitionBy("token").orderBy(F.xxhash64("ca", F.lit(turn)), "ca"))
            pivot = staged(each.withColumn("place", place).where(F.col("place") <= most).select("token", "ca", "p.*"))
            if labels is not None:
                # One link is enough to join a pivot to a component, so it meets some of its members, others for each token and round.
                place = F.row_number().over(Window.partitionBy("token", "component").orderBy(F.xxhash64("node", "token", F.lit(turn)), "node"))
                rest = rest.withColumn("place", place).where(F.col("place") <= MEMBERS).drop("place")
            pairs = rest.join(pivot, "token").where((F.col("component") != F.col("ca")) & possible)
        labels = _joined(labels, staged(_links(ordered(pairs.select("a", F.col("node").alias("b"))), prefixes, sets)))
        if last:
            break
    return labels if labels is not None else postings.select("node", F.col("node").alias("component")).where("false")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", marks: bool = False) -> DataFrame:
    """(key, n_shingles, component_id) for each document row; the id is the smallest key reachable by links.

    With ``marks`` also text_mark, a hash that tells texts under one key apart, and group_mark, equal in all rows of a component
    and null for rows that are linked with nothing and have no key or no words.

    A text without words is linked with nothing and has its own key. Rows with a null key get a null
    component and link nothing. Repeated rows are copies. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    read = staged(_read_sets(docs, key, text, whole=False, mark=marks))
    usable = read.where(F.col("copy").isNotNull() & F.col(key).isNotNull())
    classes = staged(usable.groupBy("copy", "node", "n").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("members")))
    shared = _shared_counts(usable)
    smallest = F.ceil(F.col("n") * 3 / 4)
    enough = F.col("shared") >= F.least(F.lit(1) + F.floor(smallest / 20), F.col("n"))
    suspects = staged(classes.join(shared, "node").where(enough).select("first", "copy"))
    again = suspects.select(F.col("first").alias(key)).distinct()
    again = F.broadcast(again) if suspects.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else again
    sets = staged(_read_sets(docs.select(key, text).join(again, key, "left_semi"), key, text, whole=True).where("n > 0").select("node", "n", "tokens").dropDuplicates(["node"]))
    linked = _linked(sets)
    grouped = classes.join(linked, "node", "left").withColumn("group", F.coalesce("component", "node"))
    smallest_key = staged(grouped.groupBy("group").agg(F.min("first").alias("component_id")))
    grouped = grouped.join(smallest_key, "group")
    # Only copies and linked documents need to look their component up.
    looked_up = staged(grouped.where("members > 1 OR component IS NOT NULL").select("copy", "component_id", F.col("group").alias("_group")))
    more = ["text_mark"] if marks else []
    rows = read.select(key, *more, F.col("n").alias("n_shingles"), "copy", "node")
    named = F.col(key).isNotNull()
    marked = [F.when(named, F.coalesce("_group", "node")).alias("group_mark")] if marks else []
    none = [F.lit(None).cast("bigint").alias("group_mark")] if marks else []
    out = rows.where("copy IS NOT NULL").join(looked_up, "copy", "left")
    out = out.select(key, "n_shingles", F.when(named, F.coalesce("component_id", key)).alias("component_id"), *more, *marked)
    return out.union(rows.where("copy IS NULL").select(key, "n_shingles", F.col(key).alias("component_id"), *more, *none))
