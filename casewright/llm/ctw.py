"""Operator 6, language-model scoring by context-tree weighting over bytes.

A text is a sequence of bytes, closed by a byte that UTF-8 never uses. Each byte is eight binary decisions, and
each decision has a tree of contexts: the bytes before it, none up to ``DEPTH``. Every node holds a
Krichevsky-Trofimov estimate; the weighting mixes the estimates of all depths with the exact posterior
weights of all trees, given the counts of the training texts.

Every context of the training texts counts, also one seen once, so the model grows with the corpus and is never in
one place. Texts are read in blocks of about ``BLOCK`` bytes. A block sends its distinct grams; all blocks' counts of a
gram are summed in its bin; the grams that share the last two bytes before are a branch of the tree, weighted in one task.
Above the branches stand at most 256 contexts of one byte, whose sums the driver adds up. The value of each gram
then goes back to the blocks that hold it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm import bins
from casewright.llm.text import byte_codes, mixed, not_space, slices, span_hashes, spans
from casewright.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEPTH = 5
#: Contexts of so many bytes are the roots of the branches.
BRANCH = 2
BLOCK = 1 << 23
PIECE = 1 << 19
#: Branches are weighted together up to so many grams, a larger one alone.
TOGETHER = 100_000
END = 0xFF
CACHE_BITS = 21
IN_BINS = "bin int, block bigint, words boolean, data binary"
#: The end of a text is a token that no word is: its top bit is not set.
END_TOKEN = 12345


def byte_grams(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram, row) of every byte and of the end: the byte in the low 8 bits, the ``DEPTH`` bytes before it above.

    Before a text stand zero bytes.
    """
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    wide = np.zeros(len(body) + rows * (DEPTH + 1), np.uint64)
    wide[np.arange(len(body)) + row * (DEPTH + 1) + DEPTH] = body
    ends = offsets[1:] + np.arange(1, rows + 1) * (DEPTH + 1) - 1
    wide[ends] = END
    real = np.ones(len(wide), bool)
    first = offsets[:-1] + np.arange(rows) * (DEPTH + 1)
    for i in range(DEPTH):
        real[first + i] = False
    gram = wide.copy()
    for d in range(1, DEPTH + 1):
        gram[d:] |= wide[:-d] << np.uint64(8 * d)
    return gram[real], np.repeat(np.arange(rows), np.diff(offsets) + 1)


def gram_counts(training: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n) over all training texts; each task sends what it has counted, combined. The input of ``tree``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            grams = np.concatenate([g for g, _ in held])
            order = np.argsort(grams)
            grams, n = grams[order], np.concatenate([c for _, c in held])[order]
            first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            return grams[first], np.add.reduceat(n, first)

        def sent() -> pa.RecordBatch:
            grams, n = merged()
            return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["gram", "n"])

        for batch in batches:
            for _, body, offsets in slices(batch, text):
                grams = np.sort(byte_grams(body, offsets)[0])
                if len(grams):
                    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
                    held.append((grams[first], np.diff(np.append(first, len(grams)))))
                if len(held) >= 8:
                    held = [merged()]
                    if len(held[0][0]) > 2_000_000:
                        yield sent()
                        held = []
        if held:
            yield sent()

    return training.select(text).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


class Model(NamedTuple):
    """Nodes sorted by key: depth << 56 | context << 8 | bits of the byte so far, with a leading 1."""

    key: np.ndarray
    stop: np.ndarray  # weight of this node's estimate against those below it
    one: np.ndarray  # estimate that the next bit is 1
    rest: np.ndarray  # the same in the pooled leaf of rare contexts below


def log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    small = x
    for _ in range(8):
        shift = shift + np.log(small)
        small = small + 1
    return (small - 0.5) * np.log(small) - small + 0.9189385332046727 + 1 / (12 * small) - 1 / (360 * small**3) + 1 / (1260 * small**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def tree(depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> Model:
    """The model of counted (depth, context, next byte), all in one place; ``values`` is the same in branches. Tests compare with this one."""
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for d in range(DEPTH + 1):
        use = depth == d
        c, s, k = context[use].astype(np.int64), symbol[use].astype(np.int64), n[use].astype(float)
        keys = np.concatenate([c << 8 | 1 << j | s >> (8 - j) for j in range(8)])
        bits = np.concatenate([s >> (7 - j) & 1 for j in range(8)])
        weight = np.tile(k, 8)
        key, at = np.unique(keys, return_inverse=True)
        nodes.append((key, np.bincount(at, weight * (1 - bits), len(key)), np.bincount(at, weight * bits, len(key))))
    keys, stops, ones_, rests = [], [], [], []
    below: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None
    for d in range(DEPTH, -1, -1):
        key, zeros, ones = nodes[d]
        estimate = log_kt(zeros, ones)
        if d == DEPTH:
            weighted, stop, rest = estimate, np.ones(len(key)), np.full(len(key), 0.5)
        else:
            rest0, rest1, split = zeros.copy(), ones.copy(), np.zeros(len(key))
            if below is not None and len(below[0]):
                child, child0, child1, child_weighted = below
                parent = ((child >> 8) & ((1 << 8 * d) - 1)) << 8 | child & 255
                at = np.searchsorted(key, parent)
                rest0 -= np.bincount(at, child0, len(key))
                rest1 -= np.bincount(at, child1, len(key))
                split += np.bincount(at, child_weighted, len(key))
            rest0, rest1 = np.maximum(rest0, 0), np.maximum(rest1, 0)
            split += log_kt(rest0, rest1)
            weighted = np.logaddexp(estimate, split) + np.log(0.5)
            stop, rest = np.exp(np.log(0.5) + estimate - weighted), (rest1 + 0.5) / (rest0 + rest1 + 1)
        below = (key, zeros, ones, weighted)
        keys.append(key | d << 56)
        stops.append(stop)
        ones_.append((ones + 0.5) / (zeros + ones + 1))
        rests.append(rest)
    key = np.concatenate(keys)
    order = np.argsort(key)
    return Model(key[order], *(np.concatenate(x)[order].astype(np.float32) for x in (stops, ones_, rests)))


class Scorer:
    """Log2 probability of grams under a model; what has been worked out is kept in a table of fixed size."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.seen = np.zeros(1 << CACHE_BITS, np.uint64)  # gram + 1
        self.value = np.zeros(1 << CACHE_BITS)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        slot = (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = self.value[slot]
        miss = np.flatnonzero(self.seen[slot] != grams + np.uint64(1))
        if len(miss):
            fresh, at = np.unique(grams[miss], return_inverse=True)
            value = self.worked_out(fresh)
            out[miss] = value[at]
            self.seen[slot[miss]], self.value[slot[miss]] = grams[miss] + np.uint64(1), out[miss]
        return out

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.model.key):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.model.key, key), len(self.model.key) - 1)
        return at, self.model.key[at] == key

    def worked_out(self, grams: np.ndarray) -> np.ndarray:
        grams = grams.view(np.int64)
        symbol, context = grams & 255, grams >> 8
        contexts = [(context & ((1 << 8 * d) - 1)) << 8 | d << 56 for d in range(DEPTH + 1)]
        deepest = np.zeros(len(grams), np.int64)
        for d in range(1, DEPTH + 1):
            on = np.flatnonzero(deepest == d - 1)
            deepest[on[self.find(contexts[d][on] | 1)[1]]] = d
        total = np.zeros(len(grams))
        for j in range(8):
            prefix, bit = 1 << j | symbol >> (8 - j), symbol >> (7 - j) & 1
            one, left, last = np.zeros(len(grams)), np.ones(len(grams)), np.full(len(grams), 0.5)
            on = np.arange(len(grams))
            for d in range(DEPTH + 1):
                on = on[(deepest[on] >= d) & (left[on] > 0)]
                if not len(on):
                    break
                at, known = self.find(contexts[d][on] | prefix[on])
                # A node without counts: all estimates from here on are one half.
                one[on[~known]] += left[on[~known]] * 0.5
                left[on[~known]] = 0
                some, at = on[known], at[known]
                one[some] += left[some] * self.model.stop[at] * self.model.one[at]
                left[some] *= 1 - self.model.stop[at]
                last[some] = self.model.rest[at]
            one += left * last
            total += np.log2(np.clip(np.where(bit == 1, one, 1 - one), 1e-300, 1))
        return total


def packed(grams: np.ndarray, values: np.ndarray) -> bytes:
    """Grams (or none) and a count or a float for each, compressed: steps from gram to gram, bytes of equal weight together."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes() for x in (np.diff(grams.view(np.int64), prepend=0), values)]
    return len(grams).to_bytes(8, "little") + len(values).to_bytes(8, "little") + pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(column: pa.Array | list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(grams, values of the numpy type ``kind``) of all rows of ``packed``."""
    grams, values = [np.zeros(0, np.int64)], [np.zeros(0, kind)]
    width = np.dtype(kind).itemsize
    for data in column if isinstance(column, list) else column.to_pylist():
        n, m = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
        raw = np.frombuffer(pa.decompress(data[16:], 8 * n + width * m, "zstd"), np.uint8)
        grams.append(np.cumsum(np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.int64).reshape(-1)))
        values.append(np.ascontiguousarray(raw[8 * n :].reshape(width, m).T).view(kind).reshape(-1))
    return np.concatenate(grams), np.concatenate(values)


def in_bins(where: np.ndarray, block: int, grams: np.ndarray, values: np.ndarray, words: bool = False) -> pa.RecordBatch:
    """One row (bin, block, words, data) for each bin that occurs in ``where``."""
    order = np.lexsort((grams, where))
    names, first = np.unique(where[order], return_index=True)
    grams, values = grams[order], values[order]
    data = [packed(grams[low:high], values[low:high]) for low, high in zip(first, np.append(first[1:], len(order)))]
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(np.full(len(names), block, np.int64)), pa.array(np.full(len(names), words)), pa.array(data, pa.binary())], names=["bin", "block", "words", "data"])


def gram_bins(grams: np.ndarray, count: int) -> np.ndarray:
    return (mixed(grams.view(np.uint64)) % np.uint64(count)).astype(np.int32)


def summed(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order, and the sum of each."""
    if len(grams) == 0:
        return grams, n
    order = np.argsort(grams)
    grams = grams[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    return grams[first], np.add.reduceat(n[order], first)


def tokens(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, row) of every A-Z-folded word, and of one end per text."""
    start, end, row = spans(body, offsets, not_space())
    words = span_hashes(body, start, end, byte_codes(True)) | np.uint64(1 << 63)
    rows = len(offsets) - 1
    return np.append(words, np.full(rows, END_TOKEN, np.uint64)).view(np.int64), np.append(row, np.arange(rows))


def in_blocks(docs: DataFrame, held: Column, key: str, text: str) -> DataFrame:
    """(block, data), stored: rows (key, _t, _held) of about ``BLOCK`` bytes, or one longer text, compressed."""
    narrow = docs.select(F.col(key), F.col(text).alias("_t"), held.alias("_held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for part in parts:
                    stream.write_batch(part)
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 66], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "data"])

        for batch in batches:
            for rows, body, _ in slices(batch, "_t"):
                if size and size + len(body) > BLOCK:
                    yield block()
                    parts, size = [], 0
                parts.append(batch.slice(rows.start, rows.stop - rows.start))
                size += len(body)
        if parts:
            yield block()

    return staged(narrow.mapInArrow(run, "block bigint, data binary"))


def distinct_of(data: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct grams, and the distinct tokens, of a block, each with its number in texts that train."""
    found: tuple[list, list] = [], []
    merged = lambda parts: summed(*(np.concatenate(x) for x in zip(*parts)))
    for part in pa.ipc.open_stream(data):
        for rows, body, offsets in slices(part, "_t", PIECE):
            trains = ~part.column("_held")[rows].to_numpy(zero_copy_only=False).astype(bool)
            grams, row = byte_grams(body, offsets)
            for parts, (each, owner) in zip(found, ((grams.view(np.int64), row), tokens(body, offsets))):
                for use, times in ((each[trains[owner]], 1), (each[~trains[owner]], 0)):
                    if len(use):
                        use = np.sort(use)
                        first = np.flatnonzero(np.append(True, use[1:] != use[:-1]))
                        parts.append((use[first], np.diff(np.append(first, len(use))) * times))
                if len(parts) >= 12:
                    parts[:] = [merged(parts)]
    return [merged(parts) for parts in found]


def block_counts(blocks: DataFrame) -> DataFrame:
    """(bin, block, words, data): what is distinct in each block, by bins. It is computed where it is used, from stored blocks."""
    count = bins.bin_count(blocks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                for words, (found, n) in zip((False, True), distinct_of(data.as_py())):
                    yield in_bins(gram_bins(found, count), block, found, n, words)

    return blocks.mapInArrow(run, IN_BINS)


def distinct_grams(sent: DataFrame) -> DataFrame:
    """(bin, block, words, data): each gram once with its count, a bin holding whole branches of the tree; rows with
    ``words`` have (0, number) and (1, number of different) tokens in texts that train, to be added up."""
    count = bins.bin_count(sent.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        known, held, size = {False: (none, none), True: (none, none)}, {False: [], True: []}, 0

        def merge() -> None:
            for words, parts in held.items():
                known[words] = summed(*(np.concatenate(x) for x in zip(known[words], *parts)))
                parts.clear()

        for batch in batches:
            for words, data in zip(batch.column("words").to_pylist(), batch.column("data")):
                held[words].append(unpacked([data.as_py()], np.int64))
                size += len(held[words][-1][0])
                if size > max(1_000_000, len(known[False][0])):
                    merge()
                    size = 0
        merge()
        grams, n = known[False]
        if len(grams):
            yield in_bins(gram_bins(grams >> 8 & 0xFFFF, count), -1, grams, n)
            n = known[True][1]
            yield in_bins(np.zeros(2, np.int32), -1, np.arange(2), np.array([n.sum(), (n > 0).sum()], np.int64), True)

    return staged(bins.dealt(sent).mapInArrow(run, IN_BINS))


class Level(NamedTuple):
    """Nodes of one depth; ``at`` has the node of each gram."""

    at: np.ndarray
    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    stop: np.ndarray


def levels(grams: np.ndarray, n: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray, list[Level]]:
    """(order, bit, levels from ``DEPTH`` up to the roots of the branches) for bit ``j`` of the next byte.

    In the order of the bits before and then of the bytes before, nearest first, the grams below every node stand together.
    """
    symbol = grams & 255
    key = 1 << j | symbol >> (8 - j)
    for d in range(1, DEPTH + 1):
        key = key << 8 | grams >> 8 * d & 255
    order = np.argsort(key)
    key, bit, n = key[order], symbol[order] >> (7 - j) & 1, n[order].astype(float)
    zeros, ones, out, at = n * (1 - bit), n * bit, [], np.arange(len(grams))
    for d in range(DEPTH, BRANCH - 1, -1):
        change = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(change)
        at = (np.cumsum(change) - 1)[at]
        zeros, ones, key = np.add.reduceat(zeros, first), np.add.reduceat(ones, first), key[first]
        weighted, stop = mixture(zeros, ones, np.add.reduceat(out[-1].weighted, first) if out else None)
        out.append(Level(at, key, zeros, ones, weighted, stop))
        key = key >> 8
    return order, bit, out


def mixture(zeros: np.ndarray, ones: np.ndarray, split: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, weight of the own estimate) of nodes; ``split`` is the sum of those below, None for leaves."""
    estimate = log_kt(zeros, ones)
    if split is None:
        return estimate, np.ones(len(estimate))
    weighted = np.logaddexp(estimate, split) + np.log(0.5)
    return weighted, np.exp(np.log(0.5) + estimate - weighted)


def whole_bin(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpacked(b.column("data"), np.int64) for b in batches]
    return (np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts])) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def branches(grams: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grams and counts of whole branches, about ``TOGETHER`` at a time."""
    root = grams >> 8 & (1 << 8 * BRANCH) - 1
    order = np.argsort(root, kind="stable")
    root = root[order]
    first = np.append(np.flatnonzero(np.append(True, root[1:] != root[:-1])), len(root)) if len(root) else np.zeros(1, int)
    low = 0
    for high, after in zip(first[1:], np.append(first[2:], first[-1] + TOGETHER + 1)):
        if after - low > TOGETHER or high == len(root):
            yield grams[order[low:high]], n[order[low:high]]
            low = high


def top(grams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sure, left) for each (bits of the byte so far, byte before): what the nodes above the branches add to the
    probability of a 1, and the weight they leave to the branches. Always 65,536 entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n in branches(*whole_bin(batches)):
            roots = [levels(part, n, j)[2][-1] for j in range(8)]
            node, at = np.unique(np.concatenate([r.key for r in roots]) >> 8, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), *[pa.array(np.bincount(at, x, len(node))) for x in (np.concatenate([getattr(r, c) for r in roots]) for c in ("zeros", "ones", "weighted"))]], names=["node", "zeros", "ones", "split"])

    sums = bins.dealt(grams).mapInArrow(run, "node int, zeros double, ones double, split double").groupBy("node")
    table = sums.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("split").alias("split")).toArrow()
    zeros, ones, split = np.zeros((3, 256, 256))
    for out, name in ((zeros, "zeros"), (ones, "ones"), (split, "split")):
        out.reshape(-1)[table["node"].to_numpy()] = table[name].to_numpy()
    weighted, stop = mixture(zeros, ones, split)
    root_zeros, root_ones = zeros.sum(axis=1), ones.sum(axis=1)
    root_stop = mixture(root_zeros, root_ones, weighted.sum(axis=1))[1]
    root = root_stop * (root_ones + 0.5) / (root_zeros + root_ones + 1)
    sure = root[:, None] + (1 - root_stop)[:, None] * stop * (ones + 0.5) / (zeros + ones + 1)
    return sure.reshape(-1), ((1 - root_stop)[:, None] * (1 - stop)).reshape(-1)


def values(grams: DataFrame) -> DataFrame:
    """(bin, block, data): log2 of the probability of each gram, dealt like the grams of blocks."""
    count = bins.bin_count(grams.sparkSession)
    shared = grams.sparkSession.sparkContext.broadcast(top(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sure, rest = shared.value
        found = [(part, logs(part, n, sure, rest)) for part, n in branches(*whole_bin(batches))]
        if found:
            grams, total = (np.concatenate(x) for x in zip(*found))
            yield in_bins(gram_bins(grams, count), -1, grams, total)

    def logs(grams: np.ndarray, n: np.ndarray, sure: np.ndarray, rest: np.ndarray) -> np.ndarray:
        total = np.zeros(len(grams))
        for j in range(8):
            order, bit, nodes = levels(grams, n, j)
            above = nodes[-1].key[nodes[-1].at] >> 8
            one, left = sure[above], rest[above]
            for level in reversed(nodes):
                one += left * (level.stop * (level.ones + 0.5) / (level.zeros + level.ones + 1))[level.at]
                left *= (1 - level.stop)[level.at]
            total[order] += np.log2(np.clip(np.where(bit == 1, one, 1 - one), 1e-300, 1))
        return total.astype(np.float32)

    return bins.dealt(grams).mapInArrow(run, IN_BINS)


def block_values(sent: DataFrame, known: DataFrame) -> DataFrame:
    """(block, words, bin, data): the values of the grams and the counts of the tokens that a block has sent, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, answers = [], []
        for batch in batches:
            answer = pc.equal(batch.column("block"), -1)
            answers.append(unpacked(batch.filter(answer).column("data"), np.float32))
            asked.append(batch.filter(pc.invert(answer)))
        if not asked:
            return
        grams, logs = (np.concatenate(x) for x in zip(*answers))
        order = np.argsort(grams)
        here = {False: (grams[order], logs[order]), True: summed(*whole_bin(b.filter(b.column("words")) for b in asked))}
        for batch in asked:
            for where, block, words, data in zip(*(batch.column(c).to_pylist() for c in ("bin", "block", "words")), batch.column("data")):
                wanted = unpacked([data.as_py()], np.int64)[0]
                found, values = here[words]
                answer = packed(np.zeros(0, np.int64), values[np.searchsorted(found, wanted)])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([words]), pa.array([where], pa.int32()), pa.array([answer], pa.binary())], names=["block", "words", "bin", "data"])

    return bins.dealt(sent.unionByName(known)).mapInArrow(run, "block bigint, words boolean, bin int, data binary")


class Known(Scorer):
    """Log2 probability of grams whose values are at hand."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray) -> None:
        super().__init__(Model(*np.zeros((4, 0))))
        self.grams, self.logs = grams, logs  # in order

    def worked_out(self, grams: np.ndarray) -> np.ndarray:
        return self.logs[np.searchsorted(self.grams, grams.view(np.int64))]


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: tuple[int, int] = (5, 1)) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each document row.

    Rows whose crc32(key) leaves ``held_out[1]`` modulo ``held_out[0]`` do not train; rows with a null key train.
    ``base_score`` is by the smoothed unigrams of the training tokens: A-Z-folded words and one end per text.
    Null texts are empty: one token, the end. Repeated rows each get their row and count as often in training. With no
    training rows every bit costs one bit, and every token has the smoothed probability 1.
    """
    modulus, remainder = held_out
    held = F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))
    blocks = in_blocks(docs, held, key, text)
    sent = block_counts(blocks)
    distinct = distinct_grams(sent)
    totals = [unpacked([r["data"]], np.int64)[1] for r in distinct.where("words").select("data").collect()]  # one row a bin
    n_train, different = (int(sum(x)) for x in zip(*totals)) if totals else (0, 0)
    smooth = float(np.log10(n_train + 0.5 * (different + 1)))
    answers = block_values(sent, values(distinct.where("NOT words")))
    count = bins.bin_count(docs.sparkSession)
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"

    def in_order(found: np.ndarray, answer: np.ndarray) -> np.ndarray:
        """Answers come by bin, and in order within; the result is in the order of ``found``."""
        out = np.empty(len(found), answer.dtype)
        out[np.argsort(gram_bins(found, count), kind="stable")] = answer
        return out

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        data = mine.column("data").to_pylist()[0]
        answers = {words: theirs.filter(pc.equal(theirs.column("words"), words)).sort_by("bin").column("data").to_pylist() for words in (False, True)}
        (grams, _), (known, _) = distinct_of(data)
        score = Known(grams, in_order(grams, unpacked(answers[False], np.float32)[1]))
        counts = in_order(known, unpacked(answers[True], np.int64)[1])
        out = []
        for batch in pa.ipc.open_stream(data):
            for rows, body, offsets in slices(batch, "_t", PIECE):
                grams, row = byte_grams(body, offsets)
                n = np.diff(offsets) + 1
                bits = -np.bincount(row, score(grams), len(n))
                found, owner = tokens(body, offsets)
                c = counts[np.searchsorted(known, found)]
                uses = np.bincount(owner, minlength=len(n))
                base = np.bincount(owner, np.log10(c + 0.5), len(n)) - uses * smooth
                per_row = [uses, np.bincount(owner[c > 0], minlength=len(n)), np.full(len(n), n_train), base, -bits * np.log10(2), bits / n]
                out.append(pa.RecordBatch.from_arrays([batch.column(key)[rows], batch.column("_held")[rows], *map(pa.array, per_row)], names=names))
        return pa.Table.from_batches(out)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
