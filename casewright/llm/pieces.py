"""Operator 3, SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The vocabulary is a public SentencePiece model file, given by path and read on the driver; its trie (bounded by
the vocabulary) is broadcast. White space is marked as in SentencePiece: a space is written as the marker, and
one marker is put in front of the text. Inside the trie the marker is the space byte itself; a marker
character that stands in a text is therefore encoded by byte fallback, and decoding gives back every text
exactly.

The path with the best sum of log scores is found for all distinct stretches of a slice of text together. A
text is cut into stretches wherever no piece holds the two adjacent bytes next to each other: no path can
cross such a place, so the best path of a text is the best paths of its stretches.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from casewright.llm.text import byte_codes, lists, ragged, slices, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: Stretches that a task remembers; beyond it, it begins anew.
REMEMBERED = 800_000
#: What a byte costs beyond the worst piece.
BYTE_PENALTY = 10.0


class Vocabulary(NamedTuple):
    base: np.ndarray  # double array: child of state s by byte c is base[s] + c if check there is s
    check: np.ndarray
    piece: np.ndarray  # piece id that ends in a state, -1 for none
    score: np.ndarray  # log score by piece id
    byte_ids: np.ndarray  # piece id of each byte
    joined: np.ndarray  # joined[a, b]: some piece has byte a next to byte b
    start: np.ndarray  # bytes of a piece: content[start[id]:start[id + 1]]
    content: np.ndarray


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, key index by state) of a trie over distinct non-empty keys; state 0 is the root."""
    children: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    for index, key in enumerate(keys):
        node = 0
        for c in key:
            after = children[node].get(c)
            if after is None:
                after = children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = after
        ends[node] = index
    size = 2 * len(children) + 1024
    used, base = bytearray(size), np.zeros(size, np.int32)
    check, value = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used[0] = 1
    check[0] = 0
    place = [0] * len(children)
    free = tail = 1
    for node in range(len(children)):
        kids = children[node]
        value[place[node]] = ends[node]
        if not kids:
            continue
        codes = sorted(kids)
        # One child fits any free cell; several are put where the last such node went, or behind it.
        if len(codes) == 1:
            while used[free] or free <= codes[0]:
                free += 1
            at = free - codes[0]
        else:
            at = tail
            while any(used[at + c] for c in codes):
                at += 1
            tail = at
        base[place[node]] = at
        for c in codes:
            used[at + c] = 1
            check[at + c] = place[node]
            place[kids[c]] = at + c
        if max(free, tail) + 1024 > size:
            used.extend(bytes(size))
            base = np.concatenate([base, np.zeros(size, np.int32)])
            check, value = (np.concatenate([a, np.full(size, -1, np.int32)]) for a in (check, value))
            size *= 2
    return base, check, value


@functools.lru_cache(2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces of a SentencePiece model with log scores.

    Scores of a unigram model are log probabilities and are taken as they are. A merge model has merge
    ranks instead; by Zipf's law its ranks stand for log probabilities ``-ln(rank)``, up to a constant. Byte pieces
    score ``BYTE_PENALTY`` below the worst piece. Control and unknown pieces are never produced.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    names = [model.id_to_piece(i) for i in ids]
    normal = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    raw = np.array([model.get_score(i) for i in ids])
    ranked = bool(np.all(raw[normal] == np.round(raw[normal])))
    score = np.full(len(names), -np.inf)
    if ranked:
        order = sorted(normal, key=lambda i: (-raw[i], i))
        score[order] = -np.log(np.arange(1, len(order) + 1)) - np.log(np.log(len(order)) + 0.5772)
    else:
        score[normal] = raw[normal]
    content = [b""] * len(names)
    for i in normal:
        content[i] = names[i].replace(MARKER, " ").encode()
    byte_ids = np.zeros(256, np.int32)
    for i in ids:
        if model.is_byte(i):
            byte = int(names[i][3:5], 16)
            byte_ids[byte], content[i] = i, bytes([byte])
            score[i] = score[normal].min() - BYTE_PENALTY
    base, check, value = double_array([content[i] for i in normal])
    piece = np.where(value >= 0, np.array(normal, np.int32)[value], -1).astype(np.int32)
    joined = np.zeros((256, 256), bool)
    for i in normal:
        joined[list(content[i][:-1]), list(content[i][1:])] = True
    start = np.concatenate(([0], np.cumsum([len(c) for c in content])))
    return Vocabulary(base, check, piece, score, byte_ids, joined, start, np.frombuffer(b"".join(content), np.uint8))


class Stretches(NamedTuple):
    """Distinct stretches of a slice: bytes, bounds, and for every occurrence which one and in which text."""

    body: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray  # sorted
    which: np.ndarray
    row: np.ndarray


def marked(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a marker in front of each that is not empty."""
    lengths = np.diff(offsets)
    heads = (lengths > 0).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths + heads)))
    out = np.full(int(bounds[-1]), 32, np.uint8)
    keep = np.ones(len(out), bool)
    keep[bounds[:-1][heads > 0]] = False
    out[keep] = body
    return out, bounds


def stretches(body: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> Stretches:
    if len(body) == 0:
        none = np.zeros(0, np.int64)
        return Stretches(body, none, none, none.view(np.uint64), none, none)
    cut = np.ones(len(body), bool)
    cut[1:] = ~joined[body[:-1], body[1:]]
    cut[offsets[:-1][offsets[:-1] < len(body)]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(body))
    hashes, first, which = np.unique(span_hashes(body, start, end, byte_codes(False)), return_index=True, return_inverse=True)
    return Stretches(body, start[first], end[first], hashes, which, np.searchsorted(offsets, start, "right") - 1)


def some(s: Stretches, use: np.ndarray) -> Stretches:
    """The stretches at ``use``, with the occurrences left as they are."""
    return s._replace(start=s.start[use], end=s.end[use], hashes=s.hashes[use])


class Memory:
    """Number of every stretch that a task has worked out, by hash."""

    def __init__(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def slots_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each hash, indexes of the new ones, which get the next numbers); ``hashes`` is sorted."""
        at = np.searchsorted(self.hashes, hashes)
        near = np.minimum(at, max(len(self.hashes) - 1, 0))
        known = self.hashes[near] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        fresh = np.flatnonzero(~known)
        slots = np.empty(len(hashes), np.int64)
        slots[known] = self.slots[near[known]]
        slots[fresh] = len(self.slots) + np.arange(len(fresh))
        self.hashes = np.insert(self.hashes, at[fresh], hashes[fresh])
        self.slots = np.insert(self.slots, at[fresh], slots[fresh])
        return slots, fresh


class Edges(NamedTuple):
    """Pieces that fit: from position ``left`` to ``right`` (both counted over all stretches, each with one more
    position than bytes), ordered by ``depth``, the bytes from the stretch's start to ``right``."""

    left: np.ndarray
    right: np.ndarray
    piece: np.ndarray
    bound: np.ndarray  # edges of depth d: bound[d]:bound[d + 1]
    first: np.ndarray  # first position of each stretch
    last: np.ndarray


def fitting(s: Stretches, v: Vocabulary) -> Edges:
    """All pieces at all places of the stretches, by walking the trie from every place at once."""
    length = s.end - s.start
    first = np.concatenate(([0], np.cumsum(length + 1)[:-1])).astype(np.int64)
    inside = ragged(np.zeros(len(length), np.int64), length).astype(np.int32)
    source = np.repeat(s.start.astype(np.int32), length) + inside
    left = np.repeat(first.astype(np.int32), length) + inside
    stop = np.repeat(s.end.astype(np.int32), length)
    lefts, rights, pieces, depths = [left], [left + 1], [v.byte_ids[s.body[source]]], [inside + 1]
    state, at, origin, depth = np.zeros(len(source), np.int32), source, left, inside
    step = 0
    while len(at):
        below = v.base[state] + s.body[at]
        ok = v.check[below] == state
        state, at, origin, depth, stop = below[ok], at[ok] + 1, origin[ok], depth[ok], stop[ok]
        step += 1
        hit = v.piece[state] >= 0
        lefts.append(origin[hit])
        rights.append(origin[hit] + step)
        pieces.append(v.piece[state[hit]])
        depths.append(depth[hit] + step)
        on = (at < stop) & (v.base[state] > 0)
        state, at, origin, depth, stop = state[on], at[on], origin[on], depth[on], stop[on]
    depth = np.concatenate(depths)
    right = np.concatenate(rights)
    order = np.argsort(depth.astype(np.int64) << 32 | right)
    bound = np.searchsorted(depth[order], np.arange(1, (int(length.max()) if len(length) else 0) + 2))
    return Edges(np.concatenate(lefts)[order], right[order], np.concatenate(pieces)[order], bound, first, first + length)


def best_paths(s: Stretches, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, count, score): the best path of each stretch, ids one stretch after another.

    Of equal scores the path whose last piece is longest wins, and so on towards the front.
    """
    e = fitting(s, v)
    size = int(e.last[-1]) + 1 if len(e.last) else 0
    score, back = np.full(size, -np.inf), np.zeros(size, np.int64)
    score[e.first] = 0.0
    for low, high in zip(e.bound[:-1], e.bound[1:]):
        if low == high:
            continue
        right, value = e.right[low:high], score[e.left[low:high]] + v.score[e.piece[low:high]]
        at = np.flatnonzero(np.append(True, right[1:] != right[:-1]))
        top = np.maximum.reduceat(value, at)
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(right))))
        tied = np.flatnonzero(value == top[group])
        tied = tied[np.lexsort((e.left[low:high][tied], group[tied]))]  # the leftmost start is the longest piece
        winner = tied[np.append(True, group[tied][1:] != group[tied][:-1])]
        score[right[at]] = top
        back[right[at]] = low + winner
    at, alive = e.last.copy(), np.flatnonzero(e.last > e.first)
    found, owner = [], []
    while len(alive):
        edge = back[at[alive]]
        found.append(e.piece[edge])
        owner.append(alive)
        at[alive] = e.left[edge]
        alive = alive[at[alive] > e.first[alive]]
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(e.last), np.int64), score[e.last]
    owner, ids = np.concatenate(owner)[::-1], np.concatenate(found)[::-1]
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(e.last)), score[e.last]


class Encoder:
    """Encodes slices of text; what it knows about stretches stays in memory up to ``REMEMBERED`` of them."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.forget()

    def forget(self) -> None:
        self.memory = Memory()
        self.ids, self.count, self.score = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)

    def __call__(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, count, log score) of each text."""
        rows = len(offsets) - 1
        s = stretches(*marked(body, offsets), self.v.joined)
        if len(s.which) == 0:
            return np.zeros(0, np.int32), np.zeros(rows, np.int64), np.zeros(rows)
        if len(self.count) > REMEMBERED:
            self.forget()
        slots, fresh = self.memory.slots_of(s.hashes)
        if len(fresh):
            ids, count, score = best_paths(some(s, fresh), self.v)
            self.ids, self.count, self.score = (np.concatenate(p) for p in ((self.ids, ids), (self.count, count), (self.score, score)))
        first = np.concatenate(([0], np.cumsum(self.count)[:-1]))
        which = slots[s.which]
        count = self.count[which]
        out = self.ids[ragged(first[which], count)]
        return out, np.bincount(s.row, count, rows).astype(np.int64), np.bincount(s.row, self.score[which], rows)


def decoded(ids: np.ndarray, count: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts: pieces joined, markers as spaces, the one in front removed."""
    length = (v.start[1:] - v.start[:-1])[ids]
    body = v.content[ragged(v.start[ids], length)]
    row = np.repeat(np.arange(len(count)), count)
    sizes = np.bincount(row, length, len(count)).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    head = np.flatnonzero(sizes > 0)
    drop = head[body[bounds[:-1][head]] == 32]
    body = np.delete(body, bounds[:-1][drop])
    sizes[drop] -= 1
    return body, np.concatenate(([0], np.cumsum(sizes)))


def as_text(body: np.ndarray, offsets: np.ndarray) -> pa.Array:
    data = body.tobytes()
    return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = MODEL, decode: bool = True) -> DataFrame:
    """(key, ids, n_tokens, n_bytes, log_score, decoded) for each document row.

    ``n_bytes`` counts byte-fallback tokens, ``decoded`` is the text read back from the ids (left out without
    ``decode``). A null text has null ids, counts of 0 and a null ``decoded``; an empty text has no ids.
    Repeated rows each get their row; an empty table gives none; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary(path)))  # plain: workers may lack the class
    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, ids array<int>, n_tokens bigint, n_bytes bigint, log_score double" + ", decoded string" * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        encoder = Encoder(v)
        single = np.zeros(len(v.score), bool)
        single[v.byte_ids] = True
        for batch in batches:
            for rows, body, offsets in slices(batch, text):
                ids, count, score = encoder(body, offsets)
                fallback = np.bincount(np.repeat(np.arange(len(count)), count), single[ids], len(count)).astype(np.int64)
                null = batch.column(text)[rows].is_null()
                id_lists = lists(ids, count, pa.int32())
                out = [batch.column(key)[rows], _where_known(id_lists, null), pa.array(count), pa.array(fallback), pa.array(score)]
                if decode:
                    out.append(_where_known(as_text(*decoded(ids, count, v)), null))
                yield pa.RecordBatch.from_arrays(out, names=[key, "ids", "n_tokens", "n_bytes", "log_score", *["decoded"] * decode])

    return narrow.mapInArrow(run, schema)


def _where_known(values: pa.Array, null: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.if_else(null, pa.scalar(None, values.type), values) if pc.any(null).as_py() else values


def decode(rows: DataFrame, ids: str = "ids", key: str = "doc_id", path: str = MODEL) -> DataFrame:
    """(key, text) from encoded rows; null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(tuple(vocabulary(path)))  # plain: workers may lack the class
    narrow = rows.select(key, ids)
    schema = f"`{key}` {narrow.schema[key].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            count = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            texts = as_text(*decoded(column.flatten().to_numpy(zero_copy_only=False), count, Vocabulary(*shared.value)))
            yield pa.RecordBatch.from_arrays([batch.column(key), _where_known(texts, column.is_null())], names=[key, "text"])

    return narrow.mapInArrow(run, schema)
