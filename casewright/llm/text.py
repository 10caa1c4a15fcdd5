"""Arrow text columns as flat UTF-8 bytes, and hashes of byte spans, computed on whole arrays.

Tasks work through a batch in slices of about ``SLICE`` bytes, so their memory does not grow with the
batch; one text longer than that is a slice of its own.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Workers need not have this package installed: functions that run in tasks are shipped by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = 500_000
_ODD = 0x9E3779B97F4A7C15
#: Span hashes are polynomials over the whole numbers modulo this prime, at two points.
_PRIME = (1 << 31) - 1
_POINTS = (1_203_871_057, 719_393_819)
_POWERS: dict[int, np.ndarray] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``; a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows that hold about ``size`` bytes of text."""
    body, offsets = utf8(batch.column(column))
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield slice(low, high), body[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def mixed(h: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values (one to one)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def byte_codes(fold: bool) -> np.ndarray:
    """A 64-bit code for each byte; with ``fold``, A-Z have the codes of a-z."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    if fold:
        codes[65:91] = codes[97:123]
    return codes


def _powers(point: int, n: int) -> np.ndarray:
    """Powers of a number modulo the prime, by doubling."""
    if len(_POWERS.get(point, ())) < n:
        size = max(n, SLICE + 1)
        powers, known = np.ones(size, np.uint32), 1
        while known < size:
            more = min(known, size - known)
            factor = np.uint64(pow(point, known, _PRIME))
            powers[known : known + more] = powers[:more].astype(np.uint64) * factor % np.uint64(_PRIME)
            known += more
        _POWERS[point] = powers
    return _POWERS[point]


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``body[start:end]``, from two running sums over the bytes.

    A span is read as a polynomial over a prime field, at two points, so unequal spans of n bytes agree in at most
    n points of 2**31 in each; powers of two as modulus would let unequal spans of two letters agree at every point.
    """
    prime, parts = np.uint64(_PRIME), []
    for number, point in enumerate(_POINTS):
        up, down = _powers(point, len(body) + 1), _powers(pow(point, -1, _PRIME), len(body) + 1)
        own = (codes >> np.uint64(33 * number)) % prime
        terms = own[body] * up[: len(body)]
        total = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((terms & prime) + (terms >> np.uint64(31)), out=total[1:])
        parts.append((total[ends] - total[starts]) % prime * down[starts] % prime)
    return mixed((parts[0] | (parts[1] << np.uint64(31))) ^ mixed((ends - starts).astype(np.uint64)))


def spans(body: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the longest runs of bytes with ``inside[byte]``; a run never leaves its text."""
    if len(body) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    mask = inside[body]
    edge = offsets[:-1][offsets[:-1] < len(body)]
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    before[edge] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    after[edge[edge > 0] - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def not_space() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return inside


def word_like() -> np.ndarray:
    """Bytes of ASCII letters and digits and of every character beyond ASCII."""
    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return inside


def crc_of_id(ids: list) -> np.ndarray:
    """crc32 of each id written as text; -1 for a null id."""
    return np.array([-1 if i is None else zlib.crc32(str(i).encode()) for i in ids], np.int64)


def row_keys(ids: list, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of (id, text): equal for repeated rows, different for other texts under one id."""
    text = span_hashes(body, offsets[:-1], offsets[1:], byte_codes(False))
    known = np.array([0 if i is None else (int(i) * 2 + 1) & (2**64 - 1) for i in ids], np.uint64)
    return mixed(text ^ mixed(known)).view(np.int64)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores put before it until no column has it (columns differ by more than case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts) of a list column without nulls."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes ``start, start + 1, …`` of each run, one run after another."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total) + shift
