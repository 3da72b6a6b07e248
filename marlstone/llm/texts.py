"""Byte-level helpers for Arrow batches of texts: bounded slices, words, word hashes, n-gram sets.

Everything works on the UTF-8 bytes of whole texts with numpy. A slice holds at most ``SLICE_BYTES``
of text (or one longer text), which bounds the arrays of a task whatever the batch.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _table(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Bytes of words that end at ASCII white space (space and 0x09 to 0x0D).
SPACED = _table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Bytes of words made of ASCII digits, ASCII letters and every byte beyond ASCII.
ALNUM = _table({*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)})
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def carried(batch: pa.RecordBatch, text: str) -> tuple[pa.Array, pa.Array]:
    """The carried rows of a batch and their texts, which travel once."""
    rows = batch.column(batch.schema.get_field_index("row"))
    return rows, rows.field(text)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them) over a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64, n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last
    release()


#: The C library's way to hand freed memory back, where it has one.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def release() -> None:
    """Give freed memory back: workers are many and kept, so none should hold what it has freed."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a slice, and the index of its first word for each row (rows + 1)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = members[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every bit of a 64-bit hash."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte range: a polynomial over prefix sums, scaled to the range's start."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    values = (LOWER[data] if lower else data).astype(np.uint64)
    values += np.uint64(1)
    values *= up[:n]
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each row, one after another, and their offsets.

    A row with fewer words has one shingle, its whole word sequence; a row without words has none.
    """
    starts, ends, first = words(data, offsets, SPACED)
    word = hashes(data, starts, ends)
    total = len(word)
    mark = np.arange(1, 2 * size, 2, dtype=np.uint64) * _BASE
    full = np.zeros(max(total, 1), np.uint64)
    if total >= size:
        reach = total - size + 1
        for k in range(size):
            full[:reach] += mix(word[k:k + reach] * mark[k])
    full = mix(full)
    counts = np.diff(first)
    found, at = [], np.zeros(len(counts) + 1, np.int64)
    for row, (a, n) in enumerate(zip(first[:-1].tolist(), counts.tolist())):
        if n >= size:
            own = np.sort(full[a:a + n - size + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif n:
            own = np.array([np.uint64(n)], np.uint64)
            for k in range(n):
                own = mix(own * _BASE + word[a + k])
        else:
            own = full[:0]
        found.append(own)
        at[row + 1] = at[row] + len(own)
    return (np.concatenate(found) if found else full[:0]), at
