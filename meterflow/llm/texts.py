"""Vectorised text helpers for code that runs on Arrow batches inside tasks.

A word is ``[^\\x20\\x09-\\x0D]+``. Texts are handled as one UTF-8 byte buffer
per slice; slices bound the memory of a task whatever the batch holds, and a
text that is longer than a slice is a slice of its own (never cut).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_KEYS = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
BYTE_KEYS[SPACE] = 0
STEP = U64(0x9E3779B97F4A7C15)
WORD_KEYS = _rng.integers(1, 2**63, 64, dtype=np.int64).astype(U64) | U64(1)


def slices(batches, column: str = "text", limit: int = SLICE_BYTES, *more: str):
    """Record batches cut so that ``column`` (and ``more``) hold ``limit`` bytes or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.zeros(batch.num_rows, np.int64)
        for c in (column, *more):
            size += pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        end = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            base = end[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(end, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start, and the row of each word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = ~space
    start[1:] &= space[:-1] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection of 64-bit integers)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, U64)
    first = int(starts[0])
    data, begin = data[first:], starts - first
    length = np.diff(begin, append=len(data))
    powers = np.cumprod(np.full(int(length.max()), STEP, U64), dtype=U64)
    at = np.arange(len(data)) - np.repeat(begin, length)
    return mix(np.add.reduceat(BYTE_KEYS[data] * powers[at], begin))


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct hashed ``k``-word shingles per row of a text column.

    Words are lower-cased in A-Z only. A row with fewer than ``k`` words has
    its whole word sequence as one shingle; a row without words has none.
    Returns (hashes, rows, number of rows), ordered by row and hash.
    """
    data, offsets = buffer(column)
    n = len(offsets) - 1
    data = LOWER[data]
    starts, row = word_starts(data, offsets)
    words = word_hashes(data, starts, offsets)
    if not len(words):
        return np.zeros(0, U64), np.zeros(0, np.int64), n
    count = np.bincount(row, minlength=n)
    begin = np.concatenate([[0], np.cumsum(count)[:-1]])
    parts, rows = [], []
    if len(words) >= k:
        m = len(words) - k + 1
        whole = row[:m] == row[k - 1:]
        h = np.zeros(m, U64)
        for j in range(k):
            h += words[j:j + m] * WORD_KEYS[j]
        parts.append(mix(h[whole]))
        rows.append(row[:m][whole])
    for c in range(1, k):
        short = np.flatnonzero(count == c)
        h = np.full(len(short), WORD_KEYS[63] * U64(c), U64)
        for j in range(c):
            h += words[begin[short] + j] * WORD_KEYS[j]
        parts.append(mix(h))
        rows.append(short)
    h, row = np.concatenate(parts), np.concatenate(rows)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new], n


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones that Spark stores."""
    return x.view(np.int64)
