"""Hashed word shingles of whole texts, computed over Arrow's buffers without a step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from weirgate.llm.common import mixed

# Texts are hashed in pieces of about this many bytes, which bounds a task's memory; a longer
# text is a piece by itself.
PIECE_BYTES = 1 << 20

_BASE = np.uint64(0x9E6C63D0876A9A63)
_UNBASE = np.uint64(pow(0x9E6C63D0876A9A63, -1, 1 << 64))
_PLACES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_CODE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash's base, and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, PIECE_BYTES + 1)
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of a string column; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and words up to each text's start."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * up[:n], out=sums[1:])
    words = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return words, np.searchsorted(start, offsets)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    A text with fewer words has one shingle of all of them; one without words has none.
    """
    for _, data, offsets in pieces(column):
        words, at = hashed_words(data, offsets)
        rows = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            rows += words[k : k + len(rows)] * (_PLACES[k % 3] + np.uint64(2 * (k // 3)))
        rows = mixed(rows)
        for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
            n = last - first
            if n >= width:
                yield np.unique(rows[first : last - width + 1])
            elif n:
                short = np.array([n], np.uint64)
                for k in range(n):
                    short += words[first + k : first + k + 1] * (_PLACES[k % 3] + np.uint64(2 * (k // 3)))
                yield mixed(short)
            else:
                yield rows[:0]
