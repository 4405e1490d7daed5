"""Words of a string column as arrays: byte spans and 64-bit hashes, without a Python loop over words.

A word is a run of ASCII letters and digits and of non-ASCII bytes; A-Z and the capitals of Latin-1 are
lower-cased for the hash. The hash is a polynomial in an odd base modulo 2^64, taken from running sums
and moved to exponent 0, so it does not depend on where the word stands.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) <= n:
        size = max(n, SEGMENT) + 1
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True


@dataclass
class Words:
    """Per word: the row it is in, its bytes [start, end) in ``data`` and its hash; ``offsets`` has each
    row's bytes."""

    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def points(self, at: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Code points of each row before the byte positions ``at``."""
        seen = np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80, dtype=np.int64)))
        return seen[at] - seen[self.offsets[row]]


def column_data(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a string or binary column, each row's place in them); null rows are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, values = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(values or b"", dtype=np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def segments(data: np.ndarray, offsets: np.ndarray, inner: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, row starts relative to from) of about SEGMENT bytes; ``inner`` says which bytes are
    part of words, and no word is cut."""
    at = 0
    while at < len(data):
        to = min(len(data), at + SEGMENT)
        while to < len(data) and inner[data[to - 1]] and inner[data[to]]:
            tail = ~inner[data[to: to + SEGMENT]]
            to += int(tail.argmax()) if tail.any() else len(tail)
        yield at, to, offsets[np.searchsorted(offsets, at): np.searchsorted(offsets, to, side="right")] - at
        at = to


def spans(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of ``inside`` bytes, also cut at ``breaks``."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[breaks] = True
    edge[0] = edge[-1] = True
    return (np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1])))),
            np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True])))) + 1)


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capitals of Latin-1 in lower case."""
    low = _LOWER[data]
    capital = np.concatenate(([False], data[:-1] == 0xC3)) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    low[capital] += 0x20
    return low


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each span of bytes."""
    n = len(data)
    up, down = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def words(column: pa.Array) -> Words:
    """The words of a string or binary column; null rows have none."""
    data, offsets = column_data(column)
    parts = []
    for at, to, breaks in segments(data, offsets, _IS_WORD):
        part = data[at:to]
        start, end = spans(_IS_WORD[part], breaks)
        parts.append((start + at, end + at, span_hashes(lower(part), start, end)))
    if parts:
        start, end, h = (np.concatenate(x) for x in zip(*parts))
    else:
        start, end, h = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return Words(data, offsets, np.searchsorted(offsets, start, side="right") - 1, start, end, h)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every n-gram that stays inside its row."""
    if len(w.hash) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(w.hash) - n + 1
    g = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        g = g * np.uint64(0xD6E8FEB86659FD93) + w.hash[k: k + m]
    g ^= g >> np.uint64(32)
    at = np.flatnonzero(w.row[:m] == w.row[n - 1:])
    return at, g[at]


def pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every two words of a row, in order, with at most one word between."""
    at, g = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for far in (1, 2):
        first = np.flatnonzero(w.row[:-far] == w.row[far:])
        h = w.hash[first] * np.uint64(0xD6E8FEB86659FD93) + w.hash[first + far]
        at.append(first)
        g.append(h ^ (h >> np.uint64(32)))
    return np.concatenate(at), np.concatenate(g)
