"""MD5 of many short texts at once: the draws of ``keyed.py`` for entities that take billions of them (FN1).

Row by row, a digest costs a call, a text of 32 digits and its parsing. Here every step of MD5 runs over an array with a place
for each text, which costs a small part of that. Digests and draws are the same. Texts of up to 55 bytes are one block of MD5
(RFC 1321), longer ones go through ``hashlib``.
"""
from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this library

# Fixed values of RFC 1321: sines, rotations, the words that a state starts from.
_SINES = [np.array(int(abs(np.sin(i + 1)) * 2**32) & 0xFFFFFFFF, np.uint32) for i in range(64)]
_LEFT = [[np.array(by, np.uint32) for by in turn] for turn in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))]
_RIGHT = [[np.array(32 - int(by), np.uint32) for by in turn] for turn in _LEFT]
_START = [np.array(x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
ONE_BLOCK = 55  # bytes of text
AT_ONCE = 32_768  # digests that one pass makes: its arrays stay in a core's cache
BUCKETS = 1_000_000


def md5_words(words: Sequence[np.ndarray], shape: tuple[int, ...]) -> list[np.ndarray]:
    """The digests of single blocks as four numbers of 32 bits, in the order of their hexadecimal digits.

    ``words`` are the 16 words of the blocks; each is broadcast to ``shape``, so what blocks share is given once.
    """
    a, b, c, d = (np.broadcast_to(x, shape).copy() for x in _START)
    f, g = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i, sine in enumerate(_SINES):
        turn, k = divmod(i, 16)
        if turn == 0:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif turn == 1:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
            k = (5 * i + 1) % 16
        elif turn == 2:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
            k = (3 * i + 5) % 16
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
            k = (7 * i) % 16
        np.add(a, f, out=f)
        np.add(f, words[k] + sine if words[k].ndim == 0 else np.add(words[k], sine, out=g), out=f)
        np.left_shift(f, _LEFT[turn][i % 4], out=g)
        np.right_shift(f, _RIGHT[turn][i % 4], out=f)
        np.bitwise_or(f, g, out=f)
        np.add(f, b, out=a)
        a, d, c, b = d, c, b, a
    return [np.add(x, s, out=x).byteswap(inplace=True) for x, s in zip((a, b, c, d), _START)]


def millionths(number: np.ndarray) -> np.ndarray:
    """A uniform draw in millionths of each number of 32 bits."""
    return number - number // np.uint32(BUCKETS) * np.uint32(BUCKETS)


def _called(text: bytes) -> tuple[int, ...]:
    return tuple(int(x) for x in np.frombuffer(hashlib.md5(text).digest(), ">u4"))


def _blocks(texts: np.ndarray, at: int) -> np.ndarray:
    """Texts of one length, a row each, from byte ``at`` of their blocks: 16 words by texts."""
    blocks = np.zeros((len(texts), 64), np.uint8)
    blocks[:, at:at + texts.shape[1]] = texts
    return np.ascontiguousarray(blocks.view("<u4").T).astype(np.uint32, copy=False)


def _end(total: int) -> np.ndarray:
    """The words of a block of ``total`` bytes of text without its text."""
    block = np.zeros(64, np.uint8)
    block[total] = 0x80
    block[56:58] = np.frombuffer(np.array(8 * total, "<u2").tobytes(), np.uint8)
    return block.view("<u4").astype(np.uint32)


def _varying(words: np.ndarray) -> list[np.ndarray]:
    """Each word as an array, or as one number if all texts share it."""
    return [w[0] if (w == w[0]).all() else w for w in words]


def followed(heads: pa.Array, tails: Sequence[bytes], first: np.ndarray, drawn: Callable[[list[np.ndarray], np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``drawn`` of the digests of head i followed by each of ``tails`` from place ``first[i]`` on, and of the tails' places: where
    each head's begin (and the last ends) in one array of 64-bit numbers, and this array."""
    heads = heads.cast(pa.large_binary())
    ends = np.frombuffer(heads.buffers()[1], np.int64)[heads.offset:heads.offset + len(heads) + 1] if len(heads) else np.zeros(1, np.int64)
    text = np.frombuffer(heads.buffers()[2] or b"", np.uint8) if len(heads) else np.zeros(0, np.uint8)
    counts = np.maximum(len(tails) - first, 0)
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    out = np.empty(starts[-1], np.int64)
    lengths, sizes = np.diff(ends), np.array([len(t) for t in tails], np.int64)
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        chars = text[ends[own][:, None] + np.arange(length)]
        # a place in ``out`` for every cell of these heads, and the numbers of its head and tail
        head = np.repeat(np.arange(len(own)), counts[own])
        place = np.arange(len(head)) + np.repeat(starts[own] - np.concatenate([np.zeros(1, np.int64), np.cumsum(counts[own])[:-1]]), counts[own])
        tail = place - (starts[own] - first[own])[head]
        for size in np.unique(sizes):
            total = int(length + size)
            some = np.flatnonzero(sizes == size)
            cells = slice(None) if len(some) == len(tails) else np.flatnonzero((sizes == size)[tail])
            h, t, to = head[cells], tail[cells], place[cells]
            if total > ONE_BLOCK:
                found = [_called(chars[i].tobytes() + tails[j]) for i, j in zip(h, t)]
                out[to] = drawn([np.array(x, np.uint32) for x in zip(*found)], t) if found else 0
                continue
            begin = _varying(_blocks(chars, 0) | _end(total)[:, None])
            every = np.zeros((len(tails), size), np.uint8)
            every[some] = np.frombuffer(b"".join(tails[j] for j in some), np.uint8).reshape(len(some), size)
            rest = _blocks(every, int(length))
            for low in range(0, len(to), AT_ONCE):
                hh, tt = h[low:low + AT_ONCE], t[low:low + AT_ONCE]
                words = [(b if b.ndim == 0 else b[hh]) | (r[tt] if r.any() else np.uint32(0)) for b, r in zip(begin, rest)]
                out[to[low:low + AT_ONCE]] = drawn(md5_words(words, (len(hh),)), tt)
    return starts, out


def drawn_after(head: Column, first: Column, numbers: Sequence[int], tails: Sequence[str], drawn: Callable[[list[np.ndarray], np.ndarray], np.ndarray]) -> Column:
    """An array of a 64-bit number for each of ``tails`` whose number (of ``numbers``, which ascend) is ``first`` or more: ``drawn`` of
    the digests of ``head`` followed by the tail, four numbers of 32 bits, and of the tail's place. Empty for a null ``first``."""
    ascending, texts = np.array(numbers, np.int64), [t.encode() for t in tails]

    def draw(heads: pa.Array, firsts: pa.Array) -> pa.Array:
        none = np.asarray(firsts.is_null())
        at = np.searchsorted(ascending, np.asarray(firsts.fill_null(0)).astype(np.int64))
        at[none] = len(texts)
        starts, values = followed(heads, texts, at, drawn)
        return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values))

    return F.arrow_udf(draw, "array<bigint>")(head, first)


@lru_cache(maxsize=256)
def _steps(low: int, high: int, at: int, tail: bytes) -> np.ndarray:
    """The numbers from ``low`` to ``high`` - 1, which have the same digits, and ``tail`` from byte ``at`` of blocks."""
    n = len(str(low))
    digits = np.arange(low, high)[:, None] // 10 ** np.arange(n - 1, -1, -1) % 10 + ord("0")
    return _blocks(np.hstack([digits.astype(np.uint8), np.tile(np.frombuffer(tail, np.uint8), (high - low, 1))]), at)


def step_draws(heads: Sequence[bytes], low: int, high: int, tail: bytes) -> np.ndarray:
    """The draws in millionths of texts (head, number, tail), by heads of one length and the numbers from ``low`` to ``high`` - 1."""
    out = np.empty((len(heads), high - low), np.uint32)
    length = len(heads[0])
    chars = np.frombuffer(b"".join(heads), np.uint8).reshape(len(heads), length)
    begin, done = low, low
    while done < high:
        begin = max(done // AT_ONCE * AT_ONCE, 10 ** (len(str(done)) - 1))  # the same pieces in every call, which are kept
        end = min((done // AT_ONCE + 1) * AT_ONCE, 10 ** len(str(done)))
        here = slice(done - begin, min(high, end) - begin)
        n, total = here.stop - here.start, length + len(str(done)) + len(tail)
        if total > ONE_BLOCK:
            out[:, done - low:done - low + n] = millionths(np.array([[_called(h + str(i).encode() + tail)[0] for i in range(done, done + n)] for h in heads], np.uint32))
        else:
            steps = [w[0] if (w == w[0]).all() else w[here][None, :] for w in _steps(begin, end, length, tail)]
            own = _varying(_blocks(chars, 0) | _end(total)[:, None])
            per = max(1, AT_ONCE // n)
            for i in range(0, len(heads), per):
                some = min(per, len(heads) - i)
                words = [(b if b.ndim == 0 else b[i:i + some, None]) | s for b, s in zip(own, steps)]
                out[i:i + some, done - low:done - low + n] = millionths(md5_words(words, (some, n))[0])
        done = begin + here.stop
    return out


@lru_cache(maxsize=16)
def _gaps(law: tuple[int, ...]) -> np.ndarray:
    """The gap that each draw in millionths stands for: one more than the thresholds that it reaches."""
    return (np.searchsorted(np.array(law), np.arange(BUCKETS), "right") + 1).astype(np.uint16 if len(law) < 65_000 else np.uint32)


def skips(heads: Sequence[bytes], tail: bytes, law: tuple[int, ...], size: int, some: int, copies: Sequence[int]) -> Iterator[np.ndarray]:
    """For each head the chosen positions of 1..``size``: running sums of the gaps of the steps 1, 2, .., drawn ``some`` at a time
    until they pass ``size``. Of a group that is there several times, every gap of the first steps counts as often.

    Heads have one length."""
    at_once = max(1, 4_000_000 // some)
    for low in range(0, len(heads), at_once):
        now = heads[low:low + at_once]
        first = _gaps(law)[step_draws(now, 1, some + 1, tail)]
        for i, head in enumerate(now):
            gaps, upto, found = np.repeat(first[i], copies[low + i]), some, []
            last = 0
            while True:
                positions = last + np.cumsum(gaps, dtype=np.int64)
                found.append(positions[:np.searchsorted(positions, size, "right")])
                last = int(positions[-1])
                if last >= size:
                    break
                gaps, upto = _gaps(law)[step_draws([head], upto + 1, upto + some + 1, tail)[0]], upto + some
            yield np.concatenate(found)
