"""Words of any script as arrays: breaks follow Unicode's categories, not bytes.

A word is a run of letters, digits and combining marks; every space, punctuation mark, symbol and format
character of Unicode separates. In scripts written without spaces each character, with the marks on it,
is a word. Characters are lower-cased one by one where the lower-case form has as many bytes.
"""
from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

from .words import SEGMENT, Words, column_data, span_hashes, spans

BREAK, LETTER, ALONE, MARK, MARK_ALONE = range(5)
ASSIGNED = 0x32000  # no script has letters beyond

# fixed values: Unicode blocks of scripts that put no spaces between words
UNSPACED = [
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x1950, 0x19DF),  # Tai Le, New Tai Lue
    (0x1A20, 0x1AAF),  # Tai Tham
    (0x2E80, 0x2FDF),  # CJK and Kangxi radicals
    (0x3005, 0x3007),  # ideographic iteration mark, closing mark and zero
    (0x3021, 0x3029),  # Hangzhou numerals
    (0x3040, 0x312F),  # Hiragana, Katakana, Bopomofo
    (0x31A0, 0x31BF),  # Bopomofo extended
    (0x31F0, 0x31FF),  # Katakana extensions
    (0x3400, 0x4DBF),  # CJK extension A
    (0x4E00, 0x9FFF),  # CJK
    (0xA000, 0xA4CF),  # Yi
    (0xA9E0, 0xA9FF),  # Myanmar extended B
    (0xAA60, 0xAADF),  # Myanmar extended A, Tai Viet
    (0xF900, 0xFAFF),  # CJK compatibility
    (0xFF66, 0xFF9F),  # half-width Katakana
    (0x16FE0, 0x18DFF),  # Tangut
    (0x1AFF0, 0x1B2FF),  # kana supplements, Nushu
    (0x20000, 0x31FFF),  # CJK extensions B and later
]

# fixed values: marks that change how a symbol is drawn and belong to no word
MODIFIERS = [(0x20D0, 0x20FF), (0xFE00, 0xFE0F)]


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(class, lower-case form) of every code point below ASSIGNED."""
    kind = {"L": LETTER, "N": LETTER, "M": MARK}
    cls = np.array([kind.get(unicodedata.category(chr(c))[0], BREAK) for c in range(ASSIGNED)], dtype=np.uint8)
    for a, b in UNSPACED:
        part = cls[a:b + 1]
        part[part == LETTER] = ALONE
        part[part == MARK] = MARK_ALONE
    for a, b in MODIFIERS:
        cls[a:b + 1] = BREAK
    low = np.arange(ASSIGNED, dtype=np.int32)
    size = lambda c: 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
    for c in range(ASSIGNED):
        x = chr(c).lower() if not 0xD800 <= c < 0xE000 else ""
        if len(x) == 1 and size(ord(x)) == size(c):
            low[c] = ord(x)
    return cls, low


def _rewrite(data: np.ndarray, at: np.ndarray, code: np.ndarray, size: int) -> None:
    """Put the characters ``code`` of ``size`` UTF-8 bytes at ``at``."""
    for k in range(size - 1, 0, -1):
        data[at + k] = 0x80 | (code & 0x3F)
        code = code >> 6
    data[at] = ((0xF0 << (4 - size)) & 0xFF | code) if size > 1 else code


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case bytes, bytes inside words, positions at which a word ends or starts within such bytes)."""
    cls, low = _tables()
    kind = cls[np.minimum(data, 127)]  # of each character, at its first byte
    out = data.copy()
    capital = (data >= 65) & (data <= 90)
    out[capital] += 32
    inside = kind != BREAK
    lead = np.flatnonzero(data >= 0xC0)
    breaks = [np.zeros(0, np.int64)]
    if len(lead):
        first = data[lead]
        sizes = 2 + (first >= 0xE0) + (first >= 0xF0)
        for size in (2, 3, 4):
            at = lead[sizes == size]
            if not len(at):
                continue
            code = data[at].astype(np.int64) & (0x7F >> size)
            for k in range(1, size):
                code = code << 6 | (data[at + k] & 0x3F)
            known = code < ASSIGNED
            code = np.where(known, code, 0)
            lower = low[code]
            changed = known & (lower != code)
            _rewrite(out, at[changed], lower[changed].astype(np.int64), size)
            kind[at] = np.where(known, cls[code], BREAK)
            used = at[kind[at] != BREAK]
            for k in range(size):
                inside[used + k] = True
            breaks.append(at[kind[at] == ALONE])
        unspaced = (kind[lead] == ALONE) | (kind[lead] == MARK_ALONE)
        after = lead[unspaced] + sizes[unspaced]
        after = after[after < len(data)]
        breaks.append(after[kind[after] == LETTER])
    return out, inside, np.concatenate(breaks)


def script_words(column: pa.Array) -> Words:
    """The words of a string column, with lower-case bytes as their data; null rows have none."""
    data, offsets = column_data(column)
    low, inside, breaks = _characters(data)
    start, end = spans(inside, np.concatenate((offsets, breaks))) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    h, i = np.zeros(len(start), np.uint64), 0
    while i < len(start):  # running sums over about SEGMENT bytes at a time
        a, j = int(start[i]), max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT, side="right")))
        h[i:j] = span_hashes(low[a:end[j - 1]], start[i:j] - a, end[i:j] - a)
        i = j
    return Words(low, offsets, np.searchsorted(offsets, start, side="right") - 1, start, end, h)


class Vocabulary:
    """Distinct words with a number each. The hash only finds the candidates; bytes decide."""

    def __init__(self, w: Words):
        text = w.data.tobytes()
        seen: dict[bytes, int] = {}
        self.number = np.array([seen.setdefault(text[a:b], len(seen)) for a, b in zip(w.start.tolist(), w.end.tolist())], dtype=np.int64)
        first = np.unique(self.number, return_index=True)[1]
        order = np.argsort(w.hash[first], kind="stable")
        self.hash, self.ids = w.hash[first][order], order.astype(np.int64)
        size = (w.end - w.start)[first][order]
        self.at = np.concatenate(([0], np.cumsum(size)))
        self.bytes = w.data[_gather(w.start[first][order], size)] if len(size) else np.zeros(0, np.uint8)

    def numbers(self, w: Words, which: np.ndarray) -> np.ndarray:
        """The number of each of the words ``which``; -1 if it isn't in the vocabulary."""
        out = np.full(len(which), -1, dtype=np.int64)
        if not len(self.hash):
            return out
        k = np.searchsorted(self.hash, w.hash[which])
        todo = np.arange(len(which))
        while len(todo):  # once, unless two words of the vocabulary share a hash
            todo = todo[k[todo] < len(self.hash)]
            todo = todo[self.hash[k[todo]] == w.hash[which[todo]]]
            a, mine = w.start[which[todo]], k[todo]
            size = w.end[which[todo]] - a
            same = size == self.at[mine + 1] - self.at[mine]
            a, size, mine, checked = a[same], size[same], mine[same], todo[same]
            differs = w.data[_gather(a, size)] != self.bytes[_gather(self.at[mine], size)]
            bad = np.concatenate(([0], np.cumsum(differs)))
            ends = np.cumsum(size)
            equal = bad[ends] == bad[ends - size]
            out[checked[equal]] = self.ids[mine[equal]]
            todo = todo[out[todo] < 0]
            k[todo] += 1
        return out


def _gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the spans, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
