"""Tokenizers of the workers: loaded once per process, with bounded caches."""
from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa

from .words import column_data, lower, segments, span_hashes, spans

_WORD: dict[str, "WordEncoder"] = {}
_BYTE: dict[str, "ByteEncoder"] = {}


_INNER = np.ones(256, dtype=bool)  # what is not a space or a line feed
_INNER[[10, 32]] = False
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)  # ASCII marks; an apostrophe may belong to a word
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes are part of a letter of ASCII, Latin-1 or Latin Extended-A (less U+0130)."""
    out = _ASCII_LETTER[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    a, b = data[lead], data[lead + 1]
    lead = lead[~((a == 0xC3) & ((b == 0x97) | (b == 0xB7))) & ~((a == 0xC4) & (b == 0xB0))]
    out[lead] = out[lead + 1] = True
    return out


class _SlotMap:
    """A map from 64-bit keys to slots as two sorted arrays."""

    def __init__(self) -> None:
        self.keys, self.slots = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1).astype(np.int64)

    def add(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """New keys, sorted, with their slots."""
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)


class WordEncoder:
    """Ids of a ``tokenizers`` file whose model sees each white-space word by itself.

    Texts are split at spaces and line feeds only (any other white space stays inside a word and is
    the tokenizer's business), each distinct word is encoded once, and a text's ids are its words' ids
    in order. That equals encoding the whole text as long as the tokenizer lower-cases, drops white
    space, never joins across it and keeps letters apart from marks. A plain word (letters, and perhaps
    marks after them) is looked up in lower case, its marks by themselves; new plain words are encoded as
    one line and told apart by the tokens that end a word. Words are known by a 64-bit hash; the store is
    emptied when it holds ``limit`` words.
    """

    END = "</w>"

    def __init__(self, path: str, limit: int = 2_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(vocabulary.values()) < 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.END)]] = True
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.known = [_SlotMap(), _SlotMap()]  # most words, and those learnt lately
        self.pool = np.zeros(0, dtype=self.dtype)
        self.first = np.zeros(1, dtype=np.int64)  # slot s has the ids pool[first[s]:first[s + 1]]

    def _any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words, one after the other, and how many each has)."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], dtype=self.dtype), np.array([len(x) for x in ids], dtype=np.int64)

    def _plain(self, cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that are letters only."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, dtype=self.dtype)
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(cores) or last[-1] != len(ids):
            return self._any(cores)
        return ids, np.diff(last, prepend=0)

    def _learn(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The slots of new words; ``keys`` is sorted."""
        slots = np.arange(len(self.first) - 1, len(self.first) - 1 + len(keys))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes)))
        self.pool = np.concatenate((self.pool, ids))
        main, late = self.known
        late.add(keys, slots)
        if len(late.keys) > 1 << 16:
            main.add(late.keys, late.slots)
            self.known[1] = _SlotMap()
        return slots

    def _elements(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, slot) of each element of a segment, in order."""
        start, end = spans(_INNER[data], breaks)
        if not len(start):
            return start, start
        inside = np.where(_MARK[data], -1, np.arange(len(data), dtype=np.int32))
        stop = np.maximum(np.maximum.accumulate(inside)[end - 1] + 1, start)  # where the marks at the end begin
        letters = np.concatenate(([0], np.cumsum(_letters(data), dtype=np.int32)))
        plain = (letters[stop] - letters[start] == stop - start) & (stop > start)
        stop = np.where(plain, stop, end)
        tail = np.flatnonzero(stop < end)
        # a plain word and the marks after it are two elements, any other word is one
        place = np.arange(len(start)) + np.cumsum(stop < end) - (stop < end)
        n = len(start) + len(tail)
        first, to, letter = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64), np.zeros(n, dtype=bool)
        first[place], to[place], letter[place] = start, stop, plain
        first[place[tail] + 1], to[place[tail] + 1] = stop[tail], end[tail]
        low = lower(data)
        key = span_hashes(low, first, to)
        other = np.flatnonzero(~letter)
        if len(other):
            key[other] = ~span_hashes(data, first[other], to[other])
        distinct, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.first) + len(distinct) > self.limit:
            self._reset()
        slot = np.maximum(*(m.find(distinct) for m in self.known))
        new = np.flatnonzero(slot < 0)
        known = letter[at[new]]
        for group, raw, encode in ((new[known], low, self._plain), (new[~known], data, self._any)):
            if len(group):
                text = raw.tobytes()
                words = [text[i:j].decode() for i, j in zip(first[at[group]].tolist(), to[at[group]].tolist())]
                slot[group] = self._learn(distinct[group], *encode(words))
        return first, slot[inverse]

    def column(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each row of a string column; null rows have none."""
        data, offsets = column_data(column)
        rows: list[list[np.ndarray]] = [[] for _ in range(len(column))]
        for at, to, breaks in segments(data, offsets, _INNER):
            start, slot = self._elements(data[at:to], breaks)
            if not len(start):
                continue
            size = self.first[slot + 1] - self.first[slot]
            total = np.cumsum(size)
            ids = self.pool[np.repeat(self.first[slot] - (total - size), size) + np.arange(total[-1])]
            row = np.searchsorted(offsets, start + at, side="right") - 1
            edges = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1], [True])))
            bounds = np.concatenate(([0], total))[edges]
            for k, r in enumerate(row[edges[:-1]].tolist()):
                rows[r].append(ids[bounds[k]:bounds[k + 1]])
        return [np.concatenate(r) if r else np.zeros(0, dtype=self.dtype) for r in rows]


class ByteEncoder:
    """Ids of a byte-level BPE from a ``tiktoken`` rank file; special strings count as ordinary text."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def text(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8")


def word_encoder(path: str) -> WordEncoder:
    if path not in _WORD:
        _WORD[path] = WordEncoder(path)
    return _WORD[path]


def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    if path not in _BYTE:
        _BYTE[path] = ByteEncoder(path, pattern)
    return _BYTE[path]
