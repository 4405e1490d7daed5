"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

The different texts of the test items are the query set and go through in blocks of about ``block_words``
words, each block a small array in every task; the corpus is read twice per block and never shuffled.

1. How many documents hold each of the block's word pairs is counted over the whole corpus. A pair is two
   words in order with at most one word between.
2. An alignment (match 2, other word -1, gap -1) of an item of L words that scores ``least`` of a full
   match has m matches and costs of at most 2 m - 2 least L; so at least least L - 1 of its m - 1 steps
   from match to match cost one at most, and each of them is a pair of both sides. Of the item's places
   all but the least L - 2 with the most frequent pairs are seeds: whatever the counts, every such
   alignment has one.
3. A document's seed hits are joined to item positions, and the words around them, as far as such an
   alignment can reach, are aligned to the item. Every passage that reaches ``least`` is a leak.

Words follow ``scripts``: any Unicode space or mark separates, and each character of an unspaced script is
a word. Hashes only find candidates; the words that are aligned are compared by their bytes. Items of
fewer than ``n`` words say too little for a share of them: they match where all their words follow each other.
"""
from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small, text_slices
from .scripts import Vocabulary, script_words
from .words import Words, pairs

MATCH, OTHER, GAP = 2, -1, 1
ONE = 1 << 32
MAP_BITS = 20


@dataclass(frozen=True)
class Settings:
    n: int = 3
    least: float = 0.5
    block_words: int = 2_000_000
    batch: int = 128


@dataclass
class Items:
    """A block of test items: ids, words (flat, ``first`` has each item's place) and word pairs; an item of
    one word counts as a pair of its own."""

    ids: list
    first: np.ndarray
    vocabulary: Vocabulary  # its ``number`` has the items' words
    gram: np.ndarray  # distinct, sorted
    at: np.ndarray  # of each pair's occurrence, its first word
    slots: np.ndarray  # and its index in ``gram``
    single: bool  # whether an item has one word

    def grams(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all that can be a seed in ``w``."""
        at, g = pairs(w)
        return (np.concatenate((at, np.arange(len(w.hash)))), np.concatenate((g, _single(w.hash)))) if self.single else (at, g)

    def slot(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``g`` that are pairs of the block, their index in ``gram``)."""
        at = np.flatnonzero(self.map[g >> np.uint64(64 - MAP_BITS)])
        k = np.minimum(np.searchsorted(self.gram, g[at]), len(self.gram) - 1)
        same = self.gram[k] == g[at]
        return at[same], k[same]

    def __post_init__(self) -> None:
        self.map = np.zeros(1 << MAP_BITS, dtype=bool)
        self.map[self.gram >> np.uint64(64 - MAP_BITS)] = True


def _single(h: np.ndarray) -> np.ndarray:
    g = h * np.uint64(0xA24BAED4963EE407) + np.uint64(1)
    return g ^ (g >> np.uint64(31))


def _items(ids: list, texts: list[str | None]) -> Items:
    w = script_words(pa.array(texts, pa.string()))
    first = np.searchsorted(w.row, np.arange(len(ids) + 1))
    at, g = pairs(w)
    alone = first[:-1][np.diff(first) == 1]
    at, g = np.concatenate((at, alone)), np.concatenate((g, _single(w.hash[alone])))
    gram, inverse = np.unique(g, return_inverse=True)
    return Items(ids, first, Vocabulary(w), gram, at, inverse, bool(len(alone)))


def _document_counts(docs: DataFrame, block: Items) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.gram), dtype=np.int64)
        for b in text_slices(batches, 0):
            w = script_words(b.column(0))
            at, g = block.grams(w)
            hit, k = block.slot(g)
            if len(hit):
                held = np.unique(w.row[at[hit]] * len(block.gram) + k)
                total += np.bincount(held % len(block.gram), minlength=len(block.gram))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["k", "n"])

    out = np.zeros(len(block.gram), dtype=np.int64)
    got = docs.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()  # at most the block's pairs
    out[got["k"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


def _score(item: np.ndarray, text: np.ndarray, item_len: np.ndarray, text_len: np.ndarray) -> np.ndarray:
    """Of each word of the padded texts, the best local alignment that ends there: score * ONE + its first word."""
    b, width = text.shape
    place = np.arange(width, dtype=np.int64)
    step = place * (GAP * ONE)
    inside = place < text_len[:, None]
    h = np.zeros((b, width + 1), dtype=np.int64)
    best = np.zeros((b, width), dtype=np.int64)
    for i in range(item.shape[1]):
        here = np.where(h[:, :-1] >= ONE, h[:, :-1], place) + np.where(text == item[:, i: i + 1], MATCH * ONE, OTHER * ONE)
        here = np.maximum(here, h[:, 1:] - GAP * ONE)
        here = np.maximum.accumulate(here + step, axis=1) - step
        here[~inside | (i >= item_len)[:, None] | (here < ONE)] = 0
        h[:, 1:] = here
        np.maximum(best, here, out=best)
    return best


def _choose(best: np.ndarray, least: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(score, start, end) of alignments of ``least`` or more that don't overlap, best first, and the parts
    between them that may hold more: those with an end whose best alignment reaches into a chosen one."""
    ends = np.flatnonzero(best >= least * ONE)
    score, start = best[ends] // ONE, best[ends] % ONE
    o = np.lexsort((ends, -score))
    out, begin, finish, again = [], [], [0], set()
    for n, a, j in zip(score[o].tolist(), start[o].tolist(), ends[o].tolist()):
        k = bisect_right(begin, j)
        if j < finish[k] or finish[k] in again:
            continue
        if a < finish[k]:
            again.add(finish[k])
            continue
        begin.insert(k, a)
        finish.insert(k + 1, j + 1)
        out.append((n, a, j + 1))
    return out, [(a, e) for a, e in zip(finish, [*begin, len(best)]) if a in again]


def align(items: list[np.ndarray], texts: list[np.ndarray], least: np.ndarray, batch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, score, start, end): the local alignments of each pair that score ``least`` or more and don't
    overlap, with the words [start, end) of the text; what is left of a text is aligned until none does."""
    found: list[tuple[int, int, int, int]] = []
    todo = [(k, 0, len(t)) for k, t in enumerate(texts)]
    while todo:
        todo.sort(key=lambda x: (x[2] - x[1], len(items[x[0]])))
        rest, at = [], 0
        while at < len(todo):
            part = todo[at:at + batch]
            while len(part) > 1 and len(part) * (part[-1][2] - part[-1][1]) > 1 << 20:
                part = part[: len(part) // 2]
            at += len(part)

            def pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
                size = np.array([len(r) for r in rows])
                out = np.zeros((len(rows), max(1, int(size.max()))), dtype=np.int64)
                for k, r in enumerate(rows):
                    out[k, : len(r)] = r
                return out, size

            a, la = pad([items[k] for k, _, _ in part])
            t, lt = pad([texts[k][x:y] for k, x, y in part])
            for (k, x, y), best in zip(part, _score(a, t, la, lt)):
                chosen, more = _choose(best[: y - x], int(least[k]))
                found += [(k, n, x + s, x + e) for n, s, e in chosen]
                rest += [(k, x + s, x + e) for s, e in more if MATCH * (e - s) >= least[k]]
        todo = rest
    pair, score, start, end = np.array(sorted(found), dtype=np.int64).reshape(-1, 4).T
    return pair, score, start, end


def _passages(row: np.ndarray, item: np.ndarray, diagonal: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first hit, last hit + 1) of each group of sorted hits whose diagonals stay near each other."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] >= reach[1:])
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(row))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, item_id, similarity, start, end, seeds)``: one row per leaked passage.

    start and end are code points of the document (end exclusive); similarity is the alignment score
    over that of a full match; passages of one document and item do not overlap. A document
    without a leak has no row. Items of fewer than ``n`` words are found wherever all their words follow each
    other, so a one-word item is found in every text with that word. Null and empty texts, and items
    without a letter or digit, hold nothing; repeated rows repeat; null ids are kept as null. Columns other
    than those named are ignored; an empty table on either side gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tests = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item string, similarity double, start long, `end` long, seeds long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(tests, settings):
        found = _passages_of(texts, "text", block, settings)

        def run(batches: Iterator[pa.RecordBatch], found=found, ids=block.ids) -> Iterator[pa.RecordBatch]:
            for b in text_slices(batches, 1, 2 << 20):
                x = found(b.column(1))
                if len(x.row):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(x.row)), pa.array([ids[i] for i in x.item.tolist()], pa.string()), pa.array(x.share),
                         pa.array(x.start), pa.array(x.end), pa.array(x.seeds)], names=["doc_id", "item", "similarity", "start", "end", "seeds"])

        out = out.unionByName(texts.mapInArrow(run, schema))
    named = small(cut(tests.select(F.sha2("text", 256).alias("item"), "item_id")), 1_000_000)
    return out.join(named, "item").select("doc_id", "item_id", "similarity", "start", "end", "seeds")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, all columns, without a leak; no document is shuffled."""
    at, out = docs.columns.index(text_col), docs
    for block in _blocks(items.select(F.col(item_text).alias("text")).where("text is not null"), settings):
        found = _passages_of(docs, text_col, block, settings)

        def run(batches: Iterator[pa.RecordBatch], found=found) -> Iterator[pa.RecordBatch]:
            for b in text_slices(batches, at, 2 << 20):
                stays = np.ones(b.num_rows, dtype=bool)
                stays[found(b.column(at)).row] = False
                yield b.filter(pa.array(stays))

        out = out.mapInArrow(run, docs.schema)
    return out


def _blocks(tests: DataFrame, s: Settings) -> Iterator[Items]:
    """The different texts of the test items, dealt by their hash into blocks of about ``block_words`` words, a
    very long word counted as one per 8 bytes; ids are SHA-256 sums of the texts."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 0):
            w = script_words(b.column(0))
            size = np.bincount(w.row, weights=np.maximum(1, (w.end - w.start) // 8), minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size.astype(np.int64))], names=["text", "size"])

    texts = cut(tests.select("text").distinct().mapInArrow(weigh, "text string, size long").where("size > 0"))
    total = texts.agg(F.sum("size").alias("n")).first()["n"] or 0
    blocks = -(-total // s.block_words)
    for k in range(blocks):
        got = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).select(F.sha2("text", 256).alias("item"), "text").collect()  # about block_words words
        block = _items([r.item for r in got], [r.text for r in got])
        if len(block.gram):
            yield block


@dataclass
class Passages:
    """Leaks of a batch: row, item, similarity, code points, seed hits."""

    row: np.ndarray
    item: np.ndarray
    share: np.ndarray
    start: np.ndarray
    end: np.ndarray
    seeds: np.ndarray


def _passages_of(docs: DataFrame, text_col: str, block: Items, s: Settings) -> Callable[[pa.Array], Passages]:
    """Count the block's pairs over ``docs`` and choose the seeds; a function that finds a text column's leaks."""
    counts = _document_counts(docs.select(text_col), block)
    at, slot = block.at, block.slots
    owner = np.searchsorted(block.first, at, side="right") - 1
    sizes = np.diff(block.first)
    total = len(block.vocabulary.number)
    load = np.bincount(at, weights=counts[slot], minlength=total)  # of each place, the documents of its pairs
    places = np.unique(at)
    item = np.searchsorted(block.first, places, side="right") - 1
    o = np.lexsort((load[places], item))
    places, item = places[o], item[o]
    rank = np.arange(len(places)) - np.searchsorted(item, item)
    least = np.where(sizes < s.n, 1.0, s.least)
    steps = np.maximum(1, np.ceil(least * sizes - 1 - 1e-9)).astype(np.int64)
    chosen = np.zeros(total, dtype=bool)
    chosen[places[rank <= np.maximum(0, sizes[item] - 1 - steps[item])]] = True
    seed = chosen[at]
    order = np.argsort(slot[seed], kind="stable")
    seed_slot, seed_item, seed_pos = slot[seed][order], owner[seed][order], (at - block.first[owner])[seed][order]
    bounds = np.searchsorted(seed_slot, np.arange(len(block.gram) + 1))
    margins = (2 * (1 - least) * sizes + 1e-9).astype(np.int64)  # words of an alignment beyond the item's
    none = np.zeros(0, dtype=np.int64)

    def find(column: pa.Array) -> Passages:
        w = script_words(column)
        where, g = block.grams(w)
        hit, k = block.slot(g)
        n = bounds[k + 1] - bounds[k]
        which = np.repeat(bounds[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        word = np.repeat(where[hit], n)
        if not len(word):
            return Passages(none, none, none, none, none, none)
        item, pos = seed_item[which], seed_pos[which]
        diagonal = word - pos
        o = np.lexsort((word, diagonal, item, w.row[word]))
        word, item, diagonal = word[o], item[o], diagonal[o]
        row = w.row[word]
        first, last = _passages(row, item, diagonal, sizes[item] + 2 * margins[item])
        row_from, row_to = np.searchsorted(w.row, row[first]), np.searchsorted(w.row, row[first], side="right")
        length, whose = sizes[item[first]], item[first]
        margin = margins[whose]
        lo = np.maximum(row_from, diagonal[first] - margin)
        hi = np.minimum(row_to, diagonal[last - 1] + length + margin)
        enough = np.ceil(MATCH * least[whose] * length - 1e-9).astype(np.int64)
        edges = np.bincount(lo, minlength=len(w.hash) + 1) - np.bincount(hi, minlength=len(w.hash) + 1)
        near = np.flatnonzero(np.cumsum(edges)[:-1])
        known = np.full(len(w.hash), -1, dtype=np.int64)
        known[near] = block.vocabulary.numbers(w, near)
        k, score, a, e = align([block.vocabulary.number[block.first[i]:block.first[i + 1]] for i in whose], [known[x:y] for x, y in zip(lo, hi)], enough, s.batch)
        a, e = lo[k] + a, lo[k] + e
        group = np.repeat(np.arange(len(first)), last - first)
        word = word[np.lexsort((word, group))]
        seeds = np.array([np.diff(np.searchsorted(word[first[x]:last[x]], (y, z)))[0] for x, y, z in zip(k, a, e)], dtype=np.int64)
        r = row[first][k]
        return Passages(r, whose[k], score / (MATCH * length[k]), w.points(w.start[a], r), w.points(w.end[e - 1], r), seeds)

    return find
