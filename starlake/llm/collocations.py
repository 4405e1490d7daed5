"""Phrase collocations: mergeable Misra-Gries summaries find the frequent n-grams, a second pass counts them exactly.

First pass. Every task counts the n-grams (single words included) of its texts by a 64-bit hash, split by hash partition, and
hands on a summary per partition: sorted keys as differences, and counts. A partition's summaries are merged under a capacity
of twice mass / threshold, where the mass is all its occurrences; if more keys are left, the count of the first one too many is
taken off all. What is taken off in total stays below the threshold, so every n-gram with ``threshold`` occurrences or more
survives: its count, with what was taken off, reaches the threshold.

Second pass. The survivors' keys become a Bloom filter of 16 bits a key, or, where that is larger than FILTER_BYTES, a table
that is joined by shuffle. n-grams that pass are counted under their words, so equal hashes only cost work. What has
``threshold`` occurrences is the exact table of phrases; all parts of a frequent phrase are in it, as they are as frequent.

Words and n-grams inside a task are told apart by their bytes and by integers, never by a hash alone.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_slices
from .words import column_data, span_hashes, spans

SEGMENT = 1 << 20       # bytes of text that are counted at once
HELD = 1 << 19          # n-grams that a task holds before it hands on summaries
ROW_KEYS = 1 << 12      # keys in a row of a summary
PARTITION_MASS = 1 << 24  # occurrences that a hash partition should have
FILTER_BYTES = 1 << 26
PROBES = 4
SHARE = 1000            # a phrase with more than a SHARE-th of all words is joined by broadcast: SHARE a length at most
WORD, SPACE, BREAK = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK


# ------------------------------------------------------------------ n-grams of texts
@dataclass
class Grams:
    """The different n-grams of a segment. ``words`` are the different words, ``langs`` the languages. Of the single words,
    ``word`` and ``lang`` say which; an n-gram is the (n-1)-gram ``head`` and the single word ``last``. Level n-1 has n words."""

    words: pa.Array
    langs: list[str]
    word: np.ndarray
    lang: np.ndarray
    head: list[np.ndarray]
    last: list[np.ndarray]
    count: list[np.ndarray]

    def hashes(self) -> list[np.ndarray]:
        """A 64-bit number per n-gram and level, the same in every task."""
        data, offsets = column_data(self.words)
        of_words = span_hashes(data, offsets[:-1], offsets[1:])
        of_langs = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], np.uint64)
        single = _mixed(of_words[self.word] ^ (of_langs[self.lang] * np.uint64(0x9E3779B97F4A7C15)))
        out = [single]
        for head, last in zip(self.head, self.last):
            out.append(_mixed(out[-1][head] * np.uint64(0xD6E8FEB86659FD93) + single[last]))
        return out

    def texts(self, chosen: list[np.ndarray]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(words in it, phrase, language) of the n-grams with the indices ``chosen`` on each level."""
        for level, at in enumerate(chosen):
            parts, first = [], at
            for n in range(level, 0, -1):
                parts.append(self.last[n - 1][first])
                first = self.head[n - 1][first]
            columns = [self.words.take(pa.array(self.word[i])) for i in (first, *reversed(parts))]
            text = columns[0] if not level else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
            yield level + 1, text.cast(pa.large_string()).cast(pa.string()), self.lang[first]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _segments(data: np.ndarray, offsets: np.ndarray, longest: int, segment: int) -> Iterator[tuple[int, int, int]]:
    """(from, to, seen) about ``segment`` bytes each: n-grams that start in [from, to) are counted, and ``seen`` is far enough
    for their other words. No word is cut."""
    at = 0
    while at < len(data):
        to = min(len(data), at + segment)
        row_end = int(offsets[np.searchsorted(offsets, to)])  # to itself, if a row ends there
        while to < row_end and _KIND[data[to]] == WORD:
            window = _KIND[data[to:min(row_end, to + segment)]] != WORD
            to += int(window.argmax()) if window.any() else len(window)
        seen, size = to, 1 << 12
        while seen < row_end:  # until longest - 1 words have ended or a piece does
            seen = min(row_end, to + size)
            kind = _KIND[data[to:seen]]
            ends = np.flatnonzero((kind[:-1] == WORD) & (kind[1:] != WORD)) + 1
            stops = np.concatenate([np.flatnonzero(kind == BREAK)[:1], ends[longest - 2:longest - 1] if longest > 1 else ends[:0]])
            if len(stops):
                seen = to + int(stops.min())
                break
            size *= 4
        yield at, to, seen
        at = to


def grams(texts: pa.Array, langs: pa.Array, longest: int, segment: int) -> Iterator[Grams]:
    """The n-grams of up to ``longest`` words of a batch of texts, a segment at a time."""
    data, offsets = column_data(texts)
    coded = langs.fill_null("und").dictionary_encode() if len(langs) else None
    for at, to, seen in _segments(data, offsets, longest, segment):
        part = data[at:seen]
        kind = _KIND[part]
        inside = kind == WORD
        own = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, seen, side="right")] - at
        start, end = spans(inside, own)
        if not len(start):
            continue
        row = np.searchsorted(offsets, start + at, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(kind == BREAK), start) + row
        ends = np.concatenate([[0], np.cumsum(end - start)])
        spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(_LOWER[part[inside]])]).dictionary_encode()
        code = coded.indices.to_numpy()[row].astype(np.int64) * len(spelled.dictionary) + spelled.indices.to_numpy()
        counted = start < to - at  # what starts later belongs to the next segment
        single, index = np.unique(code, return_inverse=True)
        g = Grams(spelled.dictionary, coded.dictionary.to_pylist(), single % len(spelled.dictionary), single // len(spelled.dictionary), [], [],
                  [np.bincount(index[counted], minlength=len(single))])
        before = index
        for n in range(2, longest + 1):
            whole = piece[n - 1:] == piece[:len(piece) - n + 1]  # a piece's words follow each other
            first = np.flatnonzero(whole & counted[:len(whole)])
            code = before[first] * len(single) + index[first + n - 1]
            unique, which, count = np.unique(code, return_inverse=True, return_counts=True)
            g.head.append(unique // len(single))
            g.last.append(unique % len(single))
            g.count.append(count)
            before = np.zeros(len(start), np.int64)
            before[first] = which
        yield g


# ------------------------------------------------------------------ summaries
@dataclass(frozen=True)
class Layout:
    """``parts`` hash partitions, keys of ``bits`` bits in each; tasks count ``segment`` bytes at once and hold ``held`` n-grams."""

    parts: int
    bits: int
    segment: int = SEGMENT
    held: int = HELD

    def split(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole and fractional part of h * parts / 2^64: neither ever falls as h rises."""
        low = (h & np.uint64(2**32 - 1)) * np.uint64(self.parts)
        high = (h >> np.uint64(32)) * np.uint64(self.parts) + (low >> np.uint64(32))
        key = (high << np.uint64(32)) | (low & np.uint64(2**32 - 1))
        return (high >> np.uint64(32)).astype(np.int64), key >> np.uint64(64 - self.bits)


def encode(keys: np.ndarray) -> bytes:
    """Rising keys as differences, byte plane by byte plane, so that the planes that are nearly all zero compress."""
    step = np.diff(keys, prepend=np.uint64(0))
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max(1, (int(step.max()).bit_length() + 7) // 8) if len(step) else 1
    return planes[:used].tobytes()


def decode(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, n) if n else np.zeros((0, 0), np.uint8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :len(planes)] = planes.T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def narrow(counts: np.ndarray) -> bytes:
    """Counts in 1, 2, 4 or 8 bytes each, as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max())).newbyteorder("<")).tobytes()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary of at most ``capacity`` keys; merging keeps its bound: ``removed`` <= mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.removed = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > max(1 << 20, len(self.keys)):  # merging costs as much as it adds
            self.fold()

    def fold(self) -> None:
        keys, counts = (np.concatenate(z) for z in zip((self.keys, self.counts), *self.waiting))
        self.waiting, self.n_waiting = [], 0
        keys, counts = _summed(keys, counts)
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            off = int(np.partition(counts, at)[at])
            keys, counts = keys[counts > off], counts[counts > off] - off
            self.removed += off
        self.keys, self.counts = keys, counts

    def frequent(self, threshold: int) -> np.ndarray:
        """The keys whose count can be ``threshold``; none with that count is missing."""
        self.fold()
        return self.keys[self.counts + self.removed >= threshold]


def _summaries(batches: Iterator[pa.RecordBatch], layout: Layout, longest: int) -> Iterator[pa.RecordBatch]:
    """Rows (p, lang, mass, n, keys, counts): part of the task's summary of partition p; p = -1: mass words of a language."""
    n_words: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> Iterator[pa.RecordBatch]:
        h, count = _summed(*(np.concatenate(z) for z in zip(*held)))
        held.clear()
        part, key = layout.split(h)  # in order, as h is
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=layout.parts))
        rows = [(s, min(s + ROW_KEYS, e)) for a, e in zip(edges[:-1], edges[1:]) for s in range(a, e, ROW_KEYS)]
        for at in range(0, len(rows), 256):
            some = rows[at:at + 256]
            yield pa.RecordBatch.from_arrays([
                pa.array(part[[s for s, _ in some]], pa.int32()), pa.nulls(len(some), pa.string()), pa.array([int(count[s:e].sum()) for s, e in some]), pa.array([int(e - s) for s, e in some], pa.int32()),
                pa.array([encode(key[s:e]) for s, e in some]), pa.array([narrow(count[s:e]) for s, e in some])], names=["p", "lang", "mass", "n", "keys", "counts"])

    for batch in text_slices(batches, 0, layout.segment):
        for g in grams(batch.column(0), batch.column(1), longest, layout.segment):
            for lang, n in zip(g.langs, np.bincount(g.lang, weights=g.count[0], minlength=len(g.langs)).astype(np.int64).tolist()):
                n_words[lang] = n_words.get(lang, 0) + n
            h, count = np.concatenate(g.hashes()), np.concatenate(g.count)
            some = count > 0
            held.append((h[some], count[some].astype(np.int64)))
            if sum(len(k) for k, _ in held) > layout.held:
                yield from out()
    if held:
        yield from out()
    if n_words:
        none = pa.nulls(len(n_words), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([-1] * len(n_words), pa.int32()), pa.array(list(n_words)), pa.array(list(n_words.values())), pa.array([0] * len(n_words), pa.int32()), none, none],
                                         names=["p", "lang", "mass", "n", "keys", "counts"])


def _merged(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """(p, n, keys, filter): the survivors of each partition; rows come by p with the partition's ``total`` mass."""
    at, summary = None, Summary(0)

    def out() -> pa.RecordBatch:
        keys = summary.frequent(threshold)
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([encode(keys)]), pa.array([bloom(keys)])], names=["p", "n", "keys", "filter"])

    for batch in batches:
        for p, n, keys, counts, total in zip(*(batch.column(c).to_pylist() for c in ("p", "n", "keys", "counts", "total"))):
            if p != at:
                if at is not None:
                    yield out()
                at, summary = p, Summary(2 * total // threshold + 1)
            summary.add(decode(keys, n), np.frombuffer(counts, f"<u{len(counts) // n}").astype(np.int64))
    if at is not None:
        yield out()


# ------------------------------------------------------------------ the filter of survivors
def _bits(keys: np.ndarray, size: np.ndarray | np.uint64, probe: int) -> np.ndarray:
    return _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(probe * 0x632BE59BD9B4E019 % 2**64)) % size


def bloom(keys: np.ndarray) -> bytes:
    """16 bits a key and PROBES bits set for each."""
    bits = np.zeros(max(64, 16 * len(keys)), bool)
    for probe in range(PROBES):
        bits[_bits(keys, np.uint64(len(bits)), probe)] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Filter:
    """The filters of all partitions in one array; a partition without survivors has no bytes."""

    layout: Layout
    data: np.ndarray
    start: np.ndarray  # of each partition, and the end

    def passes(self, h: np.ndarray) -> np.ndarray:
        part, key = self.layout.split(h)
        size = (self.start[part + 1] - self.start[part]).astype(np.uint64) * np.uint64(8)
        ok = np.flatnonzero(size)
        for probe in range(PROBES):
            bit = _bits(key[ok], size[ok], probe)
            byte = self.data[self.start[part[ok]] + (bit >> np.uint64(3)).astype(np.int64)]
            ok = ok[(byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return ok


def _second(batches: Iterator[pa.RecordBatch], layout: Layout, longest: int, shared: Broadcast | None) -> Iterator[pa.RecordBatch]:
    """(lang, size, phrase, f) of a segment's n-grams that pass the filter, under their words; without a filter of all of
    them, with their (p, key)."""
    known = shared.value if shared else None
    for batch in text_slices(batches, 0, layout.segment):
        for g in grams(batch.column(0), batch.column(1), longest, layout.segment):
            hashes = g.hashes()
            chosen = [np.flatnonzero(c) if known is None else (ok := known.passes(h))[c[ok] > 0] for h, c in zip(hashes, g.count)]
            langs = pa.array(g.langs)
            for (size, phrase, lang), at, h, count in zip(g.texts(chosen), chosen, hashes, g.count):
                for s in range(0, len(at), 1 << 16):
                    cutout = slice(s, s + (1 << 16))
                    columns = [langs.take(pa.array(lang[cutout])), pa.array(np.full(len(at[cutout]), size, np.int32)), phrase[s:s + (1 << 16)], pa.array(count[at][cutout].astype(np.int64))]
                    names = ["lang", "size", "phrase", "f"]
                    if known is None:
                        part, key = layout.split(h[at][cutout])
                        columns, names = [pa.array(part, pa.int32()), pa.array(key.view(np.int64)), *columns], ["p", "key", *names]
                    yield pa.RecordBatch.from_arrays(columns, names=names)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p, n, keys in zip(*(batch.column(c).to_pylist() for c in ("p", "n", "keys"))):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, p, np.int32)), pa.array(decode(keys, n).view(np.int64))], names=["p", "key"])


def frequent_phrases(docs: DataFrame, threshold: int = 10, longest: int = 3, text_col: str = "text", lang_col: str | None = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, words): ``phrases(lang, size, phrase, f)`` are all n-grams of 1 to ``longest`` words that occur ``threshold``
    times or more in their language, with their exact counts; ``words(lang, n)`` the number of word occurrences.

    A-Z are lower-cased; texts are cut into pieces at ``. , ; : ! ?``, line feeds, vertical tabs, form feeds and carriage
    returns, pieces into words at spaces and tabs, and an n-gram stays inside its piece. A null text is empty and a null
    language ``und``; repeated rows count again; other columns are ignored; an empty table gives empty results. A text may be
    of any length; the longest single word must fit in a task.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), (F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")).alias("lang"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    mass = max(1, longest * (size + 1) // 2)  # occurrences at most
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass // PARTITION_MASS))
    layout = Layout(parts, min(60, max(16, (mass // parts).bit_length() + 2)), SEGMENT, HELD)  # keys: 2 bits more than it takes to number them
    first = cut(texts.mapInArrow(partial(_summaries, layout=layout, longest=longest), "p int, lang string, mass long, n int, keys binary, counts binary"))
    words = first.where("p < 0").groupBy("lang").agg(F.sum("mass").alias("n"))
    own = first.where("p >= 0")
    totals = F.broadcast(own.groupBy("p").agg(F.sum("mass").alias("total")))  # a row per hash partition
    dealt = own.join(totals, "p").repartition(parts, "p").sortWithinPartitions("p").select("p", "n", "keys", "counts", "total")
    merged = cut(dealt.mapInArrow(partial(_merged, threshold=threshold), "p int, n long, keys binary, filter binary")).where("n > 0")
    second = partial(_second, layout=layout, longest=longest)
    schema = "lang string, size int, phrase string, f long"
    if merged.agg(F.coalesce(F.sum(F.octet_length("filter").cast("long")), F.lit(0))).first()[0] <= FILTER_BYTES:
        rows = merged.select("p", "filter").toArrow().sort_by("p")
        sizes = np.zeros(parts + 1, np.int64)
        blobs = rows.column("filter").to_pylist()
        sizes[np.array(rows.column("p").to_pylist(), int) + 1] = [len(b) for b in blobs]
        shared = spark.sparkContext.broadcast(Filter(layout, np.frombuffer(b"".join(blobs), np.uint8), np.cumsum(sizes)))
        passed = texts.mapInArrow(partial(second, shared=shared), schema)
    else:
        keys = merged.select("p", "n", "keys").mapInArrow(_listed, "p int, key long")
        passed = texts.mapInArrow(partial(second, shared=None), f"p int, key long, {schema}").groupBy("p", "key", "lang", "size", "phrase").agg(F.sum("f").alias("f")).join(keys, ["p", "key"], "left_semi")
    phrases = passed.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= threshold)
    return cut(phrases), cut(words)


# ------------------------------------------------------------------ scores
def _with_count(cuts: DataFrame, part: str, phrases: DataFrame, hot: DataFrame, name: str) -> DataFrame:
    """``cuts`` with the count of the phrase in column ``part``; the parts that many phrases share are joined by broadcast."""
    named = [x.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)) for x in (hot, phrases)]
    rest = cuts.join(F.broadcast(named[0].drop(name)), ["lang", part], "left_anti")
    return cuts.join(F.broadcast(named[0]), ["lang", part]).unionByName(rest.join(named[1], ["lang", part]))


def collocations(docs: DataFrame, threshold: int = 10, longest: int = 3, top: int = 2000, covered: int = 50, text_col: str = "text",
                 lang_col: str | None = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of 2 to ``longest`` words.

    a is the phrase's count, ``threshold`` at least; cut after its first k words, l and r are the counts of the two parts and
    the score floor(1000000 * a * a / (l * r)); the cut of the lowest score counts, of equal ones the first. n is the
    language's number of words. A phrase that lies inside a longer one of at least ``covered`` percent of its count is left
    out. Ranks are by score and a, falling, then by the phrase's bytes. Arithmetic is exact. See ``frequent_phrases`` for words
    and for texts that are null, empty or long.
    """
    phrases, words = frequent_phrases(docs, threshold, longest, text_col, lang_col)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = cut(phrases.where(F.col("f") > total // SHARE).select("lang", "phrase", "f"))
    split = F.split("phrase", " ")
    candidates = phrases.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), split.alias("w"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda s: F.array_join(F.slice("w", s, m), " "))))
    inside = candidates.where("size > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").where(F.expr(f"longer is null or longer * 100 < a * {int(covered)}")).drop("longer")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.col("size") - k), " ").alias("right")))).alias("c"))
    cuts = cuts.select("lang", "phrase", "a", "c.k", "c.left", "c.right")
    counted = _with_count(_with_count(cuts, "left", phrases, hot, "l"), "right", phrases, hot, "r")
    wide = {x: F.col(x).cast("decimal(15,0)") for x in "alr"}
    exact = counted.select("lang", "phrase", "a", "k", "l", "r", (wide["a"] * wide["a"] * F.lit(1000000).cast("decimal(7,0)")).alias("up"), (wide["l"] * wide["r"]).alias("down"))
    scored = exact.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.score", "s.l", "s.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    spread = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = scored.withColumn("rank", F.row_number().over(spread)).where(F.col("rank") <= top)  # a language's last task gets 64 lists
    ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
