"""Ordinal quality classifier: cumulative-link regression on hashed text.

Ratings are grades 0..K-1. One weight per hashed feature is shared by all grades, and ordered
thresholds t_1 < ... < t_{K-1} cut the score s: P(grade >= k) = sigmoid(s - t_k). The expected grade
is the sum of these tails, and the tail probability of the wanted grade decides selection.

Features of a text: its distinct words (lower-cased A-Z, outer punctuation off), the first five bytes of
each, and shapes (upper case, trailing or lone punctuation, a word right after itself), one feature for each power of two that their
share among all words reaches. Only features that occur clearly and several times more often below some grade than from it on get a
weight (a one-sided two-proportion test), so a text is of the base grade unless something speaks against it,
however short or long it is. The model is fitted on at most ``max_labelled`` labelled documents, taken by the hash of their id;
everything else is scored, whole texts, in one pass.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, text_slices

EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
REPEAT = 0  # the shape of a word that equals the one before it
SHARES = 8  # shape shares from 1 down to 1/128 in powers of two


@dataclass(frozen=True)
class Settings:
    bits: int = 30
    max_labelled: int = 6000
    min_docs: int = 6
    evidence: float = 4.0  # standard errors of the two-proportion test
    lift: float = 8.0  # least ratio of the two proportions
    share: float = 0.015  # least proportion below the grade
    l2: float = 0.3
    steps: int = 250
    rate: float = 0.08
    grade: int = 2
    least: float = 0.5


@dataclass
class Model:
    """Weights by hashed feature: the features that got one, in order, and their weights."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    settings: Settings

    def tails(self, score: np.ndarray) -> np.ndarray:
        """(rows, K-1): P(grade >= k) for k = 1..K-1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


class Features:
    """Hashed features of a text; what a word contributes is kept in a bounded cache.

    With ``wanted``, only those features are returned.
    """

    def __init__(self, bits: int, wanted: set[int] | None = None, limit: int = 100_000):
        self.mask, self.wanted, self.limit = (1 << bits) - 1, wanted, limit
        self.words: dict[bytes, tuple[tuple[int, int] | None, int]] = {}

    def word(self, raw: bytes) -> tuple[tuple[int, int] | None, int]:
        """((feature of the word, of its prefix) or None if neither is wanted, shape or -1)."""
        got = self.words.get(raw)
        if got is None:
            core = raw.strip(EDGES).lower()
            tail = raw[len(raw.rstrip(EDGES)):] if core else raw[:3]
            upper = len(core) > 1 and raw.upper() == raw and raw.lower() != raw
            shape = -1
            if upper or (tail and tail not in (b",", b".")):
                shape = crc32(bytes([upper]) + tail[:4], 11)
            pair = (crc32(core, 1) & self.mask, crc32(core[:5], 2) & self.mask)
            got = (pair if self.wanted is None or not self.wanted.isdisjoint(pair) else None, shape)
            if len(raw) <= 64:
                if len(self.words) >= self.limit:
                    self.words.clear()
                self.words[raw] = got
        return got

    def text(self, text: bytes) -> list[int]:
        words = text.split()
        n, cores, shapes = len(words), set(), Counter()
        for w, c in Counter(words).items():
            pair, shape = self.word(w)
            if pair:
                cores.add(pair)
            if shape >= 0:
                shapes[shape] += c
        shapes[REPEAT] = sum(map(eq, words, words[1:]))
        found = [f for pair in cores for f in pair]
        found += [crc32(b"%d:%d" % (s, level), 3) & self.mask for s, c in shapes.items() if c
                  for level in range(max(0, SHARES - (n // c).bit_length()) + 1)]
        return found if self.wanted is None else [f for f in found if f in self.wanted]


def _sparse(docs: DataFrame, bits: int) -> DataFrame:
    """``(grade, features)`` of the sampled rows: distinct features with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features(bits)
        for b in text_slices(batches, 1):
            got = [Counter(f.text(t)) for t in column_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([list(g) for g in got], pa.list_(pa.int32())),
                                              pa.array([list(g.values()) for g in got], pa.list_(pa.int32()))], names=["grade", "f", "c"])

    return docs.select("grade", "text").mapInArrow(run, "grade int, f array<int>, c array<int>")


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> Model:
    """Fit on ``ratings(id_col, grade)``; the lowest grade counts where a document or a text has several.

    Null ids or grades and ratings without a document are ignored. Without any rating the thresholds
    stay below 0, the score of a text with no evidence, and every text is kept.
    """
    s = settings
    sample = (ratings.where(F.col(id_col).isNotNull() & F.col("grade").isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
              .agg(F.min("grade").cast("int").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_labelled))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rated = texts.join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.min("grade").alias("grade"))  # copies are one case
    rows = _sparse(rated, s.bits).toArrow().combine_chunks()  # at most max_labelled documents
    kinds = s.grade + 1
    if not rows.num_rows:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), np.arange(1, kinds, dtype=float) - kinds, s)
    y = rows.column("grade").to_numpy().clip(0, kinds - 1)
    size = pa.compute.list_value_length(rows.column("f")).to_numpy()
    names, feature = np.unique(pa.compute.list_flatten(rows.column("f")).to_numpy(), return_inverse=True)
    value = np.log1p(pa.compute.list_flatten(rows.column("c")).to_numpy().astype(float))
    doc = np.repeat(np.arange(len(y)), size)
    seen = np.bincount(feature, minlength=len(names))
    telling = np.zeros(len(names), dtype=bool)
    for k in range(1, kinds):
        below = y < k
        n_b, n_a = max(1, below.sum()), max(1, (~below).sum())
        low = np.bincount(feature, weights=below[doc], minlength=len(names))
        p = np.clip(seen / len(y), 1e-9, 1 - 1e-9)
        telling |= (((low / n_b - (seen - low) / n_a) >= s.evidence * np.sqrt(p * (1 - p) * (1 / n_b + 1 / n_a)))
                    & (low / n_b >= np.maximum(s.share, s.lift * (seen - low + 0.5) / n_a)))
    keep = (telling & (seen >= min(s.min_docs, max(1, len(y) // 50))))[feature]
    used, at = np.unique(feature[keep], return_inverse=True)
    doc, value = doc[keep], value[keep]
    w, gap = np.zeros(len(used)), np.zeros(kinds - 1)  # gap: first threshold, then logs of the steps

    def thresholds() -> np.ndarray:
        return gap[0] + np.concatenate(([0.0], np.cumsum(np.exp(gap[1:]))))

    mw, vw, mg, vg = np.zeros_like(w), np.zeros_like(w), np.zeros_like(gap), np.zeros_like(gap)
    for step in range(1, s.steps + 1):
        score = np.bincount(doc, weights=w[at] * value, minlength=len(y))
        t = np.concatenate(([-np.inf], thresholds(), [np.inf]))
        hi, lo = 1 / (1 + np.exp(np.clip(score - t[y + 1], -500, 500))), 1 / (1 + np.exp(np.clip(score - t[y], -500, 500)))
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
        d_score = (d_hi - d_lo) / p  # of the negative log-likelihood
        g_t = np.zeros(kinds + 1)
        np.add.at(g_t, y + 1, -d_hi / p)
        np.add.at(g_t, y, d_lo / p)
        g_t = g_t[1:-1]
        g_gap = np.concatenate(([g_t.sum()], [np.exp(gap[k]) * g_t[k:].sum() for k in range(1, kinds - 1)])) / len(y) + 1e-4 * gap
        g_w = (np.bincount(at, weights=d_score[doc] * value, minlength=len(w)) + s.l2 * w) / len(y)
        for x, g, m, v in ((w, g_w, mw, vw), (gap, g_gap, mg, vg)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(names[used], w, thresholds(), s)


def _judge(model: Model):
    """A function from a text column to its scores and tails."""
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    f = Features(model.settings.bits, set(weight))

    def judge(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        s = np.array([sum(weight[x] * log1p(c) for x, c in Counter(f.text(t)).items()) for t in column_bytes(column)], dtype=float)
        return s, model.tails(s)

    return judge


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, expected_grade, tail, kept)``: one row per row of ``docs``.

    kept: the probability of grade ``settings.grade`` or better is at least ``settings.least``. A null
    text counts as empty, an empty one has score 0; repeated rows repeat; a null id is kept as null;
    other columns are ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model)
        for b in text_slices(batches, 1):
            s, tails = judge(b.column(1))
            tail = tails[:, model.settings.grade - 1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= model.settings.least)],
                                             names=["doc_id", "score", "expected_grade", "tail", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, expected_grade double, tail double, kept boolean")


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``score`` would mark kept; nothing is shuffled."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model)
        for b in text_slices(batches, at):
            tails = judge(b.column(at))[1]
            yield b.filter(pa.array(tails[:, model.settings.grade - 1] >= model.settings.least))

    return docs.mapInArrow(run, docs.schema)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades of the label table: 0 toxic, 1 of low quality, 2 good; a null flag counts as not set."""
    return labels.select("doc_id", F.when(F.coalesce("toxic", F.lit(0)) != 0, 0).otherwise(
        F.when(F.coalesce("quality", F.lit(0)) != 0, 2).otherwise(1)).alias("grade"))
