"""Phrases against a plain count of all n-grams, and the summaries' guarantee."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starlake.llm import collocations as C


def slow_counts(rows, longest):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    return f, n


def slow(rows, threshold, longest, top, covered=50):
    f, n = slow_counts(rows, longest)
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= threshold}
    inside = defaultdict(int)
    for (lang, w), a in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inside[lang, w[i:i + size]] = max(inside[lang, w[i:i + size]], a)
    out = defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * inside[lang, w] >= covered * a:
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, lo, hi, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, lo, hi) in enumerate(sorted(found)[:top], 1))


def corpus(seed=1, size=400):
    rnd = random.Random(seed)
    vocabulary = ["New", "york", "city", "é", "日本", "a", "b", "the", "of", "Zürich", " x", "it's"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(size):
        words = rnd.choices(vocabulary, weights=[8] * 12 + [1] * 60, k=rnd.randint(0, 60))
        text = "".join(w + rnd.choices([" ", "\t", "  ", ". ", ",", "\n", "!? "], weights=[20, 2, 2, 2, 1, 1, 1])[0] for w in words)
        rows.append((rnd.choice(["en", "en", "en", "fr", None, ""]), text))
    rows += [("en", None), ("en", ""), ("fr", " . , \t")] + [("en", "strong tie strong tie")] * 30 + [("xx", "rare words here")] * 9
    return rows


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").withColumn("p", F.lit("clash")).withColumn("f", F.lit(1))


@pytest.mark.parametrize("segment,held,filter_bytes", [(1 << 22, 1 << 21, 1 << 26), (64, 500, 1 << 26), (1, 1 << 21, 0)])
def test_equal_to_plain_counts(spark, monkeypatch, segment, held, filter_bytes):
    monkeypatch.setattr(C, "SEGMENT", segment)
    monkeypatch.setattr(C, "HELD", held)
    monkeypatch.setattr(C, "FILTER_BYTES", filter_bytes)
    rows, threshold = (corpus(size=120), 4) if segment == 1 else (corpus(), 10)
    want = slow(rows, threshold, 3, 40)
    assert len(want) > 30 and got(C.collocations(frame(spark, rows), threshold, top=40)) == want


def test_other_lengths_and_thresholds(spark):
    rows = corpus(2, 300)
    assert got(C.collocations(frame(spark, rows), threshold=3, longest=4, top=100, covered=80)) == slow(rows, 3, 4, 100, 80)


def test_exact_counts_of_every_frequent_phrase(spark):
    rows = corpus(3, 200)
    f, n = slow_counts(rows, 2)
    phrases, words = C.frequent_phrases(frame(spark, rows), threshold=5, longest=2)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == {p: a for p, a in f.items() if a >= 5}
    assert {r.lang: r.n for r in words.collect()} == {k: v for k, v in n.items() if v}


def test_a_long_text_and_a_long_word(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 1000)
    rows = [("en", "one two three " * 5000), ("en", "x" * 30000 + " one two"), ("en", "ab cd." * 4000)]
    assert got(C.collocations(frame(spark, rows))) == slow(rows, 10, 3, 2000)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "")], [("en", ". , !")], [("en", "too few words")]])
def test_nothing_frequent(spark, rows):
    assert C.collocations(frame(spark, rows)).collect() == []


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 10**13
    phrases = spark.createDataFrame([("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big + 1), ("en", 2, "a b", big + 7)], "lang string, size int, phrase string, f long")
    words = spark.createDataFrame([("en", 5 * big)], "lang string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *a: (phrases, words))
    a, lo, hi = big + 7, 3 * big, 2 * big + 1
    assert got(C.collocations(phrases)) == [("en", 1, "a b", a, lo, hi, 5 * big, 1000000 * a * a // (lo * hi))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=12), st.integers(2, 12))
def test_summaries_lose_no_frequent_key(parts, threshold):
    total = Counter(k for part in parts for k in part)
    summary = C.Summary(sum(total.values()) // threshold + 1)
    for part in parts:
        count = Counter(part)
        keys = np.array(sorted(count), np.uint64)
        summary.add(keys, np.array([count[int(k)] for k in keys], np.int64))
        summary.fold()
        assert len(summary.keys) <= summary.capacity
    assert summary.removed < threshold
    assert {k for k, a in total.items() if a >= threshold} <= set(summary.frequent(threshold).tolist())


@given(st.sets(st.integers(0, 2**60 - 1), max_size=50))
def test_keys_survive_their_encoding(keys):
    rising = np.array(sorted(keys), np.uint64)
    assert C.decode(C.encode(rising), len(rising)).tolist() == rising.tolist()


def test_the_filter_passes_every_survivor():
    layout = C.Layout(7, 40)
    h = np.random.default_rng(4).integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    part, key = layout.split(h)
    chosen = part != 3
    blobs = [C.bloom(key[part == p]) if p != 3 else b"" for p in range(7)]
    known = C.Filter(layout, np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)]))
    assert known.passes(h).tolist() == np.flatnonzero(chosen).tolist()
    others = np.random.default_rng(5).integers(0, 2**63, 20000, dtype=np.uint64)
    assert len(known.passes(others)) < 0.02 * len(others)
