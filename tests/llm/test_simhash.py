"""Fingerprints and classes against brute force; the plan's completeness; hot buckets."""
import random
from itertools import product

import numpy as np
import pytest
import xxhash

from starlake.llm import blocks, simhash


def slow_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(fp_of, max_bits):
    fps = sorted(set(fp_of.values()))
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                up[find(a)] = find(b)
    least = {}
    for d, f in fp_of.items():
        least[find(f)] = min(d, least.get(find(f), d))
    return {d: least[find(f)] for d, f in fp_of.items()}


def corpus():
    rnd = random.Random(3)
    vocabulary = ["Éa", "OF", "the", "wört", "x", "and", "Lorem", "ipsum", "dolor", "a b"]
    texts = [" ".join(rnd.choices(vocabulary, k=n)) for n in (0, 1, 2, 3, 4, 9, 40, 200, 3000) for _ in range(3)]
    base = rnd.choices([f"w{i}" for i in range(500)], k=400)
    for i in range(40):
        copy = list(base)
        copy[i] = "edit"
        texts.append("\t".join(copy))
    texts += [texts[7].upper(), texts[7], "", " \n\r\x0b ", "one", "ONE", "one two", "x" * 200_000, "y " * 50_000]
    return dict(enumerate(texts))


def test_fingerprints_and_classes(docs_of):
    texts = corpus()
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(texts)).collect()}
    fps = {d: slow_fingerprint(t) for d, t in texts.items()}
    assert {d: r.fp % 2**64 for d, r in got.items()} == fps
    assert {d: r.component_id for d, r in got.items()} == slow_classes(fps, 3)


def test_nulls_repeats_and_empty_table(docs_of):
    rows = [(5, None), (3, ""), (None, "  "), (7, "a b c d"), (7, "a b c d"), (None, "only null id here")]
    got = sorted(((r.doc_id, r.fp == 0, r.component_id) for r in simhash.near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == sorted([(5, True, 3), (3, True, 3), (None, True, 3), (7, False, 7), (7, False, 7), (None, False, None)], key=str)
    assert simhash.near_duplicates(docs_of({})).collect() == []


def test_hot_buckets_are_split_and_lose_no_link(docs_of, spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "PAIR_COST", 50.0)  # other thresholds than the usual
    rnd = np.random.default_rng(1)
    center = rnd.integers(0, 2**63, 4, dtype=np.uint64)
    fp = np.concatenate([c ^ (np.uint64(1) << rnd.integers(0, 64, 150, dtype=np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 150, dtype=np.uint64)) for c in center])
    fps = dict(enumerate(fp.tolist()))
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: spark.createDataFrame([(d, f - (f >> 63 << 64)) for d, f in fps.items()], "doc_id long, fp long"))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs_of({0: ""})).collect()}
    assert got == slow_classes(fps, 3)


@pytest.mark.parametrize("n, heavy", [(100, 0), (10**6, 0), (10**9, 0), (10**6, 1)])
def test_plan_is_complete(n, heavy):
    """Thresholds add up to max_bits - m + 1, so no spread of three differing bits escapes all partitions."""
    counts = np.array([[float(n) * n / 2**16 * w for w in (1, 16, 120, 560)] for _ in range(4)])
    if heavy:
        counts[0] = float(n) * n / 4
    parts = simhash.plan(counts, n, 3)
    probed = {c: (i, t) for i, (cs, t) in enumerate(parts) for c in cs}
    for spread in product(range(4), repeat=4):
        if sum(spread) <= 3:
            found = [0] * len(parts)
            for c, d in enumerate(spread):
                if c in probed:
                    found[probed[c][0]] += d
            assert any(found[i] <= t for i, (_, t) in enumerate(parts)), (parts, spread)


def test_small_pairs_are_all_pairs():
    group = np.array([1, 1, 1, 2, 3, 3, 4, 4, 4, 4])
    got = {(int(a), int(b)) for i, j in blocks.small_pairs(group, 3) for a, b in zip(i, j)}
    assert got == {(a, b) for a in range(10) for b in range(a + 1, 10) if group[a] == group[b] != 4}
