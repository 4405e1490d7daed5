"""Whitening against plain numpy and exact integers over all rows."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starlake.llm import whitening


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def slow(rows, components):
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    z = np.array([[c - s / n for c, s in zip(v, sums)] for v in x])
    values, axes = np.linalg.eigh(z.T @ z / n)
    top = np.argsort(-values)[:components]
    return n, deviation, z @ axes[:, top] / np.sqrt(values[top]), values[top] / values.sum()


def vectors():
    rnd = np.random.default_rng(3)
    spread = np.linspace(0.5, 3, 9)
    v = [(rnd.standard_normal(9) * spread).tolist() for _ in range(200)]
    v += [v[4]] * 150 + [v[9]] * 3 + [[c + 1e-6 for c in v[11]]]  # copies, and a vector that may become one
    return list(enumerate(v))


@pytest.mark.parametrize("share", [1000, 2])
def test_equal_to_all_rows(spark, monkeypatch, share):
    monkeypatch.setattr(whitening, "SHARE", share)
    rows = vectors()
    got = {r.vec_id: r for r in whitening.whiten(table(spark, rows), components=6).collect()}
    n, deviation, white, explained = slow(rows, 6)
    assert sorted(got) == [i for i, _ in rows] and {r.n for r in got.values()} == {n}
    assert [got[i].deviation for i, _ in rows] == deviation
    mine = np.array([got[i].whitened for i, _ in rows])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-9
    assert np.allclose(got[0].explained, explained, rtol=1e-12)
    assert got[0].identity_error < 1e-10 and np.abs(mine.T @ mine / n - np.eye(6)).max() < 1e-10


def test_a_weight_of_one_fits_distinct_vectors(spark):
    rows = vectors()
    seen = {}
    for i, v in rows:
        seen.setdefault(tuple(math.floor(64 * float(np.float32(c))) for c in v), (i, v))
    got = {r.vec_id: r for r in whitening.whiten(table(spark, rows), components=4, weights="one").collect()}
    n, deviation, white, _ = slow(list(seen.values()), 4)
    mine = np.array([got[i].whitened for i, _ in seen.values()])
    assert got[0].n == n < len(rows) == len(got) and [got[i].deviation for i, _ in seen.values()] == deviation
    assert np.abs(np.abs(mine) - np.abs(white)).max() < 1e-9


def test_rows_without_part_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [0.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [0.0, 2.0]),
            (9, [3e16, 0.0]), (10, [4e16, 0.0])]
    named = table(spark, rows, "double").withColumn("w", F.lit("clash")).withColumn("x", F.lit(1)).withColumn("cls", F.lit(None))
    got = whitening.whiten(named).collect()
    assert sorted((r.vec_id for r in got), key=str) == [7, 8, 8, 9, None] and {len(r.whitened) for r in got} == {1}
    x = [[math.floor(64 * c) for c in v] for v in ([0.0, 0.0], [1.0, 0.0], [1.0, 0.0], [0.0, 2.0], [3e16, 0.0])]
    sums = [sum(c) for c in zip(*x)]
    assert all(r.deviation is None for r in got) and sum((5 * a - b) ** 2 for a, b in zip(x[0], sums)) >= 2**63


def test_large_entries_stay_exact(spark):
    rows = [(i, [i * 1e6, -i * 12345.678]) for i in range(12)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows, "double")).collect()}
    x = [[math.floor(64 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((12 * a - b) ** 2 for a, b in zip(v, sums)) for v in x]
    assert max(want) > 2**53 and [got[i] for i in range(12)] == [w if w < 2**63 else None for w in want]


def test_sums_beyond_a_long(spark):
    rows = [(i, [3e16 if i % 2 else 2.9e16]) for i in range(40)]
    got = whitening.whiten(table(spark, rows, "double")).collect()
    assert np.allclose(sorted(r.whitened[0] for r in got), [-1] * 20 + [1] * 20) or np.allclose(sorted(-r.whitened[0] for r in got), [-1] * 20 + [1] * 20)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_tables_without_vectors(spark, rows):
    assert whitening.whiten(table(spark, rows)).collect() == []


def test_equal_vectors_have_no_direction(spark):
    got = whitening.whiten(table(spark, [(i, [1.5, 2.5]) for i in range(4)])).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in got] == [([], [], 0, 0.0)] * 4
