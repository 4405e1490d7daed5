"""Nearest neighbours against brute force over all rows."""
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from starlake.llm import ann


def tenth():
    return F.col("vec_id") % 10 == 0


def slow(rows, k):
    """{query: [(vec_id, distance)]} from every pair of rows (id, vector), by plain Python arithmetic."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, a in rows:
        if q % 10 == 0:
            near = sorted((float(np.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))), i) for i, b in rows if i != q and len(a) == len(b))
            out[q] = [(i, d) for d, i in near[:k]]
    return out


def answers(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def scattered():
    rnd = np.random.default_rng(5)
    v = list(rnd.standard_normal((500, 12)))
    for center in rnd.standard_normal((4, 12)):
        v += list(center + 0.1 * rnd.standard_normal((60, 12)))
    v += [v[0]] * 50 + [v[7]] * 300
    return [(i, x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("block", [512, 8])
def test_recall_and_exact_scores(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "PROBE_BLOCK", block)
    rows = scattered()
    got, want = answers(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tenth())), slow(rows, 10)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert recall(got, want) >= 0.9
    vector = dict(rows)
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (x[1], x[0]))
        assert all(d == pytest.approx(np.linalg.norm(np.subtract(vector[q], vector[i])), rel=1e-14) for i, d in near)


def test_all_neighbours_where_every_bucket_is_visited(spark):
    rows = scattered()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {q: [i for i, _ in near] for q, near in slow(rows, 10).items()}
    for s in (ann.EXHAUSTIVE, ann.Settings(2, 1, 1e6, 5)):
        assert {q: [i for i, _ in near] for q, near in answers(ann.nearest(table, tenth(), settings=s)).items()} == want


def test_copies_and_ties(spark):
    rows = [(i, [1.0, 2.0]) for i in range(100, 60, -1)] + [(1, [1.0, 3.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0]), (3, [2.0, 2.0])]
    got = answers(ann.nearest(spark.createDataFrame(rows, "vec_id int, embedding array<float>"), tenth(), k=45))
    copies = [(i, 0.0) for i in range(61, 101)]
    for q in (70, 80, 90, 100):
        assert got[q] == [c for c in copies if c[0] != q] + [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_queries_that_find_too_few_meet_all_rows(spark):
    rows = [(i, [float(i % 7), float(i // 7)]) for i in range(1, 50)] + [(50, [1e6, -1e6])]
    narrow = ann.Settings(2, 2, 0.01, 1)
    got, want = answers(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tenth(), settings=narrow)), slow(rows, 10)
    assert got == {q: [(i, pytest.approx(d)) for i, d in near] for q, near in want.items()}


def test_rows_without_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(10, None), (20, []), (30, [0.0, -0.0]), (40, [1.0, None]), (50, [nan, 1.0]), (60, [inf, 1.0]), (70, [1.0, 1.0]), (80, [1.0, 1.0, 5.0]), (1, [1.0, 2.0]),
            (None, [1.0, 2.0]), (None, [4.0, 5.0]), (90, [1e200, 0.0]), (100, [1.0, 1.0]), (100, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("d", F.lit("clash")).withColumn("node", F.lit(1))
    got = answers(ann.nearest(table, tenth(), k=3))
    assert got == {70: [(100, 0.0), (1, 1.0), (None, 1.0)], 100: [(70, 0.0), (1, 1.0), (None, 1.0)], 90: [(1, 1e200), (70, 1e200), (100, 1e200)]}


@pytest.mark.parametrize("rows", [[], [(3, [1.0])], [(10, [1.0])], [(10, None)]])
def test_tables_without_pairs(spark, rows):
    assert ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tenth()).collect() == []


def test_visits_come_in_rising_cost():
    inside = np.random.default_rng(2).uniform(0, 0.7, (5, 4))
    cost = ann.move_costs(inside, 0.7)
    moves, total = ann.visit_order(cost, 60)
    steps = range(-ann.REACH, ann.REACH + 1)
    for r in range(5):
        every = sorted(sum(cost[r, j, s + ann.REACH] for j, s in enumerate(move)) for move in itertools.product(steps, repeat=4))
        assert np.allclose(total[r], every[:60]) and len({tuple(m) for m in moves[r]}) == 60
        assert np.allclose([sum(cost[r, j, s + ann.REACH] for j, s in enumerate(m)) for m in moves[r]], total[r])
    assert (moves[:, 0] == 0).all()


def test_costs_are_squared_distances_to_the_slot():
    one = ann.move_costs(np.array([[0.2]]), 1.0)[0, 0]
    assert np.allclose(one, [1.2 ** 2, 0.2 ** 2, 0, 0.8 ** 2, 1.8 ** 2])
