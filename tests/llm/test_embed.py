"""Links and components against all pairs."""
import numpy as np
import pytest

from starlake.llm import embed


def vectors():
    rnd = np.random.default_rng(11)
    v = list(rnd.standard_normal((300, 16)))
    for center in rnd.standard_normal((5, 16)):
        v += list(center + 0.12 * rnd.standard_normal((60, 16)))
    v += [v[0]] * 40 + [v[3] * 1e-200, v[3] * 1e200, -v[3]]
    return [x.tolist() for x in v]


def slow(rows, least):
    x = np.array([r / np.abs(r).max() for r in np.array(rows)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = label.copy()
        a, b = np.nonzero(near)
        np.minimum.at(new, a, label[b])
        if (new == label).all():
            return near.sum(axis=1), label
        label = new


@pytest.mark.parametrize("block", [2048, 8])
def test_equal_to_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embed, "BLOCK", block)
    rows = vectors()
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, node int")
    got = {r.vec_id: r for r in embed.near_duplicates(table).collect()}
    n, label = slow(rows, 0.95)
    assert sum(n) > 1000
    found = sum(r.n_links for r in got.values())
    assert 0.99 * n.sum() <= found <= n.sum()
    assert all(got[i].n_links <= n[i] for i in got)
    if found == n.sum():
        assert [got[i].component_id for i in range(len(rows))] == label.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]),
            (None, [2.0, 2.0]), (9, [1.0, 1.0, 0.0]), (10, [-0.0, 5.0]), (11, [0.0, 5.0])]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()]
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9)]
    want += [(7, 3, 7, True), (8, 3, 7, False), (8, 3, 7, False), (None, 3, 7, False), (10, 1, 10, True), (11, 1, 10, False)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert embed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("n", [10, 10_000, 10**9])
def test_tuning_reaches_recall_at_the_threshold(n):
    bits, tables = embed.tuning(n, 0.95, 0.9995)
    assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** tables >= 0.9995
    assert n / 2**bits <= 16
