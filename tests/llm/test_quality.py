"""Held-out accuracy, ordered thresholds, and cases without evidence."""
import random

import numpy as np
import pytest

from starlake.llm import quality


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"word{i}" for i in range(2000)]
    bad = ["vileterm", "slurterm", "hateterm", "gross1x", "gross2y"]
    texts, grades = {}, {}
    for d in range(n):
        body = rnd.choices(words, k=rnd.choice([3, 30, 300]))
        grade = rnd.choices([0, 1, 2], [1, 2, 7])[0]
        if grade == 0:
            for w in rnd.sample(bad, 3):
                body.insert(rnd.randint(0, len(body)), w)
        elif grade == 1:
            kind = d % 3
            body = [w.upper() + "!!" for w in body] if kind == 0 else [w + " |" for w in body] if kind == 1 else [w for w in body[:10] for _ in range(8)]
        texts[d], grades[d] = " ".join(body), grade
    return texts, grades


def test_held_out_accuracy(docs_of, spark):
    texts, grades = corpus(2000, 1)
    ratings = spark.createDataFrame(list(grades.items()), "doc_id long, grade int").where("doc_id < 1200")
    model = quality.fit(docs_of(texts), ratings)
    assert (np.diff(model.thresholds) > 0).all()
    rows = {r.doc_id: r for r in quality.score(docs_of(texts), model).collect()}
    held = [(grades[d], rows[d]) for d in texts if d >= 1200]
    assert sum((g == 2) == r.kept for g, r in held) >= 0.98 * len(held)
    mean = [np.mean([r.expected_grade for g, r in held if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    kept = quality.keep(docs_of(texts), model)
    assert {r.doc_id for r in kept.collect()} == {d for d, r in rows.items() if r.kept}
    assert kept.columns == docs_of(texts).columns


def test_sample_is_bounded_and_refit_is_equal(docs_of, spark):
    texts, grades = corpus(600, 2)
    ratings = spark.createDataFrame([*grades.items(), (None, 1), (5, None), (10**9, 0)], "doc_id long, grade int")
    settings = quality.Settings(max_labelled=100)
    a, b = quality.fit(docs_of(texts), ratings, settings=settings), quality.fit(docs_of(texts).repartition(5), ratings, settings=settings)
    assert a.features.tolist() == b.features.tolist() and np.allclose(a.weights, b.weights)


def test_edge_cases(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    rows = docs_of([(1, None), (1, ""), (None, "some text"), (2, "w " * 300_000)])
    model = quality.fit(rows, none)
    got = quality.score(rows, model).collect()
    assert len(got) == 4 and all(r.kept for r in got)
    assert quality.keep(rows, model).count() == 4
    assert quality.score(docs_of({}), model).collect() == [] and quality.keep(docs_of({}), model).collect() == []
    one = spark.createDataFrame([(1, 2), (2, 2)], "doc_id long, grade int")
    assert all(r.kept for r in quality.score(rows, quality.fit(rows, one)).collect())


def test_ratings(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, None), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in quality.ratings(labels).collect()} == {1: 2, 2: 1, 3: 0, 4: 1, 5: 2}


@pytest.mark.parametrize("text, n", [(b"", 0), (b"one", 2), (b"!!", 2)])
def test_features_of_tiny_texts(text, n):
    assert len(quality.Features(30).text(text)) >= n
