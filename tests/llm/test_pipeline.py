"""The pipeline against its stages' operators and brute force, on a small table written to disk."""
import random
import re

import pytest

import corpus_pipeline
from tests.llm.test_simhash import slow_classes, slow_fingerprint


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd = random.Random(21)
    words = [f"w{i}" for i in range(4000)]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    items = {i: text(30) for i in range(6)}
    docs = {d: text(rnd.choice([5, 60, 300])) for d in range(300)}
    plan = {"bad": set(), "copies": {}, "leaks": set(), "secrets": set()}
    for d in range(300, 400):
        docs[d] = text(50) + " vileterm slurterm hateterm"
        plan["bad"].add(d)
    for d in range(400, 440):
        docs[d] = docs[d - 400]
        plan["copies"][d] = d - 400
    for d in range(440, 460):
        docs[d] = f"{text(40)} {items[d % 6]} {text(40)}"
        plan["leaks"].add(d)
    for d in range(460, 480):
        docs[d] = f"{text(40)} token = {'a1b2c3d4' * 4} {text(10)}"
        plan["secrets"].add(d)
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs.items()] + [(480, None, None, None, None), (None, text(30), "en", None, 1)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(d, 1, int(d in plan["bad"])) for d in docs if d % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), docs, plan


def test_stages(spark, sf_dir):
    path, texts, plan = sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], path)
        assert out.schema.simpleString() == docs.schema.simpleString()
        seen.append(corpus_pipeline.cut(out))
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert ids[0] - ids[1] == plan["bad"]
    fps = {d: slow_fingerprint(texts.get(d) or "") for d in ids[1] if d is not None}
    first = slow_classes(fps, 3)
    assert ids[1] - ids[2] == {d for d in fps if first[d] != d} and set(plan["copies"]) <= ids[1] - ids[2]
    assert ids[2] - ids[3] == plan["leaks"]
    assert ids[3] == ids[4] and None in ids[4]
    clean = {r.doc_id: r for r in seen[4].collect()}
    for d, r in clean.items():
        if d is not None and d < 480:
            want = re.sub("token = (a1b2c3d4){4}", "[SECRET]", texts[d])
            assert (r.text, r.n_chars) == (want, len(want))
    final = corpus_pipeline.STAGES[-1][1](spark, seen[4], path)
    assert {r.doc_id for r in final.collect()} == ids[4]
    whole = corpus_pipeline.run(spark, path)
    key = lambda rows: sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in rows.collect())
    assert key(whole) == key(final)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"),
                         ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_by_row(spark):
    rnd = random.Random(5)
    a, b, c, d = (" ".join(f"w{rnd.randint(0, 4000)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, c), (None, c), (None, d), (None, d), (5, None), (5, None)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row int")
    out = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, a), (2, b), (4, c), (None, d), (5, None)], key=str)
