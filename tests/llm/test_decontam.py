"""Leaks against brute force alignment: exact, edited, common and split into blocks."""
import random

import pytest

from starlake.llm import decontam
from starlake.llm.decontam import Settings

from .test_scripts import slow_words


def slow_similarity(item, text):
    """Best Smith-Waterman score over a full match's."""
    a, b = ([w for _, _, w in slow_words(t or "")] for t in (item, text))
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best / (2 * len(a)) if a else 0.0


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    text = lambda n: rnd.choices(vocabulary, k=n)
    items = {i: text(rnd.randint(20, 60)) for i in range(30)}
    docs, leaks = {}, {}
    for d in range(200):
        words = text(rnd.choice([0, 5, 80, 400]))
        if d % 4 == 0:
            item = d // 4 % 30
            copy, kind = list(items[item]), d % 3
            if kind == 1:  # every eighth word edited
                copy = [w if k % 8 else f"e{k}" for k, w in enumerate(copy)]
            elif kind == 2:  # some words dropped and added
                copy = [w for k, w in enumerate(copy) if k % 9 != 4]
                copy.insert(len(copy) // 2, "added")
            at = rnd.randint(0, len(words))
            words[at:at] = copy
            leaks[d] = item
        docs[d] = " ".join(w.upper() if d % 5 == 0 else w for w in words)
    for d in range(200, 400):  # one passage in a great many documents
        docs[d] = " ".join(text(10) + items[29] + text(10))
        leaks[d] = 29
    return docs, {i: " ".join(w) for i, w in items.items()}, leaks


@pytest.mark.parametrize("block_words", [2_000_000, 300])
def test_leaks_equal_alignment(case, docs_of, spark, block_words):
    docs, items, leaks = case
    tests = spark.createDataFrame([(i, t, 1) for i, t in items.items()], "item_id long, text string, seeds int")
    rows = decontam.find_leaks(docs_of(docs), tests, settings=Settings(block_words=block_words, batch=16)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == set(leaks.items())
    for r in rows:
        assert r.similarity == pytest.approx(slow_similarity(items[r.item_id], docs[r.doc_id]))
        assert slow_similarity(items[r.item_id], docs[r.doc_id][r.start:r.end]) == pytest.approx(r.similarity)
    kept = decontam.clean(docs_of(docs), tests, settings=Settings(block_words=block_words))
    assert {r.doc_id for r in kept.collect()} == set(docs) - set(leaks)
    assert kept.columns == docs_of(docs).columns


def test_edge_cases(docs_of, spark):
    tests = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "two words"), (None, "null id of an item here")],
                                  "item_id long, text string")
    docs = docs_of([(1, None), (2, ""), (None, "so alpha beta gamma delta epsilon zeta."), (4, "two words"), (4, "two words"), (5, "Null id of an item here")])
    assert sorted(((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, tests).collect()), key=str) == [(4, 4), (4, 4), (5, None), (None, 1)]
    assert sorted(r.doc_id for r in decontam.clean(docs, tests).collect()) == [1, 2]
    assert decontam.find_leaks(docs_of({}), tests).collect() == []
    none = tests.where("false")
    assert decontam.find_leaks(docs, none).collect() == [] and decontam.clean(docs, none).count() == 6


def test_repeated_passages_in_a_long_document(docs_of, spark):
    item = "one two three four five six seven eight nine ten"
    text = " ".join([f"filler{i} " * 40 + item for i in range(50)])
    rows = decontam.find_leaks(docs_of({1: text}), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted(text[r.start:r.end] for r in rows) == [item] * 50


@pytest.mark.parametrize("copies", [0, 1, 10])
def test_edited_copies_alone_and_beside_exact_ones(docs_of, spark, copies):
    rnd = random.Random(3)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in (20, 40, 60)}
    noise = lambda: [f"n{rnd.randint(0, 500)}" for _ in range(30)]
    docs, leaks = {}, {}
    for n, item in items.items():
        for s in (3, 4, 5, 6):  # every s-th word replaced
            docs[len(docs)] = [w if k % s else f"e{rnd.randint(0, 500)}" for k, w in enumerate(item)]
            leaks[len(docs) - 1] = n
        docs[len(docs)] = [x for k, w in enumerate(item) for x in ([w, "more"] if k % 2 else [w])]  # a word added after every second
        leaks[len(docs) - 1] = n
        for _ in range(copies):
            docs[len(docs)] = item
            leaks[len(docs) - 1] = n
    docs = {d: " ".join([*noise(), *w, *noise()]) for d, w in docs.items()} | {-1: " ".join(noise())}
    texts = {n: " ".join(w) for n, w in items.items()}
    leaks = {(d, n) for d, n in leaks.items() if slow_similarity(texts[n], docs[d]) >= 0.5}
    assert len(leaks) >= 12
    rows = decontam.find_leaks(docs_of(docs), spark.createDataFrame(list(texts.items()), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks
    for r in rows:
        assert r.similarity == pytest.approx(slow_similarity(texts[r.item_id], docs[r.doc_id]))


@pytest.mark.parametrize("length, between", [(5, 0), (5, 5), (10, 0), (10, 1), (10, 3), (16, 0), (24, 0)])
def test_copies_that_follow_each_other(docs_of, spark, length, between):
    item = " ".join(f"w{k % 7}x{k // 2}" for k in range(length))
    text = " ".join(item + "".join(f" f{i}y{k}" for k in range(between)) for i in range(1000))
    short = " ".join(f"{item} {item.rsplit(None, 1)[0]} changed" for _ in range(3))  # whole and edited ones in turn
    rows = decontam.find_leaks(docs_of({1: text, 2: short}), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [text[r.start:r.end] for r in sorted(rows, key=lambda r: r.start) if r.doc_id == 1] == [item] * 1000
    assert [short[r.start:r.end] for r in sorted(rows, key=lambda r: r.start) if r.doc_id == 2] == [item, item.rsplit(None, 1)[0]] * 3


def leaks(docs_of, spark, docs, items, **settings):
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = decontam.find_leaks(docs_of(docs), tests, settings=Settings(**settings)).collect()
    kept = decontam.clean(docs_of(docs), tests, settings=Settings(**settings)).collect()
    assert {r.doc_id for r in kept} == set(docs) - {r.doc_id for r in rows}
    return rows


def test_exact_copies_in_any_script(docs_of, spark):
    items = {1: "研究人员在实验室里发现了一种全新的材料，它可以储存能量。", 2: "which\u00a0planet\u00a0has\u00a0the\u00a0most\u00a0moons\u00a0of\u00a0all",
             3: "the answer\u2014given by all of them\u2014was wrong", 4: "photosynthesis", 5: "Σίσυφος ΚΥΛΆ", 6: "ภาษาไทยไม่มีช่องว่าง", 7: "東京"}
    docs = {10: items[1], 11: f"前言。{items[1]}后记说了别的事情。", 12: "So: which planet has the most moons of all? Mine.", 13: f"x y {items[2]} z",
            14: "the answer given by all of them was wrong", 15: f"they say {items[3]}!", 16: "what is Photosynthesis, then", 17: "σίσυφοσ κυλά it",
            18: f"คำ{items[6]}นะ", 19: "我去了東京塔", 20: "京東 photo synthesis which moons the all", 21: "研究 完全 不同 的 内容"}
    want = {(10, 1), (11, 1), (12, 2), (13, 2), (14, 3), (15, 3), (16, 4), (18, 6), (19, 7)}
    rows = leaks(docs_of, spark, docs, items)
    assert {(r.doc_id, r.item_id) for r in rows if r.similarity == 1.0} - {(17, 5)} == want
    for r in rows:
        assert r.similarity == pytest.approx(slow_similarity(items[r.item_id], docs[r.doc_id]))
    assert docs[19][rows_of(rows, 19).start:rows_of(rows, 19).end] == "東京"


def rows_of(rows, doc):
    return next(r for r in rows if r.doc_id == doc)


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_mixed_scripts_equal_brute_force(docs_of, spark, block_words):
    rnd = random.Random(12)
    units = ["alpha ", "Beta-", "γάμα\u00a0", "дом ", "水", "火", "山、", "ひ", "ไม่", "7 ", "é\u2014", "\u200b", "…", "😀"]
    text = lambda n: "".join(rnd.choices(units, k=n))
    items = {k: text(rnd.choice([1, 2, 3, 8, 20])) for k in range(40)}
    docs = {k: text(rnd.choice([0, 4, 30])) + (items[rnd.randrange(40)] if k % 3 else "") + text(6) for k in range(80)}
    sizes = {i: len(slow_words(t)) for i, t in items.items()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if sizes[i] and slow_similarity(x, t) >= (0.5 if sizes[i] > 2 else 1)}
    assert {(r.doc_id, r.item_id) for r in leaks(docs_of, spark, docs, items, block_words=block_words)} == want
    assert {min(s, 3) for s in sizes.values()} == {0, 1, 2, 3}


def test_equal_items_share_a_block(docs_of, spark):
    items = {k: "one two three four five six" for k in range(50)} | {99: "seven eight nine ten"}
    rows = leaks(docs_of, spark, {1: "so one two three four five six", 2: "nothing"}, items, block_words=8)
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, k) for k in range(50)]
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert [len(b.ids) for b in decontam._blocks(tests, Settings())] == [2]


def test_equal_hashes_of_different_words(docs_of, spark, monkeypatch):
    """With a hash that tells words by their length only, bytes still keep them apart."""
    from starlake.llm import scripts
    from starlake.llm.words import Words
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(scripts, "span_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    items = scripts.script_words(pa.array(["aa bb cc aa dddd"]))
    v = scripts.Vocabulary(items)
    assert v.number.tolist() == [0, 1, 2, 0, 3]
    w: Words = scripts.script_words(pa.array(["cc xx bb", None, "dddd AA eeee f ggggg"]))
    assert v.numbers(w, np.arange(len(w.hash))).tolist() == [2, -1, 1, 3, 0, -1, -1, -1]
