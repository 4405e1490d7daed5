"""Vectorised words against a regular expression over bytes."""
import random
import re

import numpy as np
import pyarrow as pa

from starlake.llm import words as W

RUN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def texts():
    rnd = random.Random(4)
    return ["".join(rnd.choices(["The ", "ÉA", "à", "×", "x9", "_", "-", " ", "\n", "日本", "Z"], k=rnd.randint(0, 30))) for _ in range(300)] + ["", "Q" * 5000]


def check(rows):
    w = W.words(pa.array(rows, pa.string()))
    want = [(i, m[0]) for i, t in enumerate(rows) for m in RUN.finditer((t or "").encode())]
    data = w.data.tobytes()
    assert [(int(r), data[a:b]) for r, a, b in zip(w.row, w.start, w.end)] == want
    low = [x.decode().translate({c: c + 32 for c in [*range(65, 91), *range(0xC0, 0xDF)] if c != 0xD7}) for _, x in want]
    known = {}
    for h, x in zip(w.hash.tolist(), low):
        assert known.setdefault(x, h) == h
    assert len(set(known.values())) == len(known)
    return w


def test_words(monkeypatch):
    rows = texts()
    whole = check([*rows, None, rows[0]])
    monkeypatch.setattr(W, "SEGMENT", 50)
    parts = check([*rows, None, rows[0]])
    assert np.array_equal(whole.hash, parts.hash)


def test_sliced_column_and_grams():
    rows = texts()
    col = pa.array(rows, pa.string()).slice(17, 90)
    w, other = W.words(col), W.words(pa.array(rows[17:107]))
    assert np.array_equal(w.hash, other.hash) and np.array_equal(w.row, other.row)
    at, g = W.grams(w, 3)
    want = [i for i in range(len(w.hash) - 2) if w.row[i] == w.row[i + 2]]
    assert at.tolist() == want
    by = {}
    for i, h in zip(at.tolist(), g.tolist()):
        assert by.setdefault(tuple(w.hash[i:i + 3].tolist()), h) == h
    assert len(set(by.values())) == len(by)


def test_points():
    rows = ["é日x abc", "", "ab é"]
    w = W.words(pa.array(rows))
    assert [rows[r][a:b] for r, a, b in zip(w.row, w.points(w.start, w.row), w.points(w.end, w.row))] == ["é日x", "abc", "ab", "é"]
