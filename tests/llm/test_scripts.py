"""Words of any script against a walk over characters."""
import random
import unicodedata

import numpy as np
import pyarrow as pa

from starlake.llm import scripts


def slow_words(text):
    """(start, end, lower-case form) of each word, in code points."""
    out, open_, alone = [], False, False
    for k, c in enumerate(text):
        kind = unicodedata.category(c)[0]
        unspaced = any(a <= ord(c) <= b for a, b in scripts.UNSPACED)
        if kind not in "LNM" or ord(c) >= scripts.ASSIGNED or any(a <= ord(c) <= b for a, b in scripts.MODIFIERS):
            open_ = alone = False
            continue
        if not open_ or kind != "M" and (unspaced or alone):
            out.append([k, k, ""])
        if kind != "M" or unspaced:
            alone = unspaced
        else:
            alone = False
        open_ = True
        low = c.lower()
        out[-1][1] = k + 1
        out[-1][2] += low if len(low) == 1 and len(low.encode()) == len(c.encode()) else c
    return [tuple(x) for x in out]


def check(rows):
    w = scripts.script_words(pa.array(rows, pa.string()))
    got = list(zip(w.row.tolist(), w.points(w.start, w.row).tolist(), w.points(w.end, w.row).tolist()))
    data = w.data.tobytes()
    want = [(r, a, b) for r, t in enumerate(rows) for a, b, _ in slow_words(t or "")]
    assert got == want
    assert [data[a:b].decode() for a, b in zip(w.start, w.end)] == [x for t in rows for _, _, x in slow_words(t or "")]
    return w


def texts():
    rnd = random.Random(5)
    units = ["The", "é", "É", "×", "x9", "_", " ", "\u00a0", "\u3000", "日本", "。", "ไม่", "ก็", "한국", "Ж", "ß", "İ", "ﬀ", "\u0301", "😀", "❤\ufe0f", "𠀀", "𝒜", "a", "\u2019", "ｶﾞ"]
    return ["".join(rnd.choices(units, k=rnd.randint(0, 25))) for _ in range(400)]


def test_words_of_all_scripts(monkeypatch):
    rows = [*texts(), None, "", "Q" * 3000, "山" * 3000]
    whole = check(rows)
    monkeypatch.setattr(scripts, "SEGMENT", 40)
    assert np.array_equal(check(rows).hash, whole.hash)
    sliced = scripts.script_words(pa.array(rows, pa.string()).slice(10, 50))
    assert np.array_equal(sliced.hash, scripts.script_words(pa.array(rows[10:60])).hash)
    assert len(scripts.script_words(pa.array([], pa.string())).hash) == 0


def test_every_character_alone():
    check([chr(c) for c in range(0x20, 0x33000, 7) if not 0xD800 <= c < 0xE000])


def test_hash_follows_the_word():
    w = check(["The the THE", "x the", "山 the", "ÉA éa"])
    assert len({int(h) for h in w.hash}) == 4


def test_vocabulary():
    items, text = (scripts.script_words(pa.array(x)) for x in (["one two one", "水火"], ["Two 火 three", "", "one"]))
    v = scripts.Vocabulary(items)
    assert v.number.tolist() == [0, 1, 0, 2, 3]
    assert v.numbers(text, np.arange(4)).tolist() == [1, 3, -1, 0]
    assert scripts.Vocabulary(scripts.script_words(pa.array([""]))).numbers(text, np.arange(4)).tolist() == [-1] * 4
