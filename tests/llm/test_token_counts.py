"""Offsets against the tokenizer's own, allocation against a loop over characters."""
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starlake.llm import token_counts as T
from starlake.llm.tokens import ByteEncoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_token_spans_equal_offsets():
    encoder, whole = ByteEncoder(*VOCABULARY), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    for text in ("", "plain words", "é日本語 😀😀 x", "<|endoftext|> a", "\n\n  tabs\t", "ﷺ" * 30):
        a, b = T.token_spans(text.encode(), encoder.ids(text), encoder.lengths)
        assert list(zip(a.tolist(), b.tolist())) == whole.encode(text, add_special_tokens=False).offsets


@pytest.mark.parametrize("rule", T.RULES)
def test_allocation(rule):
    rnd = random.Random(2)
    for _ in range(300):
        cuts = sorted(rnd.sample(range(60), 8))
        tokens = [(a, b) for a, b in zip(cuts, cuts[1:])] + [(cuts[0], cuts[0] + 1)]
        edges = sorted(rnd.sample(range(60), 2 * rnd.randint(0, 5)))
        sections = [(edges[i], edges[i + 1]) for i in range(0, len(edges), 2)]
        if sections and rnd.random() < 0.5:  # touching sections
            sections = [(a, b) for a, b in zip(edges, edges[1:])]
        count, crossing, outside = [0.0] * len(sections), [0] * len(sections), 0.0
        for a, b in tokens:
            over = [(min(b, e) - max(a, s), k) for k, (s, e) in enumerate(sections) if s < b and e > a]
            if not over:
                outside += 1
                continue
            if len(over) > 1 or over[0][0] < b - a:
                for _, k in over:
                    crossing[k] += 1
            if rule == "share":
                for n, k in over:
                    count[k] += n / (b - a)
                outside += 1 - sum(n for n, _ in over) / (b - a)
            else:
                count[max(over, key=lambda x: (x[0], -x[1]))[1] if rule == "most" else over[0][1]] += 1
        starts, ends = (np.array([s[i] for s in sections], dtype=np.int64) for i in (0, 1))
        got = T.allocate(*(np.array([t[i] for t in tokens]) for i in (0, 1)), starts, ends, rule)
        assert got[0].tolist() == pytest.approx(count) and got[1].tolist() == crossing and got[2] == pytest.approx(outside)


def test_counts_add_up(docs_of):
    texts = {1: "title here\nline two\n\n\n  last", 2: "é\n日本 words", 3: "", 4: None, 5: "one line", 6: "x" * 100_000 + "\n" + "word " * 50_000}
    rows = T.count_tokens(docs_of([*texts.items(), (5, "one line"), (None, "no id")]), *VOCABULARY).collect()
    encoder = ByteEncoder(*VOCABULARY)
    for d, n in ((1, 1), (2, 1), (5, 2), (6, 1), (None, 1)):
        text = texts.get(d) or "no id"
        for layer in ("line", "field"):
            own = [r for r in rows if r.doc_id == d and r.layer == layer]
            assert sum(r.n_tokens for r in own) == n * len(encoder.ids(text))
            assert sum(1 for r in own if r.section is None) == n
            assert "".join(text[r.start:r.end] for r in sorted((r for r in own if r.section is not None), key=lambda r: r.start)[::n]) == text
    assert [(r.layer, r.section, r.n_tokens) for r in rows if r.doc_id in (3, 4)] == [("", None, 0.0)] * 2
    assert T.count_tokens(docs_of({}), *VOCABULARY).collect() == []


def test_sections_from_a_table(spark, docs_of):
    sections = spark.createDataFrame([(1, "f", "a", 0, 3), (1, "f", "b", 3, 9), (1, "g", "all", 0, 9), (2, "f", "none", 4, 4), (None, "f", "x", 0, 1)],
                                     "doc_id long, layer string, name string, start int, end int")
    docs = docs_of({1: "wording x", 2: "text", 3: "other"})
    got = {(r.doc_id, r.layer, r.section): (r.n_tokens, r.n_crossing) for r in T.count_tokens(docs, *VOCABULARY, sections=sections).collect()}
    assert got[1, "f", "b"][0] + got[1, "f", "a"][0] == got[1, "g", "all"][0] == 3
    assert got[2, "f", None][0] == 1 and got[3, "", None][0] == 1 and (2, "f", "none") not in got


def test_bad_input(docs_of):
    with pytest.raises(ValueError):
        T.count_tokens(docs_of({1: "x"}), *VOCABULARY, rule="other")
    with pytest.raises(Exception, match="overlap"):
        T.count_tokens(docs_of({1: "abcdef"}), *VOCABULARY, sections=lambda t: [("a", "1", 0, 4), ("a", "2", 3, 6)]).collect()
