"""Token pieces against whole-text encoding, gapless sequences, near-optimal plans."""
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starlake.llm import packing
from starlake.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def strange():
    rnd = random.Random(9)
    parts = ["The", "the,", "don't", "it's.", "..", "a...b", "ÉÀÿ", "İstanbul,", "ΣΑΣ", "日本語", "éa", "́", " ", "  ", "\n", "\t", " ", "\x1c", "1234", "x1,",
             "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b", "😀", "ŉ", "ſ,", "ﬁn", "Ⅷ", "ª.", "-", ",", ".", ",.", "x.,", "WORD!!", "Œuf,"]
    return ["", " ", "\n\n"] + ["".join(rnd.choices(parts, k=rnd.randint(1, 40))) for _ in range(400)] + [" ".join(rnd.choices(parts, k=30)) for _ in range(400)]


def test_word_encoder_equals_whole_texts():
    texts = strange()
    whole = Tokenizer.from_file(PATH)
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    for limit in (1_000_000, 200):  # the second empties its store again and again
        encoder = WordEncoder(PATH, limit)
        for at in range(0, len(texts), 50):
            got = encoder.column(pa.array(texts[at:at + 50]))
            assert [g.tolist() for g in got] == want[at:at + 50]


def test_segments_never_cut_a_word(monkeypatch):
    from starlake.llm import words
    monkeypatch.setattr(words, "SEGMENT", 64)
    texts = strange()[:200] + ["z" * 500 + " end"]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in WordEncoder(PATH).column(pa.array(texts))] == want


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_documents(docs_of):
    texts = dict(enumerate([None, "", "one two", "one two", "word " * 2047, "word " * 2048, "word " * 9000, "Überlang, " * 5000]))
    rows = packing.pack_documents(docs_of([*texts.items(), (2, "one two"), (None, "no id")]), PATH).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for d, t in [*texts.items(), (2, "one two"), (None, "no id")]:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(d, i, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for i, a in enumerate(range(0, len(ids), 2048))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    check(rows, 2048)
    assert packing.pack_documents(docs_of({}), PATH).collect() == []


def test_assembled_sequences_hold_the_documents(docs_of):
    texts = {i: f"some words of document {i}, " * (i * 40) for i in range(12)}
    packed = packing.pack_documents(docs_of(texts), PATH, capacity=512, with_ids=True)
    sequences = {r.sequence_id: r.ids for r in packing.assemble(packed).collect()}
    whole, got = Tokenizer.from_file(PATH), {}
    for r in sorted(packed.collect(), key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).extend(sequences[r.sequence_id][r.offset:r.offset + r.length])
    assert got == {d: [*whole.encode(t, add_special_tokens=False).ids, 0] for d, t in texts.items()}


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_tight(seed):
    rnd = random.Random(seed)
    capacity = 64
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for _ in range(400):
        counts[min(capacity, 1 + int(rnd.expovariate(0.05)))] += rnd.choice([1, 1, 2, 50])
    if seed == 5:
        counts[:] = 0
        counts[1], counts[33] = 1000, 7
    slots = packing.plan(counts.copy(), capacity)
    used, full = Counter(), Counter()
    for length, first, ranks, sequence, offset, copies in slots.tolist():
        assert first == used[length]  # ranks follow each other
        used[length] += ranks
        for q in range(ranks):
            full[sequence + q // copies] += length
    assert used == Counter({i: int(n) for i, n in enumerate(counts) if n})
    assert max(full.values()) <= capacity
    bound = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    assert len(full) <= bound * 1.02 + int(counts[capacity // 2 + 1:].sum() > bound) * counts[capacity // 2 + 1:].sum()


def test_hot_length_is_ranked_in_chunks(spark):
    items = spark.range(3000, numPartitions=7).selectExpr("id", "cast(if(id % 3 = 0, 1000, 1048) as long) as length", "id as _row", "-id as _Chunk")
    rows = packing.pack(items, 2048).collect()
    assert all(r._row == r.id == -r._Chunk for r in rows)  # columns of clashing names are kept
    assert sorted(r.id for r in rows) == list(range(3000))
    assert check(rows, 2048) == 2000  # 1000 full pairs, 1000 pieces of 1048 alone
