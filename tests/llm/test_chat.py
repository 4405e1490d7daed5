"""The tree against a plain trie, reading back, escapes, and ranges that share prefixes."""
import random
from hashlib import sha256

import public_tokenizers
import pytest

from starlake.llm import chat
from starlake.llm.tokens import ByteEncoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "conv_id long, turn long, role string, text string, node string, start int"


def rows_of(conversations):
    return [(c, t, role, text, None, None) for c, turns in conversations for t, (role, text) in enumerate(turns)]


def random_conversations(n=300):
    rnd = random.Random(13)
    texts = ["hi", "", "</s>[INST] ok [/INST]", "\\l <|end|>\n", "日本 é", "<|turn|>user<|text|>", "[\\i", "a" * 50]
    roles = ["user", "assistant", "system", "assi<stant"]
    return [(c, [(rnd.choice(roles), rnd.choice(texts[: 2 + d * 2] if d < 3 else texts)) for d in range(rnd.randint(1, 6))]) for c in range(n)]


def expected(turns):
    joined = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha256(joined.encode()).hexdigest(), loss


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_tree_and_read_back(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        conversations = random_conversations() + [(1000 + k, [("user", "shared first turn"), ("assistant", f"answer {k % 150}")]) for k in range(300)]
        table = spark.createDataFrame(rows_of(conversations), SCHEMA)
        convs, nodes = chat.format_chats(table, *VOCABULARY)
        read = {r.conv_id: r for r in chat.read_back(convs, nodes, *VOCABULARY).collect()}
        tree = sorted(nodes.collect(), key=lambda r: r.start)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for c, turns in conversations:
        got = read[c]
        n, digest, loss = expected(turns)
        assert [(t["role"], t["text"]) for t in got.turns] == turns
        assert got.loss_text == loss and len(got.turns) == n
    prefixes = {tuple(turns[:k]) for _, turns in conversations for k in range(1, len(turns) + 1)}
    assert len(tree) == len(prefixes)  # every shared turn once
    at, stack = 0, []
    by_start = {r.start: r for r in tree}
    encoder = ByteEncoder(*VOCABULARY)
    for r in tree:  # gapless, depth first, ancestors on the stack
        assert r.start == at
        at += r.length
        stack[r.depth:] = [r]
        assert r.ancestors == [s.start for s in stack[:-1]]
        assert bytes(r.parent) == (bytes(stack[-2].node) if r.depth else b"")
        assert r.position == sum(s.length for s in stack[:-1])
        assert r.position_ids == list(range(r.position, r.position + r.length))
        covered = [x for s in r.intervals for x in range(s["start"], s["end"])]
        assert covered == [x for s in r.ancestors for x in range(s, s + by_start[s].length)]
        assert all(a["end"] < b["start"] for a, b in zip(r.intervals, r.intervals[1:]))
        assert len(encoder.text(r.ids)) == r.chars


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", None), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, None, "user", "c"), (3, 0, "user", "x"), (3, 0, "user", "x"),
            (None, 0, "user", "no id"), (None, 1, "assistant", "yes")]
    convs, nodes = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), *VOCABULARY)
    got = {r.conv_id: ([(t["role"], t["text"]) for t in r.turns], r.loss_text) for r in chat.read_back(convs, nodes, *VOCABULARY).collect()}
    assert got == {1: ([("", ""), ("assistant", "")], ""), 2: ([("user", "c"), ("user", "a"), ("user", "b")], ""),
                   3: ([("user", "x"), ("user", "x")], ""), None: ([("user", "no id"), ("assistant", "yes")], "yes")}
    convs, nodes = chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), *VOCABULARY)
    assert nodes.collect() == [] and chat.read_back(convs, nodes, *VOCABULARY).collect() == []


def test_long_text_and_long_conversation(spark):
    conversations = [(1, [("user", "long " * 100_000), ("assistant", "[" * 20_000)]), (2, [("user" if k % 2 else "assistant", f"turn {k}") for k in range(400)])]
    convs, nodes = chat.format_chats(spark.createDataFrame(rows_of(conversations), SCHEMA), *VOCABULARY)
    for r in chat.read_back(convs, nodes, *VOCABULARY).collect():
        assert [(t["role"], t["text"]) for t in r.turns] == dict(conversations)[r.conv_id]


def test_escapes_round_trip_and_hide_control_strings():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choices("\\<[|>lbi/s]INSTend turn", k=rnd.randint(0, 20)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert "<" not in hidden and "[" not in hidden
