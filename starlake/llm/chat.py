"""Chat formatting as a prefix tree: shared first turns are merged and written once, depth first.

Template. A turn is ``<|turn|>role<|text|>text<|end|>`` and a line feed. Inside roles and texts a backslash,
``<`` and ``[`` become backslash + b, l, i; control strings (these marks, ``<s>``, ``</s>``, ``[INST]``, ...)
all begin with ``<`` or ``[``, so none can occur in a text, and the escapes read back exactly.

Tree. A node is a turn after a given prefix of turns. Every turn has a 16-byte hash, a conversation's sort
key is its turns' hashes in order, and sorting by the key is a depth-first walk: a conversation adds the
nodes beyond the prefix it shares with the one before it. Spark range-partitions and sorts the keys, so a
first turn that a third of all conversations share is spread over many tasks; each task walks its range
with a stack of one path, and a scan over one summary per partition (the first and last path) joins the
ranges into one gapless layout, in which each shared token has one place.

Per node: its tokens, start in the layout, position ids (counted from the conversation's begin), the loss
mask (an assistant's text, without marks) and the intervals of the layout that hold its ancestors, which it
attends to besides its own earlier tokens.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .tokens import byte_encoder

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
_ESCAPES = {"\\": "\\b", "<": "\\l", "[": "\\i"}
_PLAIN = {v: k for k, v in _ESCAPES.items()}
_READ = re.compile(r"<\|turn\|>([^<]*)<\|text\|>([^<]*)<\|end\|>\n")


def escape(text: str) -> str:
    return re.sub(r"[\\<\[]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[bli]", lambda m: _PLAIN[m[0]], text)


def _hash(*parts: bytes) -> bytes:
    h = blake2b(digest_size=16)
    for p in parts:
        h.update(len(p).to_bytes(8, "little"))
        h.update(p)
    return h.digest()


def conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, key, node, turns)``: one row per conversation; node is the hash of its whole path."""
    grouped = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))).alias("t"))
    kind = rows.schema[conv_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                key, node = [], []
                for turns in b.column(1).to_pylist():
                    hashes = [_hash(t["role"].encode(), t["text"].encode()) for t in turns]
                    path = b""
                    for h in hashes:
                        path = _hash(path, h)
                    key.append(b"".join(hashes))
                    node.append(path)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key, pa.binary()), pa.array(node, pa.binary()), b.column(1)],
                                                 names=["conv_id", "key", "node", "turns"])

    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")).mapInArrow(
        run, f"conv_id {kind}, key binary, node binary, turns array<struct<role: string, text: string>>")


_WALK = ("part int, at long, node binary, parent binary, depth int, chars long, loss_from int, loss_to int, local long, ids array<int>, "
         "up array<long>, up_len array<long>, firsts array<binary>, first_len array<long>, lasts array<binary>")


def _walk(tokenizer: str, pattern: str):
    """Walk one sorted range of (key, turns): its new nodes at local places, then a summary (at = -1)."""
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()),
             pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.binary())]
    names = [c.split(" ")[0] for c in _WALK.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_encoder(tokenizer, pattern), TaskContext.get().partitionId()
        stack: list[tuple[bytes, bytes, int, int]] = []  # turn hash, node, local place, tokens
        firsts: list[tuple[bytes, int]] | None = None
        at = place = size = 0
        rows: list[tuple] = []
        for big in batches:
            for k in range(0, big.num_rows, 256):
                b = big.slice(k, 256)
                for key, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    same = 0
                    while same < len(stack) and same < len(turns) and key[16 * same: 16 * same + 16] == stack[same][0]:
                        same += 1
                    del stack[same:]
                    for depth in range(same, len(turns)):
                        role, text = escape(turns[depth]["role"]), escape(turns[depth]["text"])
                        head, body, tail = (encoder.ids(x) for x in (TURN + role + TEXT, text, END))
                        ids = np.concatenate([head, body, tail]).astype(np.int32)
                        loss = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
                        parent = stack[-1][1] if stack else b""
                        h = key[16 * depth: 16 * depth + 16]
                        node = _hash(parent, h)
                        rows.append((part, at, node, parent, depth, len(TURN + role + TEXT + text + END), *loss, place, ids,
                                     [s[2] for s in stack], [s[3] for s in stack], None, None, None))
                        stack.append((h, node, place, len(ids)))
                        place += len(ids)
                        at += 1
                        size += len(ids)
                        if size > 1 << 18:
                            yield batch(rows)
                            rows, size = [], 0
                    if firsts is None:
                        firsts = [(s[1], s[3]) for s in stack]
        if firsts is not None:
            rows.append((part, -1, None, None, None, None, None, None, place, None, [s[2] for s in stack], [s[3] for s in stack],
                         [f[0] for f in firsts], [f[1] for f in firsts], [s[1] for s in stack]))
            yield batch(rows)

    return run


def tree(convs: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """Nodes of all ``convs(key, turns)`` in one depth-first layout.

    ``(node, parent, depth, start, length, position, ids, position_ids, loss_from, loss_to, chars, ancestors,
    intervals)``: position is the first token's position id, loss_from/loss_to the node's tokens under the
    loss mask, ancestors the starts of the ancestors' tokens from the root on, intervals their places joined
    where they touch. ``parent`` is empty for a first turn.
    """
    ordered = (convs.groupBy("key").agg(F.first("turns").alias("turns")).where(F.size("turns") > 0)
               .repartitionByRange("key").sortWithinPartitions("key"))
    walked = cut(ordered.select("key", "turns").mapInArrow(_walk(tokenizer, pattern), _WALK))
    place: dict[int, tuple[int, int, list[int]]] = {}  # part: (shift, shared tokens, places of the shared nodes)
    base, nodes, starts = 0, [], []
    for s in walked.where("at = -1").orderBy("part").collect():  # one row per partition
        shared = 0
        while shared < min(len(nodes), len(s.firsts)) and bytes(s.firsts[shared]) == nodes[shared]:
            shared += 1
        skip = sum(s.first_len[:shared])
        place[s.part] = (base - skip, skip, starts[:shared])
        nodes = [bytes(x) for x in s.lasts]
        starts = [starts[k] if x < skip else x + base - skip for k, x in enumerate(s.up)]
        base += s.local - skip

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for part, local, up, up_len in zip(*(b.column(i).to_pylist() for i in range(4))):
                shift, skip, known = place[part]
                if local < skip:  # written by an earlier range
                    out.append((None, None, None, None))
                    continue
                places = [known[k] if x < skip else x + shift for k, x in enumerate(up)]
                joined: list[dict[str, int]] = []
                for x, n in zip(places, up_len):
                    if joined and joined[-1]["end"] == x:
                        joined[-1]["end"] = x + n
                    else:
                        joined.append({"start": x, "end": x + n})
                out.append((local + shift, sum(up_len), places, joined))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            got = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.list_(pa.int64()), span))] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([*got, *[b.column(i) for i in range(4, b.num_columns)]],
                                                 names=["start", "position", "ancestors", "intervals", *b.schema.names[4:]])

    rest = "node binary, parent binary, depth int, chars long, loss_from int, loss_to int, ids array<int>"
    placed = walked.where("at >= 0").select("part", "local", "up", "up_len", *[c.split(" ")[0] for c in rest.split(", ")]).mapInArrow(
        run, f"start long, position long, ancestors array<long>, intervals array<struct<start: long, `end`: long>>, {rest}")
    # position ids follow from position and length, so they aren't stored
    kept = cut(placed.where("start is not null").withColumn("length", F.size("ids")))
    return kept.select("node", "parent", "depth", "start", "length", "position", "ids",
                       F.sequence("position", F.col("position") + F.col("length") - 1).alias("position_ids"), "loss_from", "loss_to", "chars",
                       "ancestors", "intervals")


def read_back(convs: DataFrame, nodes: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """``(conv_id, turns, loss_text, formatted_chars)`` of every conversation, from the layout alone: a
    conversation is the tokens of its last node's ancestors and its own, read by their starts."""
    ends = nodes.join(convs.select("node").distinct(), "node").select("node", F.concat("ancestors", F.array("start")).alias("path"))
    parts = ends.select("node", F.posexplode("path").alias("at", "start"))
    texts = parts.join(nodes.select("start", "ids", "loss_from", "loss_to"), "start")
    whole = texts.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", "ids", "loss_from", "loss_to"))).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer, pattern)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                turns, loss, chars = [], [], []
                for parts in b.column(1).to_pylist():
                    text = "".join(encoder.text(p["ids"]) for p in parts)
                    turns.append([{"role": unescape(r), "text": unescape(t)} for r, t in _READ.findall(text)])
                    loss.append("".join(unescape(encoder.text(p["ids"][p["loss_from"]:p["loss_to"]])) for p in parts))
                    chars.append(len(text))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                                                  pa.array(loss, pa.string()), pa.array(chars, pa.int64())], names=["node", "turns", "loss_text", "formatted_chars"])

    read = cut(whole.mapInArrow(run, "node binary, turns array<struct<role: string, text: string>>, loss_text string, formatted_chars long"))
    return convs.select("conv_id", "node").join(read, "node").drop("node")


def format_chats(rows: DataFrame, tokenizer: str, pattern: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, nodes): each conversation's last node, and the tree.

    Turns are ordered by turn (null first), then role, then text; every row is a turn, repeated ones
    too. A null role or text is empty. Rows without a conv_id make one conversation with a null id.
    Columns other than the four named are ignored; an empty table gives empty results.
    """
    convs = cut(conversations(rows, conv_col, turn_col, role_col, text_col))
    return convs, tree(convs, tokenizer, pattern)


