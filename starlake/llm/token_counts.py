"""Token counts by offset-mapped attribution.

A document is encoded once, whole, by a byte-level BPE. As such a tokenizer keeps every byte, the running
sum of its tokens' byte lengths gives each token's bytes, and counting code points gives its characters
[start, end). Tokens are then interval-joined to the document's sections, layer by layer (a layer is a set of
sections that don't overlap, such as lines, or title and body). A token inside one section counts there. One
that crosses a section's edge is allocated by an explicit rule:

- ``most``: to the section that holds most of its characters, the earlier one on a tie;
- ``start``: to the section that holds its first character inside any section;
- ``share``: to every section it touches, by the share of its characters there; what lies in no section
  counts as outside.

Tokens that touch no section of a layer are outside, so a layer's counts add up to the document's tokens.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .tokens import byte_encoder

RULES = ("most", "start", "share")
Sections = list[tuple[str, str, int, int]]  # layer, name, start, end


def lines_and_fields(text: str) -> Sections:
    """Layer ``line``: the lines, each with its line feed; layer ``field``: title (the first line) and body."""
    out, at = [], 0
    parts = text.split("\n")
    for k, line in enumerate([p + "\n" for p in parts[:-1]] + [parts[-1]] * bool(parts[-1])):
        out.append(("line", str(k), at, at + len(line)))
        at += len(line)
    first = text.find("\n") + 1 or len(text)
    return out + [("field", name, a, b) for name, a, b in (("title", 0, first), ("body", first, len(text))) if b > a]


def token_spans(data: bytes, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points [start, end) that each token touches."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    heads = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(heads)))
    return before[starts] - ~heads[starts], before[ends]


def allocate(a: np.ndarray, b: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens of each section (sorted, not overlapping), crossing tokens that touch it, tokens outside."""
    n = len(starts)
    lo, hi = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
    touched = hi - lo
    crossing = np.zeros(n, dtype=np.int64)
    inside = touched == 1
    inside[inside] = (a[inside] >= starts[lo[inside]]) & (b[inside] <= ends[lo[inside]])
    count = np.bincount(lo[inside], minlength=n).astype(float)
    outside = float((touched <= 0).sum())
    cross = np.flatnonzero((touched > 0) & ~inside)
    best, owner = np.zeros(len(cross), dtype=np.int64), lo[cross].copy()
    for k in range(int(touched[cross].max()) if len(cross) else 0):
        on = np.flatnonzero(touched[cross] > k)
        s = lo[cross[on]] + k
        part = np.minimum(b[cross[on]], ends[s]) - np.maximum(a[cross[on]], starts[s])
        np.add.at(crossing, s, 1)
        if rule == "share":
            share = part / (b[cross[on]] - a[cross[on]])
            np.add.at(count, s, share)
            outside -= share.sum()
        elif rule == "most":
            more = part > best[on]
            best[on[more]], owner[on[more]] = part[more], s[more]
    if rule == "share":
        outside += len(cross)
    else:
        count += np.bincount(owner, minlength=n)
    return count, crossing, outside


def _count(tokenizer: str, pattern: str, rule: str, split: Callable[[str], Sections] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer, pattern)
        for b in text_slices(batches, 1):
            row: list[np.ndarray] = []
            cols: list[list] = [[] for _ in range(6)]  # layer, name, start, end, tokens, crossing
            given = b.column(2).to_pylist() if split is None else None
            for i, text in enumerate(b.column(1).to_pylist()):
                text = text or ""
                spans = token_spans(text.encode(), encoder.ids(text), encoder.lengths)
                sections = split(text) if split else [(s["layer"], s["name"], s["start"], s["end"]) for s in given[i] or []]
                layers: dict[str, list] = {}
                for s in sections:
                    layers.setdefault(s[0], []).append(s)
                size = 0
                for layer, own in (layers or {"": []}).items():
                    own = sorted((s for s in own if s[3] > s[2]), key=lambda s: s[2:])
                    start, end = (np.array([s[k] for s in own], dtype=np.int64) for k in (2, 3))
                    if (start[1:] < end[:-1]).any():
                        raise ValueError(f"sections of layer {layer!r} overlap")
                    count, crossing, outside = allocate(*spans, start, end, rule)
                    cols[0] += [layer] * (len(own) + 1)
                    cols[1] += [s[1] for s in own] + [None]
                    cols[2] += [start, np.array([-1])]
                    cols[3] += [end, np.array([-1])]
                    cols[4] += [count, np.array([outside])]
                    cols[5] += [crossing, np.array([0])]
                    size += len(own) + 1
                row.append(np.full(size, i))
            place = pa.array(np.concatenate(row))
            start, end = np.concatenate(cols[2]), np.concatenate(cols[3])
            none = start < 0
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(place), pa.array(cols[0]), pa.array(cols[1], pa.string()), pa.array(start, mask=none), pa.array(end, mask=none),
                 pa.array(np.round(np.concatenate(cols[4]), 9)), pa.array(np.concatenate(cols[5]))],
                names=["doc_id", "layer", "section", "start", "end", "n_tokens", "n_crossing"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, pattern: str, sections: Callable[[str], Sections] | DataFrame = lines_and_fields,
                 rule: str = "most", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, layer, section, start, end, n_tokens, n_crossing)``: a row per section, and per document
    and layer one with a null section for the tokens outside.

    ``sections`` finds a text's sections, or is a table (id_col, layer, name, start, end) that is grouped
    by document and joined to it. Starts and ends are code points, end exclusive; empty sections have no
    row; overlapping sections in one layer are an error. A null or empty text has no tokens and, with
    no section, one row with an empty layer. Repeated rows repeat; a null id is kept and gets no sections
    from a table; other columns are ignored; an empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = sections if callable(sections) else None
    if split is None:
        own = sections.groupBy(F.col(id_col).alias("doc_id")).agg(F.collect_list(F.struct(
            "layer", F.col("name").cast("string").alias("name"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))).alias("sections"))
        texts = texts.join(own, "doc_id", "left").select("doc_id", "text", "sections")
    return texts.mapInArrow(_count(tokenizer, pattern, rule, split),
                            f"doc_id {kind}, layer string, section string, start long, `end` long, n_tokens double, n_crossing long")
