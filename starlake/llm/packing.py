"""Best-fit packing by exact-complement hashing over the histogram of lengths.

A sequence's content is a multiset of lengths, so the plan is made from the count of each length (at
most ``capacity`` numbers, however many documents): for each length from long to short, an index of the
available single lengths, pair sums and triple sums gives combinations that fill the gap exactly, and a
combination is consumed as often as all its counts allow; what no combination completes goes by best
fit. Every step uses up a length, so the plan has a few entries per length. Spark then ranks the pieces
of each length in chunks of bounded size and looks up each rank's sequence and offset.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, fresh, text_slices
from .tokens import word_encoder

CAPACITY = 2048


# ---- plan ------------------------------------------------------------------------------------------

class ComplementIndex:
    """Available lengths, and the sums that one, two or three of them make."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.sums: int | None = None  # bit s: two available lengths add up to s (or did, lately)

    def _pairs(self) -> int:
        have = sum(1 << int(x) for x in np.flatnonzero(self.left))
        sums = 0
        for x in np.flatnonzero(self.left).tolist():
            sums |= have << x
        return sums

    def times(self, lengths: list[int]) -> int:
        return min(int(self.left[x]) // n for x, n in Counter(lengths).items())

    def single(self, head: int, gap: int) -> list[int] | None:
        return [head, gap] if self.times([head, gap]) else None

    def pair(self, head: int, gap: int, used: list[int] | None = None) -> list[int] | None:
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        for x in a[(self.left[a] > 0) & (self.left[gap - a] > 0)].tolist():
            if self.times(found := [head, *(used or []), x, gap - x]):
                return found
        return None

    def triple(self, head: int, gap: int) -> list[int] | None:
        for fresh in (False, True):  # the index may be stale: a miss is certain, a hit is looked at
            if self.sums is None or fresh:
                self.sums = self._pairs()
            hit = False
            for x in np.flatnonzero(self.left[:gap])[::-1].tolist():
                if self.sums >> (gap - x) & 1:
                    hit = True
                    if found := self.pair(head, gap - x, [x]):
                        return found
            if not hit:
                return None
        return None

    def take(self, lengths: list[int], n: int) -> None:
        for x in lengths:
            self.left[x] -= n


def plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Slots (length, first rank, ranks, sequence, offset, copies) for ``counts[length]`` pieces.

    Rank q of the slot (q from 0) goes to sequence ``sequence + q // copies`` at
    ``offset + q % copies * length``.
    """
    index, slots, sequence, rank = ComplementIndex(counts), [], 0, np.zeros(capacity + 1, dtype=np.int64)

    def emit(lengths: list[int], n: int) -> None:
        nonlocal sequence
        offset = 0
        for x, copies in Counter(lengths).items():
            slots.append((x, rank[x], n * copies, sequence, offset, copies))
            rank[x] += n * copies
            offset += x * copies
        index.take(lengths, n)
        sequence += n

    for head in range(capacity, 0, -1):
        gap = capacity - head
        while index.left[head]:
            found = [head] if not gap else index.single(head, gap) or index.pair(head, gap) or index.triple(head, gap)
            if not found:
                break
            emit(found, index.times(found))
    for head in range(capacity, 0, -1):  # residuals
        while index.left[head]:
            lengths, gap = [head], capacity - head
            while gap:
                fit = np.flatnonzero(index.left[: gap + 1])[::-1]
                spare = next((x for x in fit.tolist() if index.left[x] > lengths.count(x)), None)
                if spare is None:
                    break
                copies = min(gap // spare, int(index.left[spare]) - lengths.count(spare))
                lengths += [spare] * copies
                gap -= spare * copies
            emit(lengths, index.times(lengths))
    return np.array(sorted(slots), dtype=np.int64).reshape(-1, 6)


# ---- pieces ----------------------------------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: a document is its ids, then ``end_id``; only
    one longer than ``capacity`` is cut, into full pieces and a last one that may be shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for b in text_slices(batches, 1):
            row, piece, start, size, crc, parts = [], [], [], [], [], []
            for i, ids in enumerate(encoder.column(b.column(1))):
                ids = np.append(ids.astype("<u4"), np.uint32(end_id))
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    size.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        parts.append(part.astype(np.int32))
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(parts, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (a column ``length`` of 1..capacity, any others) plus ``sequence_id`` and ``offset``.

    Every row goes to one sequence, sequences are gapless from 0 and at most ``capacity`` long. Equal
    lengths are told apart by the order in which the rows were first written, so the plan holds when a
    task is run again. An empty table gives an empty result.
    """
    own, chunk, first, inside, place = fresh(items.columns, "_row", "_chunk", "_first", "_in", "_rank")
    names = items.columns
    items = cut(items.withColumn(own, F.monotonically_increasing_id()))
    dealt = items.withColumn(chunk, F.shiftright(own, 16))  # at most 65,536 rows of a writing task
    per = cut(dealt.groupBy("length", chunk).agg(F.count(F.lit(1)).alias(inside)))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in per.groupBy("length").agg(F.sum(inside)).collect():  # at most capacity rows
        counts[length] = n
    slots = plan(counts, capacity)
    before = F.sum(inside).over(Window.partitionBy("length").orderBy(chunk)) - F.col(inside)
    within = F.row_number().over(Window.partitionBy("length", chunk).orderBy(own))
    # ranked rows already lie by length and chunk: a merge join moves the offsets only, and nothing that grows is broadcast
    ranked = dealt.withColumn(inside, within).join(per.select("length", chunk, before.alias(first)).hint("merge"), ["length", chunk])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", place))
            s = slots[np.searchsorted(keys, length * big + rank, side="right") - 1]
            q = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in names], pa.array(s[:, 3] + q // s[:, 5]),
                                              pa.array(s[:, 4] + q % s[:, 5] * length)], names=[*names, "sequence_id", "offset"])

    big = int(counts.max()) + 1
    keys = slots[:, 0] * big + slots[:, 1]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name != own)
    return ranked.select(*names, (F.col(first) + F.col(inside) - 1).alias(place)).mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences.

    A null or empty text is the end id alone; a null doc_id is kept; repeated rows are packed each;
    columns other than the two named are ignored; an empty table gives an empty result.
    """
    return pack(pieces(docs, tokenizer, id_col, text_col, capacity, with_ids=with_ids), capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, doc_ids, starts)``: the token sequences of a plan made with ``with_ids``."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))
