"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints. A text's A-Z are lower-cased, words are runs of other than ASCII white space, shingles
are ``k`` successive words joined by a space (repeats count; fewer than ``k`` words: the whole
sequence; none: fingerprint 0). Bit ``i`` is set if it is set in over half of the shingles' XXH64
(UTF-8, seed 42).

Search. The 64 bits are ordered so that correlated ones stand together and cut into four 16-bit
chunks; a plan groups the chunks into ``m`` partitions with thresholds t_1..t_m, each -1 or more, that
add up to ``max_bits - m + 1``. If two fingerprints differ in at most ``max_bits`` bits, at least one
partition i has at most t_i differing bits, so probing every partition's values within t_i bits misses
nothing. Among all groupings dynamic programming picks the thresholds of least estimated cost (probe
rows + candidate pairs); the candidate counts come from the chunks' value histograms (65,536 values
each, whatever the corpus). The plan changes the cost, never the result. Candidates are verified on the
full 64 bits inside blocked cells, a cell returns a spanning forest of its links, and distributed
contraction turns the forest into classes.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import INDEX, PROBE, Forest, grid, group_ids, large_groups, runs, small_pairs
from .common import column_bytes, cut, text_slices
from .components import connected_components

SEED = 42
CHUNK = 16
BLOCK = 4096
PAIR_COST = 0.02  # of a verified pair, against a probe row that is shuffled


def fingerprint(text: bytes, k: int) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= k:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n)) + np.arange(n)
    starts = np.concatenate(([0], ends[:-1] + 1))[: n - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    h = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = np.array([h(line[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * total > len(starts))
    return int(sum(1 << int(b) for b in bits))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(doc_id, fp)``: one row per row of ``docs``, fp the fingerprint's 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 1):
            fp = np.array([fingerprint(t, k) for t in column_bytes(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


# ---- plan ------------------------------------------------------------------------------------------

def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_order(classes: DataFrame) -> list[int]:
    """The 64 bit positions, correlated ones together: from the 64 x 64 counts of set bit pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both += x.T @ x
            n += len(x)
        if n:
            i, j = np.divmod(np.arange(4096), 64)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()),
                                              pa.array(np.append(both.ravel(), n).astype(np.int64))], names=["i", "j", "c"])

    both, n = np.zeros((64, 64)), 0
    for i, j, c in classes.select("fp").mapInArrow(run, "i int, j int, c long").groupBy("i", "j").agg(F.sum("c")).collect():  # 4,097 rows
        if i < 0:
            n = c
        else:
            both[i, j] = c
    if not n:
        return list(range(64))
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / n - np.outer(p, p)) / np.outer(sd, sd)
    left, order = set(range(64)), []
    while left:
        rest = sorted(left)
        seed = max(rest, key=lambda i: (sum(corr[i, j] for j in rest if j != i), -i))
        chunk = [seed]
        left.discard(seed)
        while len(chunk) < CHUNK:
            nxt = max(sorted(left), key=lambda j: (corr[chunk, j].sum(), -j))
            chunk.append(nxt)
            left.discard(nxt)
        order += chunk
    return order


def chunk_values(fp: np.ndarray, order: list[int]) -> np.ndarray:
    """The 16-bit value of each of the four chunks: an array (4, n) of int64."""
    bits = _bits(fp)[:, order].reshape(-1, 4, CHUNK)
    packed = np.packbits(bits, axis=2, bitorder="little")
    return packed.view("<u2").reshape(-1, 4).astype(np.int64).T


def distance_counts(classes: DataFrame, order: list[int], max_bits: int) -> tuple[np.ndarray, int]:
    """Per chunk, the number of ordered fingerprint pairs whose chunk values differ in 0..max_bits
    bits: the XOR autocorrelation of the chunk's value histogram, by a Walsh-Hadamard transform."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((4, 1 << CHUNK), dtype=np.int64)
        for b in batches:
            for c, v in enumerate(chunk_values(b.column(0).to_numpy(zero_copy_only=False), order)):
                hist[c] += np.bincount(v, minlength=1 << CHUNK)
        at = np.flatnonzero(hist.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(hist.ravel()[at])], names=["v", "c"])

    hist = np.zeros(4 << CHUNK)
    got = classes.select("fp").mapInArrow(run, "v int, c long").groupBy("v").agg(F.sum("c").alias("c")).toPandas()  # <= 262,144 rows
    hist[got["v"].to_numpy(dtype=np.int64)] = got["c"].to_numpy(dtype=np.float64)
    ones = np.bitwise_count(np.arange(1 << CHUNK, dtype=np.uint32))
    out = []
    for f in hist.reshape(4, -1):
        w, step = f.copy(), 1
        while step < len(w):
            w = w.reshape(-1, 2, step)
            w = np.stack([w[:, 0] + w[:, 1], w[:, 0] - w[:, 1]], axis=1).ravel()
            step *= 2
        w, step = w * w, 1
        while step < len(w):
            w = w.reshape(-1, 2, step)
            w = np.stack([w[:, 0] + w[:, 1], w[:, 0] - w[:, 1]], axis=1).ravel()
            step *= 2
        w /= len(w)
        out.append([w[ones == r].sum() for r in range(max_bits + 1)])
    return np.array(out), int(hist[: 1 << CHUNK].sum())


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` set."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _groupings(chunks: list[int]) -> Iterator[list[list[int]]]:
    if not chunks:
        yield []
        return
    head, rest = chunks[0], chunks[1:]
    for k in range(len(rest) + 1):
        for with_head in combinations(rest, k):
            others = [c for c in rest if c not in with_head]
            for more in _groupings(others):
                yield [[head, *with_head], *more]


def plan(counts: np.ndarray, n: int, max_bits: int) -> list[tuple[tuple[int, ...], int]]:
    """(chunks, threshold) of each partition that is probed; counts as by ``distance_counts``."""
    best: tuple[float, list] | None = None
    for parts in _groupings([0, 1, 2, 3]):
        m = len(parts)
        price = []
        for part in parts:
            width, pairs = CHUNK * len(part), np.array([float(n) * n])
            for c in part:
                pairs = np.convolve(pairs, counts[c] / max(1.0, float(n) * n))[: max_bits + 1]
            row = {-1: 0.0}
            for t in range(max_bits + 1):
                masks = sum(1 for _ in _choose(width, t))
                row[t] = n * (1.0 + masks) + PAIR_COST * float(pairs[: t + 1].sum())
            price.append(row)
        budget = max_bits - m + 1
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in price:
            nxt: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, ts) in states.items():
                for t, c in row.items():
                    to = used + t
                    if to not in nxt or cost + c < nxt[to][0]:
                        nxt[to] = (cost + c, [*ts, t])
            states = nxt
        if budget in states and (best is None or states[budget][0] < best[0]):
            best = (states[budget][0], [(tuple(p), t) for p, t in zip(parts, states[budget][1]) if t >= 0])
    return best[1]


def _choose(width: int, radius: int) -> range:
    total, term = 0, 1
    for r in range(radius + 1):
        total += term
        term = term * (width - r) // (r + 1)
    return range(total)


# ---- search ----------------------------------------------------------------------------------------

def _mix(tag: int, value: np.ndarray) -> np.ndarray:
    x = value.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tag * 0x632BE59BD9B4E019 & (2**64 - 1))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def probe_rows(classes: DataFrame, order: list[int], parts: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """``(key, role, fp)``: a fingerprint's own value of each partition, and all values it searches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                fp = big.slice(at, 1024).column(0).to_numpy(zero_copy_only=False)
                values = chunk_values(fp, order)
                for tag, (chunks, t) in enumerate(parts):
                    own = np.zeros(len(fp), dtype=np.uint64)
                    for c in chunks:
                        own = (own << np.uint64(CHUNK)) | values[c].astype(np.uint64)
                    masks = np.array(ball(CHUNK * len(chunks), t), dtype=np.uint64)
                    key = np.concatenate([_mix(tag, own), _mix(tag, (own[:, None] ^ masks).ravel())])
                    role = np.repeat([INDEX, PROBE], [len(fp), len(fp) * len(masks)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(role), pa.array(np.concatenate([fp, np.repeat(fp, len(masks))]))],
                                                     names=["key", "role", "fp"])

    return classes.select("fp").mapInArrow(run, "key long, role int, fp long")


def links(cells: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(a, b)`` of a spanning forest of each cell's links of at most ``max_bits`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches):
            fp, role, group = t.column("fp").to_numpy(), t.column("role").to_numpy(), group_ids(t)
            a, b = [], []
            for i, j in small_pairs(group, 64):
                ok = (role[i] != role[j]) & (fp[i] != fp[j])
                i, j = i[ok], j[ok]
                near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= max_bits
                a.append(fp[i[near]])
                b.append(fp[j[near]])
            for s, e in large_groups(group, 64):
                own, who = fp[s:e], role[s:e]
                left, right = np.flatnonzero(who == INDEX), np.flatnonzero(who == PROBE)
                uniq, slot = np.unique(own, return_inverse=True)
                forest = Forest(len(uniq))
                for at in range(0, len(left), 256):
                    x = left[at:at + 256]
                    near = np.bitwise_count((own[x][:, None] ^ own[right][None, :]).view(np.uint64)) <= max_bits
                    p, q = np.nonzero(near)
                    forest.add(slot[x[p]], slot[right[q]])
                if forest.edges:
                    x, y = np.array(forest.edges).T
                    a.append(uniq[x])
                    b.append(uniq[y])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, max_bits: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per row of ``docs``.

    component_id is the smallest doc_id whose fingerprint is reachable over links of at most
    ``max_bits`` differing bits. A null text counts as empty; empty texts have fingerprint 0 and link
    like others; repeated rows give repeated output rows. A null doc_id takes part but is never the
    smallest, unless its class has no other id (then component_id is null). Columns other than the
    two named are ignored. An empty table gives an empty result.
    """
    fps = cut(fingerprints(docs, id_col, text_col, k))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    order = bit_order(classes)
    counts, n = distance_counts(classes, order, max_bits)
    rows = probe_rows(classes, order, plan(counts, n, max_bits))
    roots = connected_components(links(grid(rows, "fp", BLOCK), max_bits))
    rooted = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = cut(rooted.join(least, "root").select("fp", "component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")
