"""Candidate pairs of a bucketed self-join, verified inside tasks block by block.

Rows carry a bucket key and a role: ``index`` rows are found, ``probe`` rows search. A bucket of any
size is cut into a grid of (index block, probe block) cells, so no task gets a whole hot bucket, and
only what the verifier returns leaves the task, never the pairs.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small

INDEX, PROBE = 0, 1


HOT_KEYS = 200_000  # as many oversized buckets may be broadcast


def grid(rows: DataFrame, spread: str, block: int) -> DataFrame:
    """Deal ``rows(key, role, ...)`` into cells of about ``block`` rows a side.

    A bucket with at most ``block`` rows of each role is one cell. In a larger one every row goes to
    one block of its role (by the hash of column ``spread``) and meets all blocks of the other.
    """
    sizes = cut(rows.groupBy("key").agg(F.sum(F.expr(f"if(role = {INDEX}, 1, 0)")).alias("n_i"),
                                        F.sum(F.expr(f"if(role = {PROBE}, 1, 0)")).alias("n_p"))
                .where(f"n_i > {block} or n_p > {block}")
                .select("key", F.ceil(F.col("n_i") / block).cast("int").alias("g_i"),
                        F.ceil(F.col("n_p") / block).cast("int").alias("g_p")))
    one = F.array(F.lit(0))
    gi, gp = F.greatest(F.col("g_i"), F.lit(1)), F.greatest(F.col("g_p"), F.lit(1))
    own = F.xxhash64(F.lit(7), F.col(spread))
    cells = (F.when(F.col("g_i").isNull(), one)
             .when(F.col("role") == INDEX, F.transform(F.sequence(F.lit(0), gp - 1), lambda p: F.pmod(own, gi).cast("int") * gp + p))
             .otherwise(F.transform(F.sequence(F.lit(0), gi - 1), lambda i: i * gp + F.pmod(own, gp).cast("int"))))
    kept = [c for c in rows.columns]
    dealt = rows.join(small(sizes, HOT_KEYS), "key", "left").withColumn("cell", F.explode(cells)).select(*kept, "cell")
    return dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "role")


def self_grid(rows: DataFrame, spread: str, block: int) -> DataFrame:
    """Deal ``rows(key, ...)``, each both found and searching, into cells; adds ``role`` and ``cell``.

    A bucket of at most ``block`` rows is one cell of index rows, to be compared with each other. In a
    larger one a row's block meets every block once: cell (x, y) has block x as index and y as probe
    rows, cell (x, x) index rows only.
    """
    sizes = cut(rows.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("g")))
    own = F.pmod(F.xxhash64(F.lit(7), F.col(spread)), F.col("g")).cast("int")
    cells = F.when(F.col("g").isNull(), F.array(F.struct(F.lit(0).alias("cell"), F.lit(INDEX).alias("role")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.coalesce("g", F.lit(1)) - 1), lambda j: F.struct(
            (F.least(own, j) * F.col("g") + F.greatest(own, j)).alias("cell"), F.when(j < own, PROBE).otherwise(INDEX).alias("role"))))
    dealt = rows.join(small(sizes, HOT_KEYS), "key", "left").withColumn("c", F.explode(cells)).select(*rows.columns, "c.cell", "c.role")
    return dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "role")


def runs(batches: Iterator[pa.RecordBatch], target: int = 1 << 16) -> Iterator[pa.Table]:
    """Regroup sorted batches into tables that hold whole (key, cell) groups."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < target:
            continue
        t = pa.Table.from_batches(held)
        key, cell = t.column("key").to_numpy(), t.column("cell").to_numpy()
        first = int(np.flatnonzero((key == key[-1]) & (cell == cell[-1]))[0])
        if first:
            yield t.slice(0, first)
        held, size = t.slice(first).to_batches(), t.num_rows - first
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over the rows of one cell: keeps the edges that join two sets, drops the rest."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        la, lb = self.label[a], self.label[b]
        off = la != lb
        if not off.any():
            return
        n = len(self.label)
        pairs = np.unique(la[off].astype(np.int64) * n + lb[off])
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for x, y in zip((pairs // n).tolist(), (pairs % n).tolist()):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
                self.edges.append((x, y))
        move = np.arange(n)
        for x in up:
            move[x] = find(x)
        self.label = move[self.label]


def small_pairs(group: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) inside groups of at most ``limit`` rows; ``group`` numbers sorted rows."""
    _, start, size = np.unique(group, return_index=True, return_counts=True)
    last = np.repeat(start + size - 1, size)
    fits = np.repeat(size <= limit, size)
    i = np.flatnonzero(fits & (np.arange(len(group)) < last))
    d = 1
    while len(i):
        yield i, i + d
        d += 1
        i = i[i + d <= last[i]]


def large_groups(group: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    _, start, size = np.unique(group, return_index=True, return_counts=True)
    for s, n in zip(start[size > limit].tolist(), size[size > limit].tolist()):
        yield s, s + n


def group_ids(t: pa.Table) -> np.ndarray:
    key, cell = t.column("key").to_numpy(), t.column("cell").to_numpy()
    new = np.ones(len(key), dtype=np.int64)
    new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
    return np.cumsum(new)

