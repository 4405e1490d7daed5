"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosine, connected components.

Equal vectors are one class first, so copies cost nothing and are counted, not paired. A class's unit
vector is hashed in ``tables`` tables by the signs of its products with ``bits`` random hyperplanes; at
an angle t two vectors share a table's bucket with probability (1 - t/pi)^bits. ``bits`` grows with the
logarithm of the number of classes (bucket sizes stay the same) and ``tables`` is the number that finds a
pair right at the threshold with probability ``recall`` or better; closer pairs are likelier. Bucket mates are
compared in blocked cells by exact cosine in double precision. A pair that meets in several tables
counts in the first only, so a cell returns numbers of links and a spanning forest, never pairs.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import INDEX, PROBE, Forest, group_ids, large_groups, runs, self_grid
from .common import cut
from .components import connected_components

BLOCK = 2048
SEED = 20240917


def tuning(classes: int, least: float, recall: float, bucket: int = 16) -> tuple[int, int]:
    """(bits, tables) for a number of classes."""
    bits = max(4, ceil(log2(max(1.0, classes / bucket))))
    share = (1 - acos(least) / pi) ** bits
    return bits, max(1, ceil(log(1 - recall) / log(1 - share)))


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((tables, bits, dim))


def _signatures(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) bucket numbers."""
    planes = _planes(x.shape[1], bits, tables)
    weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    return np.stack([((x @ planes[t].T > 0).astype(np.uint64) * weights).sum(axis=1) for t in range(tables)], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def classes_of(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, cls, unit)``: cls is a hash of the vector's components, null where nothing may link;
    unit is the vector scaled to length 1 in double precision."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = v.isNull() | (F.size(v) == 0) | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("v", lambda x: x / F.array_max(F.transform("v", lambda y: F.abs(y))))  # no overflow of squares
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.when(~bad, v).alias("v"))
            .withColumn("v", F.when(F.exists("v", lambda x: x != 0), F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x))))
            .withColumn("cls", F.when(F.col("v").isNotNull(), F.unhex(F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256))))
            .withColumn("w", scaled).withColumn("unit", F.transform("w", lambda x: x / norm)).select("vec_id", "cls", "unit"))


def _cells(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                b = big.slice(at, 1024)
                dims = np.diff(b.column(1).offsets.to_numpy())
                for dim in np.unique(dims).tolist():  # vectors of other lengths never meet
                    part = b.filter(pa.array(dims == dim))
                    sig = _signatures(_matrix(part.column(1)), bits, tables)
                    n = part.num_rows
                    for t in range(tables):
                        key = (sig[:, t] * np.uint64(0x9E3779B97F4A7C15) + np.uint64((t * 0x632BE59BD9B4E019 + dim * 0xD6E8FEB86659FD93) % 2**64)).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(n, t, np.int32)), part.column(0), part.column(1), part.column(2)],
                                                         names=["key", "turn", "node", "unit", "n"])

    return self_grid(classes.select("node", "unit", "n").mapInArrow(run, "key long, turn int, node long, unit array<double>, n long"), "node", BLOCK)


def _links(cells: DataFrame, bits: int, tables: int, least: float) -> DataFrame:
    """``(a, b, n)``: b null: class a has n links more; else an edge of a cell's spanning forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 1 << 13):
            t = t.combine_chunks()
            node, role, turn, n = (t.column(c).to_numpy() for c in ("node", "role", "turn", "n"))
            group, units = group_ids(t), t.column("unit").combine_chunks()
            ends = []
            for s, e in large_groups(group, 1):
                x, who = _matrix(units.slice(s, e - s)), role[s:e]
                left, right = np.flatnonzero(who == INDEX), np.flatnonzero(who == PROBE)
                alone = not len(right)  # the cell's rows are compared with each other
                sig = _signatures(x, bits, int(turn[s])) if turn[s] else np.zeros((e - s, 0), np.uint64)
                forest, others = Forest(e - s), np.zeros(e - s)
                for at in range(0, len(left), 256):
                    i = left[at:at + 256]
                    j = left[at:] if alone else right
                    p, q = np.nonzero(x[i] @ x[j].T >= least)
                    a, b = i[p], j[q]
                    first = ~(sig[a] == sig[b]).any(axis=1) & ((a < b) | (not alone))
                    a, b = a[first], b[first]
                    forest.add(a, b)
                    others += np.bincount(a, weights=n[s + b], minlength=e - s) + np.bincount(b, weights=n[s + a], minlength=e - s)
                some = np.flatnonzero(others)
                if len(some):
                    ends.append((node[s + some], np.full(len(some), -1), others[some].astype(np.int64)))
                if forest.edges:
                    u, v = np.array(forest.edges).T + s
                    ends.append((node[u], node[v], np.zeros(len(u), np.int64)))
            if ends:
                a, b, c = (np.concatenate(z) for z in zip(*ends))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=c > 0), pa.array(c)], names=["a", "b", "n"])

    return cells.mapInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95,
                    recall: float = 0.9995) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row per row of ``vectors``.

    Links join rows whose vectors are equal or were found with cosine >= ``least``; none is below it.
    n_links counts the other rows linked directly, component_id is the smallest vec_id reachable,
    kept says it is the row's own. A vector that is null, empty, zero or holds a null or non-finite
    component links with nothing, nor do vectors of different lengths. Repeated rows are copies of each
    other; a null vec_id takes part but is never the smallest unless it has no other, and is kept if
    so. Columns other than the two named are ignored; an empty table gives an empty result.
    """
    rows = cut(classes_of(vectors, id_col, vector_col))
    grouped = rows.where("cls is not null").groupBy("cls").agg(F.first("unit").alias("unit"), F.count("*").alias("n"), F.min("vec_id").alias("rep"))
    classes = cut(grouped.withColumn("node", F.monotonically_increasing_id()))
    bits, tables = tuning(classes.count(), least, recall)
    links = cut(_links(_cells(classes, bits, tables), bits, tables, least))
    counts = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(links.where("b is not null").select("a", "b"))
    known = classes.select("node", "cls", "n", "rep").join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = cut(known)
    least_of = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = cut(known.join(least_of, "root").select("cls", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    joined = rows.select("vec_id", "cls").join(named, "cls", "left")
    own = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                         F.col("vec_id").eqNullSafe(own).alias("kept"))
