"""Embedding whitening by weighted multiplicities: equal vectors are fitted and whitened once.

Entries become integers (x = floor(scale * c), a shift changes nothing that follows), rows with equal x-vectors are grouped and
their counts (or one each) are the weights of the fit. Sums are exact integers. The covariance is a weighted product of centred
blocks, one matrix a task, added up in Spark; only its dim x dim entries come to the driver, for the eigenvectors. Each distinct
vector is projected once, the covariance of the projections is measured by a second product, and the results are joined back to
the rows: the vectors that hold more than a thousandth of all rows (a thousand at most) by broadcast, the others by shuffle.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

SHARE = 1000        # a vector with more than a SHARE-th of all rows is joined by broadcast
LEAST_VARIANCE = 1e-9  # components with a smaller share of the largest eigenvalue can't be told from none in double precision
LARGE = float(2**55)   # entries from here on have no long x


def integers(vector: Column, scale: int = 64) -> Column:
    """floor(scale * c) of every entry, in double precision; null for a vector that is null, empty or holds an entry that is
    null, not finite or 2^55 or more in size."""
    v = vector.cast("array<double>")
    bad = v.isNull() | (F.size(v) == 0) | F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGE))
    return F.when(~bad, F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def _matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pos, s): per dimension the task's exact weighted sum, as text; rows are (w, x)."""
    total: np.ndarray | None = None
    for b in batches:
        if b.num_rows:
            w, x = b.column(0).to_numpy(), _matrix(b.column(1))
            safe = float(np.abs(x).max()) * float(w.sum()) < 2.0**62
            part = (w @ x).astype(object) if safe else w.astype(object) @ x.astype(object)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([str(s) for s in total])], names=["pos", "s"])


class Centre:
    """The mean S / n as a whole part and a rest, so that centring integers loses no digits."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.whole = n, [s // n for s in sums]
        self.rest = [s - q * n for s, q in zip(sums, self.whole)]

    def off(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in double precision."""
        return (x - np.array(self.whole, np.int64)).astype(np.float64) - np.array(self.rest) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact; None beyond a long."""
        off = x - np.array(self.whole, np.int64)
        if self.n * (float(np.abs(off).max()) + 1) * x.shape[1] ** 0.5 < 3.0e9:
            return ((self.n * off - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [int(d) if d < 2**63 else None for d in exact]


def _products(batches: Iterator[pa.RecordBatch], centre: Centre | None) -> Iterator[pa.RecordBatch]:
    """(i, row): the rows of the task's weighted product of centred vectors; rows are (w, x)."""
    total: np.ndarray | None = None
    for big in batches:
        for at in range(0, big.num_rows, 4096):
            b = big.slice(at, 4096)
            z = centre.off(_matrix(b.column(1))) if centre else _matrix(b.column(1), np.float64)
            part = (z * b.column(0).to_numpy()[:, None]).T @ z
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], names=["i", "row"])


def _whitened(batches: Iterator[pa.RecordBatch], centre: Centre, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(cls, w, deviation, whitened) of the distinct vectors (cls, w, x)."""
    for big in batches:
        for at in range(0, big.num_rows, 4096):
            b = big.slice(at, 4096)
            x = _matrix(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(centre.deviation(x), pa.int64()), pa.array(list(centre.off(x) @ axes))],
                                             names=["cls", "w", "deviation", "whitened"])


def covariance(weighted: DataFrame, n: int, dim: int, centre: Centre | None = None) -> np.ndarray:
    """The covariance (divisor n) of the vectors of a table (w, x); without ``centre`` they are centred already."""
    rows = weighted.mapInArrow(partial(_products, centre=centre), "i int, row array<double>")
    out = np.zeros((dim, dim))
    i, j, v = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().columns
    out[i.to_numpy(), j.to_numpy()] = v.to_numpy()
    return (out + out.T) / 2 / n


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: int = 64,
           weights: str = "counts") -> DataFrame:
    """``(vec_id, n, deviation, whitened, explained, identity_error)``: one row per row of ``vectors`` that takes part.

    whitened and explained are arrays by component, of falling variance: the centred x-vector projected on the unit
    eigenvector over the root of its eigenvalue, and the eigenvalue's share of all variance. n is the weight of the fit and
    deviation the exact sum over dimensions of (n * x - S)^2 (null if no long can hold it). identity_error is the largest
    absolute entry of the measured covariance of the whitened vectors less the identity. ``weights`` is ``counts`` (every row
    counts) or ``one`` (every distinct vector does).

    Vectors that are null, empty or hold an entry that is null, not finite or 2^55 or more in size have no row; of different
    lengths the most frequent one takes part (of equally frequent ones the longest). There are at most ``components``
    components and as many as the data has directions: those below 1e-9 of the largest eigenvalue are left out, so vectors
    that are all equal have empty arrays. Repeated rows and null ids stay; columns other than the two named are ignored; an
    empty table gives an empty result.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be counts or one")
    kind, spark = vectors.schema[id_col].dataType.simpleString(), vectors.sparkSession
    schema = f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    x = vectors.select(F.col(id_col).alias("vec_id"), integers(F.col(vector_col), scale).alias("x")).where("x is not null")
    length = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if length is None:
        return spark.createDataFrame([], schema)
    keyed = x.where(F.size("x") == length["dim"]).withColumn("cls", F.substring(F.unhex(F.sha2(F.array_join("x", ","), 256)), 1, 16))
    distinct = cut(keyed.groupBy("cls").agg(F.count("*").alias("w"), F.first("x").alias("x")))
    fitted = distinct.select("w" if weights == "counts" else F.lit(1).cast("long").alias("w"), "x")
    n = fitted.agg(F.sum("w")).first()[0]
    sums = fitted.mapInArrow(_sums, "pos int, s string").groupBy("pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("pos").collect()
    centre = Centre(n, [int(r.s) for r in sums])
    values, axes = np.linalg.eigh(covariance(fitted, n, len(sums), centre))
    order = [i for i in np.argsort(-values)[:components] if values[i] > max(0.0, LEAST_VARIANCE * values[-1])]
    white = cut(distinct.mapInArrow(partial(_whitened, centre=centre, axes=axes[:, order] / np.sqrt(values[order])), "cls binary, w long, deviation long, whitened array<double>"))
    again = white.select("w" if weights == "counts" else F.lit(1).cast("long").alias("w"), "whitened")
    off = float(np.abs(covariance(again, n, len(order)) - np.eye(len(order))).max()) if order else 0.0
    rows = keyed.select("vec_id", "cls")
    hot = white.where(F.col("w") > F.lit(distinct.agg(F.sum("w")).first()[0] // SHARE))
    cold = rows.join(F.broadcast(hot.select("cls")), "cls", "left_anti").join(white, "cls")
    explained = F.array(*[F.lit(float(values[i] / values.sum())) for i in order]).cast("array<double>")
    return rows.join(F.broadcast(hot), "cls").unionByName(cold).select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(off).alias("identity_error"))
