"""Shared folder, lineage cuts and small Arrow helpers for the operators of this subpackage."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``.

    The setting is the cluster's. Only a local master without one gets a scratch folder of its own;
    a cluster without one is an error, as executors would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="starlake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/starlake-llm/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor
    costs a re-read, not a recomputation."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to differ from ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def small(written: DataFrame, rows: int, weight: Column | None = None) -> DataFrame:
    """``written`` (a table that ``cut`` returned) with a broadcast hint if its rows, or the sum of
    ``weight`` over them, are ``rows`` at most; beyond that Spark joins it by shuffle."""
    n = written.agg(F.coalesce(F.sum(weight if weight is not None else F.lit(1)), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(written) if n <= rows else written


def text_slices(batches: Iterator[pa.RecordBatch], col: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Split record batches so that the strings of column ``col`` take about ``limit`` bytes at most;
    a single longer string stays whole in a batch of its own."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum([0 if v is None else v for v in pa.compute.binary_length(batch.column(col)).to_pylist()])
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()  # a worker waits for its next task without it


def column_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if v is None else v for v in col.cast(pa.binary()).to_pylist()]


def ship_package(spark: SparkSession) -> None:
    """Add the library to the Python workers' path where neither PYTHONPATH nor the working folder holds it."""
    root = Path(__file__).resolve().parents[2]
    seen = {Path(p or ".").resolve() for p in [".", *os.environ.get("PYTHONPATH", "").split(os.pathsep)]}
    sc = spark.sparkContext
    if root in seen or getattr(sc, "_starlake_shipped", False):
        return
    to = Path(tempfile.mkdtemp(prefix="starlake-py-")) / "starlake.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted((root / "starlake").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(to))
    sc._starlake_shipped = True
