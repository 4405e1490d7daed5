"""Session helpers for tests, the bench and local runs.

Library code never creates a session; it receives one. These helpers only set
defaults that are *missing*, so a cluster's own settings (shuffle partitions,
``spark.checkpoint.dir`` on shared storage, AQE) always win.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.sql.maxMetadataStringLength": "500",  # whole paths in plans
}


def local_session(cores: int | str = "*", app: str = "starlake", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and built tables.

    On a cluster ``spark.checkpoint.dir`` names shared storage; if it is unset that is an error, as a
    machine-local folder would be lost with its executor. A local master, where driver and executors are one
    process, gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="starlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the cluster's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/starlake-{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    path = new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
