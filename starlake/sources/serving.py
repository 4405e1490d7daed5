"""SNK6: snapshots for point reads, on plain Parquet.

A snapshot's rows are range-partitioned and sorted by key, so a key lies in one file or two that follow each other; row
groups are small, and a bloom filter on the first key column lets the reader skip those without the value. An index has a
row per file with its first and last key. A last write, of one row, publishes files and index: a reader sees the last
published snapshot, as a whole, and opens only files whose range holds the key.
"""
from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

PUBLISHED = "folder string, columns string, number int"


def _key(columns: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def publish(df: DataFrame, path: str, key: list[str], *, files: int = 16, row_group: int = 1 << 20) -> int:
    """Write ``df`` as the next snapshot below ``path``; returns its number. Rows keep null keys (first in order)."""
    spark = df.sparkSession
    folder = f"snapshot-{uuid.uuid4().hex}"
    (df.repartitionByRange(files, *key).sortWithinPartitions(*key).write
     .option("parquet.block.size", row_group).option(f"parquet.bloom.filter.enabled#{key[0]}", "true").parquet(f"{path}/data/{folder}"))
    last = current(spark, path)
    number = 1 if last is None else last + 1
    rows = spark.read.schema(df.schema).parquet(f"{path}/data/{folder}").select("_metadata.file_name", _key(key).alias("k"))
    index = rows.groupBy("file_name").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.count(F.lit(1)).alias("rows"))
    index.coalesce(1).write.parquet(f"{path}/data/{folder}-index")  # a row per file
    spark.createDataFrame([(folder, df.schema.json())], "folder string, columns string").write.mode("errorifexists").parquet(f"{path}/published/number={number}")
    return number  # a second writer of this number has failed


def current(spark: SparkSession, path: str) -> int | None:
    """The last published snapshot."""
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{path}/published").agg(F.max("number")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _published(spark: SparkSession, path: str, number: int | None) -> tuple[str, StructType]:
    number = number or current(spark, path)
    if number is None:
        raise KeyError(f"no snapshot in {path}")
    row = spark.read.schema(PUBLISHED).parquet(f"{path}/published").where(F.col("number") == number).first()
    return f"{path}/data/{row['folder']}", StructType.fromJson(json.loads(row["columns"]))


def snapshot_index(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """``(file_name, first, last, rows)`` of a snapshot, the last one if no number is given."""
    return spark.read.parquet(f"{_published(spark, path, number)[0]}-index")


def point_read(spark: SparkSession, path: str, key: list[str], values: list[Any], number: int | None = None) -> DataFrame:
    """The rows whose leading ``key`` columns equal ``values`` (null-safe), from the few files that can hold them."""
    folder, schema = _published(spark, path, number)
    index = spark.read.parquet(f"{folder}-index")
    head = index.withColumns({"a": F.struct(*[F.col(f"first.k{i}") for i in range(len(values))]), "b": F.struct(*[F.col(f"last.k{i}") for i in range(len(values))])})
    kinds = [index.schema["first"].dataType[f"k{i}"].dataType for i in range(len(values))]
    wanted = F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, kinds))])
    # one key's rows lie in files that follow each other; its files are listed, not its rows
    some = head.where((F.col("a") <= wanted) & (wanted <= F.col("b"))).select("file_name").collect()
    if not some:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{r.file_name}" for r in some])
    for c, v in zip(key, values):
        rows = rows.where(F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
    return rows


def overlaps(spark: SparkSession, path: str, number: int | None = None) -> int:
    """Files that start before the file before them ends: 0 in every snapshot, so a key reads no file too many."""
    index = snapshot_index(spark, path, number)
    before = F.max("last").over(Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    return index.withColumn("before", before).where(F.col("before") > F.col("first")).count()
