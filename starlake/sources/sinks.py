"""Sinks (SNK1, SNK4-SNK8, SRC5, SRC7, SRC8) and the batch text fill (FC15).

Rows never pass through the driver: tables are written by the executors
(parquet managed tables, or JDBC with one connection per partition).
"""
from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import TableSpec, validate_schema
from .versions import Store, Version

PG_TYPES = {"bigint": "bigint", "int": "integer", "double": "double precision", "string": "text",
            "boolean": "boolean", "timestamp": "timestamptz", "timestamp_ntz": "timestamp", "date": "date", "decimal(18,2)": "numeric(18,2)",
            "decimal(18,1)": "numeric(18,1)", "decimal(18,4)": "numeric(18,4)"}


def table_name(spec: TableSpec, prefix: str = "") -> str:
    return f"{prefix}{spec.schema}.{spec.name}"


def write_table(spark: SparkSession, df: DataFrame, spec: TableSpec, *, prefix: str = "",
                partition_by: list[str] | None = None, path: str | None = None) -> str:
    """SNK1: validated, idempotent overwrite of a parquet managed table with column and table comments."""
    df = spec.project(df)
    validate_schema(df, spec)
    name = table_name(spec, prefix)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{spec.schema}")
    w = df.write.format("parquet").mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    grain = spec.grain.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS 'Grain: {grain}'")
    return name


def write_versioned(store: Store, df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> Version:
    """SNK1: validated write as a new version of a table: readers see the old rows or the new ones, a failed write leaves the
    old ones, and columns that a later spec adds, renames (``store.alter``) or drops follow their identity."""
    df = spec.project(df)
    validate_schema(df, spec)
    return store.append(spec.qualified, df) if mode == "append" else store.overwrite(spec.qualified, df)


def read_back(spark: SparkSession, name: str) -> DataFrame:
    """SRC5: read a just-written table so dependants start from files, not lineage."""
    return spark.read.table(name)


def read_table_param(spark: SparkSession, name: str) -> DataFrame:
    """SRC8: parameterised table name (no string splicing of the identifier)."""
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})


def pg_ddl(spec: TableSpec, schema: str) -> list[str]:
    """SNK5: DDL for the operational copy (NOT NULL, primary key, comments)."""
    cols = ",\n  ".join(
        f"{c.name} {PG_TYPES.get(c.sql_type, 'text')}{'' if c.nullable else ' NOT NULL'}" for c in spec.columns)
    pk = f",\n  PRIMARY KEY ({', '.join(spec.primary_key)})" if spec.primary_key else ""
    out = [f"CREATE SCHEMA IF NOT EXISTS {schema}", f"CREATE TABLE IF NOT EXISTS {schema}.{spec.name} (\n  {cols}{pk}\n)"]
    out += [f"COMMENT ON COLUMN {schema}.{spec.name}.{c.name} IS '{c.comment.replace(chr(39), chr(39) * 2)}'"
            for c in spec.columns if c.comment]
    return out


def write_jdbc(df: DataFrame, spec: TableSpec, *, url: str, table: str, properties: dict | None = None,
               num_partitions: int = 8) -> int:
    """SNK4: operational reseed (truncate + insert) from the executors; returns the stored row count.

    The JDBC writer runs per partition on the executors; the database counts what it holds.
    """
    out = spec.project(df)
    # text columns get the dialect's unbounded type; a shuffle, not a coalesce, so the stage before keeps its tasks
    (out.repartition(num_partitions).write.mode("overwrite").option("truncate", "true").option("numPartitions", num_partitions)
     .jdbc(url, table, properties=properties or {}))
    stored = df.sparkSession.read.format("jdbc").options(url=url, query=f"SELECT COUNT(*) AS N FROM {table}", **(properties or {})).load()
    return int(stored.first()[0])  # counted in the database


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None, *, column: str, lower: int, upper: int,
              num_partitions: int = 8) -> DataFrame:
    """SRC7: federated read-back of an operational table in ``num_partitions`` ranges of a numeric ``column``; values
    outside the bounds are in the first and last range."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=num_partitions, properties=properties or {})


def serving_slice(forecast: DataFrame, version: str | None = None) -> DataFrame:
    """SNK6: keyed point-read slice of the forecast (PK date, product, store, version), clustered by key."""
    f = forecast if version is None else forecast.filter(F.col("forecast_version") == version)
    return f.repartitionByRange("product_sk", "store_sk").sortWithinPartitions(
        "product_sk", "store_sk", "date_sk", "forecast_version")


def run_report(spark: SparkSession, names: list[str]) -> DataFrame:
    """SNK8: row count per written table, as one frame (counts run on the executors)."""
    parts = [spark.read.table(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
             for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fill_text(df: DataFrame, prompt_col: str, out_col: str, fn: Callable[[list[str]], list[str]],
              batch_size: int = 64) -> DataFrame:
    """FC15: fill ``out_col`` by calling ``fn`` on batches of prompts (null prompt -> null).

    Runs on the executors through ``mapInPandas`` (Arrow batches); ``fn`` is the
    injected model client (a pure template function in tests). Deterministic fns
    keep retries idempotent.
    """
    from pyspark.sql import types as T
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType(), True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prompts = pdf[prompt_col]
            result = [None] * len(pdf)
            idx = [i for i, p in enumerate(prompts) if p is not None]
            for s in range(0, len(idx), batch_size):
                chunk = idx[s:s + batch_size]
                for i, text in zip(chunk, fn([prompts.iloc[i] for i in chunk])):
                    result[i] = text
            yield pdf.assign(**{out_col: result})

    return df.mapInPandas(run, schema=schema)


def write_filled(df: DataFrame, texts: dict[str, str], fn: Callable[[list[str]], list[str]], path: str) -> DataFrame:
    """SNK7/FC15: fill every ``out: prompt`` of ``texts``, write the table without its prompts to ``path``, a new
    folder, and read it back: the model is called once per row, whatever reads the result."""
    for out, prompt in texts.items():
        df = fill_text(df, prompt, out, fn)
    done = df.drop(*texts.values())
    done.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(done.schema).parquet(path)
