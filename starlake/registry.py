"""Registered queries (one per operator family) and their DuckDB oracle SQL.

Every query reads the driver tables (or frames Spark derives from them) in
full; nothing is capped, sampled or filtered to keep checks cheap. Exact
decimals are returned as doubles (correctly rounded from exact sums in both
engines) so Spark and the oracle produce identical values and types.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .plans.settings import REGISTERED
from .plans.warehouse import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def as_output(df: DataFrame) -> DataFrame:
    """Decimals -> double (exact sums, one correctly rounded conversion)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_output(fn(Warehouse(spark, sf_dir, REGISTERED)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load() -> None:
    from .plans import catalog  # noqa: F401  (registers everything)


_load()
