"""Skew-safe running totals (WN1).

``sum(x) over (partition by g order by o rows unbounded preceding)`` sorts each whole group in one task.
``running_total`` cuts each group into chunks by columns that are a prefix of the ordering (the event day,
then the leading digits of the event id), takes chunk totals (a small aggregate), turns them into
offsets by a window on that aggregate, and adds each row's running sum inside its chunk.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, group_cols: Sequence[str], chunk_exprs: Sequence[Column | str], order_cols: Sequence[str],
                  value_col: str, out: str) -> DataFrame:
    """Running sum of ``value_col`` per group ordered by ``(*chunk_exprs, *order_cols)``, nulls first.

    Null group keys form a group and null chunks a chunk (null-safe join back): no row is lost.
    """
    chunks = [f"_chunk{i}" for i in range(len(chunk_exprs))]
    keys = [*group_cols, *chunks]
    keyed = df.withColumns({c: F.col(e) if isinstance(e, str) else e for c, e in zip(chunks, chunk_exprs)})
    inside = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group_cols).orderBy(*chunks).rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy(*keys).agg(F.sum(value_col).alias("_sum")).select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    same = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"_o_{k}"))
        same = part if same is None else same & part
    summed = keyed.withColumn("_sum_in", F.sum(value_col).over(inside))
    return summed.join(offsets, same).select(*df.columns, (F.col("_off") + F.col("_sum_in")).alias(out))
