"""Positions in a global order, without a window over all rows and without a join of the rows to themselves.

Rows are range-partitioned and sorted once and written with their partition and place in it. A position is the number of rows
in earlier partitions, from a table of one row per partition, plus the place. A key that holds a third of all rows is split
among partitions like any other, as long as the order tells its rows apart.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_order(df: DataFrame, order: Sequence[str | Column], part: str = "_part", at: str = "_at") -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, nulls first, with each row's partition and place in it, from 0.

    Write it before use: the places hold for the rows as partitioned in that job.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return ranged.withColumns({part: F.spark_partition_id(), at: place})


def positions(df: DataFrame, order: Sequence[str | Column], write: Callable[[DataFrame], DataFrame], out: str = "position") -> DataFrame:
    """``df`` and each row's position in ``order``, from 0; rows that ``order`` can't tell apart have any of theirs.

    ``write`` writes a frame to shared storage and reads it back.
    """
    written = write(in_order(df, order))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return written.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + F.col("_at")).alias(out))  # a row per partition
