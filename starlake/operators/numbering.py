"""Dense numbering inside groups, also of groups that no task can sort.

``row_number() over (partition by g order by o)`` sorts a whole group in one task. For groups that fit in a task that is the best
plan: one shuffle by the group, which a join on the group shares. A key with a third of all rows doesn't fit, so such keys are
found first, on a random sample; their rows are numbered by their position in one global order, in which a key is split among
partitions like any other, less the first position of their key. Which way a key goes changes the cost, not its numbers.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .ranking import positions

IN_TASK = 4_000_000   # rows of a key that a task may sort
SAMPLED = 1_000       # rows that a sample should hold of a key of that size
FEW_KEYS = 200_000    # as many keys may be broadcast


def heavy_keys(df: DataFrame, keys: Sequence[str], in_task: int = IN_TASK) -> DataFrame | None:
    """A written table of the keys that seem to have ``in_task`` rows or more; None if there is none.

    A table of fewer rows is only counted. In a sample, a key counts from half the rows expected on: of keys of ``in_task``
    rows practically none is missed, and there are at most two for each ``in_task`` rows of the table.
    """
    if df.count() < in_task:
        return None
    share = min(1.0, SAMPLED / in_task)
    found = written(df.select(*keys).sample(share, 17).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= share * in_task / 2).drop("_n"))
    return found if found.limit(1).count() else None


def _same(keys: Sequence[str], other: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{other}{k}"))
    return out


def _few(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def dense_number(df: DataFrame, group_cols: Sequence[str], chunk_exprs: Sequence[Column], order_cols: Sequence[str],
                 out: str = "line_number", in_task: int | None = None) -> DataFrame:
    """Dense 1..n number per group, ordered by ``(*chunk_exprs, *order_cols)``, nulls first.

    Null keys form groups, too, and no row is lost. Rows that the order can't tell apart get any of their numbers.
    """
    order = Window.partitionBy(*group_cols).orderBy(*chunk_exprs, *order_cols)
    heavy = heavy_keys(df, group_cols, in_task or IN_TASK)
    if heavy is None:
        return df.withColumn(out, F.row_number().over(order))
    named = _few(heavy.select(*[F.col(k).alias(f"_h_{k}") for k in group_cols]))
    match = _same(group_cols, "_h_")
    light = df.join(named, match, "left_anti").withColumn(out, F.row_number().over(order))
    chunks = {f"_chunk{i}": e for i, e in enumerate(chunk_exprs)}
    rows = positions(df.join(named, match, "left_semi").withColumns(chunks), [*group_cols, *chunks, *order_cols], written, "_place")
    firsts = written(rows.groupBy(*group_cols).agg(F.min("_place").alias("_first")).select(*[F.col(k).alias(f"_f_{k}") for k in group_cols], "_first"))
    heavies = rows.join(_few(firsts), _same(group_cols, "_f_")).select(*df.columns, (F.col("_place") - F.col("_first") + 1).cast("int").alias(out))
    return light.unionByName(heavies)
