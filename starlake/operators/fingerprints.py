"""AG22, CHK12: order-free fingerprints of whole tables, and what differs between two builds.

A row's text has every column with its length, nulls apart; its MD5 gives two 60-bit numbers. The fingerprint of a set of rows
is their count and the sums of these numbers in wide decimals: it doesn't depend on order or partitioning, a changed cell
changes it, and, unlike an exclusive or, so does a row swapped for a copy of another one. Sums merge, so partitions' prints add
up to their table's and a table is read once. Texts are such that any SQL engine computes the same prints.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import TableSpec

_WIDE = "decimal(38,0)"


LIMB = 22  # bits: sums of 2^41 such limbs fit in 64 bits


def wide_sum(number: Column) -> Column:
    """The exact sum of 64-bit numbers as a wide decimal, from the sums of their limbs, which are longs."""
    low = lambda by: F.sum(F.shiftright(number, by).bitwiseAND(F.lit((1 << LIMB) - 1)))
    limbs = (low(0), low(LIMB), F.sum(F.shiftright(number, 2 * LIMB)))
    units = [F.lit(str(1 << (LIMB * i))).cast("decimal(14,0)") for i in range(3)]
    return sum((x.cast("decimal(20,0)") * u for x, u in zip(limbs[1:], units[1:])), limbs[0].cast("decimal(20,0)")).cast(_WIDE)


def cell_text(name: str, dtype: str) -> Column:
    """``length:text`` of a cell, ``null`` without one."""
    c = F.col(name)
    text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if dtype.startswith("timestamp") else c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))


def partition_of(spec: TableSpec) -> Column:
    """What a table's prints are kept by: the year of its ``date_sk``, or nothing."""
    return F.coalesce(F.expr("date_sk div 10000").cast("string"), F.lit("none")) if "date_sk" in spec.names else F.lit("all")


def fingerprint(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(table_name, part, row_count, digest)`` of a table, a row per partition."""
    text = F.concat_ws("|", *[cell_text(c.name, c.dtype) for c in spec.columns])
    hashed = spec.project(df).select(partition_of(spec).alias("part"), F.md5(text).alias("h"))
    halves = [wide_sum(F.conv(F.substring("h", at, 15), 16, 10).cast("long")).cast("string") for at in (1, 17)]
    return hashed.groupBy("part").agg(F.count(F.lit(1)).alias("row_count"), F.concat_ws(":", *halves).alias("digest")).select(F.lit(spec.name).alias("table_name"), "part", "row_count", "digest")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(table_name, part, rows_a, rows_b)`` of the partitions whose prints differ; a missing partition has no rows."""
    one, two = (x.select("table_name", "part", F.col("row_count").alias(f"rows_{n}"), F.col("digest").alias(f"digest_{n}")) for x, n in ((a, "a"), (b, "b")))
    both = one.join(two, ["table_name", "part"], "full")
    return both.where(~F.col("digest_a").eqNullSafe(F.col("digest_b")) | ~F.col("rows_a").eqNullSafe(F.col("rows_b"))).select(
        "table_name", "part", *[F.coalesce(f"rows_{n}", F.lit(0)).alias(f"rows_{n}") for n in "ab"])
