"""Fingerprints of tables and independence of drawn attributes: what must be found, and what must not."""
import pytest
from pyspark.sql import functions as F

from starlake.functions.keyed import percent_flag, pick
from starlake.operators.fingerprints import differences, fingerprint
from starlake.operators.independence import DRAWN, Pair, independence
from starlake.operators.schema import C, TableSpec

SPEC = TableSpec("s", "t", "a row", (C("date_sk", "long"), C("name", "string"), C("amount", "money"), C("at", "timestamp_ntz")))


@pytest.fixture
def table(spark):
    return spark.range(2000).select((20240101 + F.col("id") % 3 * 10000).alias("date_sk"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("n"), F.col("id"))).alias("name"),
                                    (F.col("id") * F.lit(0.25).cast("decimal(4,2)")).alias("amount"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("at"))


def found(a, b):
    return [tuple(r) for r in differences(fingerprint(a, SPEC), fingerprint(b, SPEC)).orderBy("part").collect()]


def test_order_and_partitioning_don_t_matter(table):
    assert found(table, table.orderBy(F.desc("name")).repartition(7)) == []


def test_one_changed_cell_is_named(table):
    other = table.withColumn("amount", F.when(F.col("name") == "n7", F.col("amount") + 1).otherwise(F.col("amount")))
    assert found(table, other) == [("t", "2025", 667, 667)]


def test_a_row_swapped_for_a_copy_is_named(table):
    one = table.where("name = 'n3'")
    assert found(table, table.where("name <> 'n6' or name is null").unionByName(one)) == [("t", "2024", 667, 667)]
    assert found(table.unionByName(one).unionByName(one), table) == [("t", "2024", 669, 667)]  # two more of a row don't cancel


def test_missing_partitions_and_nulls(table):
    assert found(table, table.where("date_sk <> 20260101")) == [("t", "2026", 666, 0)]
    a = table.withColumn("date_sk", F.lit(None).cast("long")).withColumn("name", F.lit(None).cast("string"))
    assert found(a, a.withColumn("name", F.lit("null"))) == [("t", "none", 2000, 2000)]
    assert found(a, a) == found(a.limit(0), a.limit(0)) == []


def verdict(df, a="a", b="b"):
    return independence(df, Pair("t", a, b)).first()


def test_a_shared_salt_is_found(spark):
    rows = spark.range(5000)
    drawn = rows.select(percent_flag("id", salt="one", pct=30).alias("a"), percent_flag("id", salt="two", pct=60).alias("b"),
                        percent_flag("id", salt="one", pct=60).alias("same"), pick(("x", "y", "z"), "id", salt="three").alias("c"))
    assert not verdict(drawn).dependent and not verdict(drawn, "b", "c").dependent
    assert verdict(drawn, "a", "same").dependent and verdict(drawn, "a", "a").dependent
    assert verdict(drawn.withColumn("n", F.when(F.col("a"), F.lit("k"))), "a", "n").dependent  # null is a value


def test_no_rows_or_one_value(spark):
    none = verdict(spark.createDataFrame([], "a int, b int"))
    assert (none.row_count, none.dependent) == (0, False)
    one = verdict(spark.createDataFrame([(1, 1), (1, 2)], "a int, b int"))
    assert (one.freedom, one.g, one.dependent) == (0, 0.0, False)


def test_the_warehouse_s_pairs(built):
    assert not any(independence(built.frames[p.table], p).first().dependent for p in DRAWN)


def test_wide_sums_are_exact(spark):
    from starlake.operators.fingerprints import wide_sum
    df = spark.createDataFrame([(-2**63,), (-2**63,), (2**63 - 1,), (-1,), (None,), (12345678901234567,)], "x long")
    assert int(df.agg(wide_sum(F.col("x")).alias("s")).first()["s"]) == -2**64 + 2**63 - 2 + 12345678901234567
    assert df.limit(0).agg(wide_sum(F.col("x")).alias("s")).first()["s"] is None
    plan = df.agg(wide_sum(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(" not in plan.lower()  # limbs are added as longs, not as wide decimals
