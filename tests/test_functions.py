"""Keyed draws, calendar and numbering operators on hand-made rows."""
import datetime as dt

from pyspark.sql import functions as F

from starlake.functions import calendar as cal
from starlake.functions.keyed import bounded_int, id64, pick, shifted_date_sk, uniform, weighted_pick
from starlake.operators.numbering import dense_number
from starlake.operators.running import running_total


def test_uniform_in_range_and_deterministic(spark):
    df = spark.range(2000).select(uniform(F.col("id"), salt="x").alias("u"))
    a = df.agg(F.min("u"), F.max("u"), F.sum("u")).first()
    b = spark.range(2000).repartition(7).select(uniform(F.col("id"), salt="x").alias("u")).agg(F.sum("u")).first()
    assert a[0] >= 0 and a[1] < 1
    assert a[2] == b[0]  # partition-independent


def test_bounded_int_and_pick(spark):
    df = spark.range(1000).select(bounded_int(F.col("id"), salt="b", lo=3, hi=7).alias("b"),
                                  pick(("a", "b"), F.col("id"), salt="p").alias("p"))
    r = df.agg(F.min("b"), F.max("b"), F.countDistinct("p")).first()
    assert (r[0], r[1], r[2]) == (3, 7, 2)


def test_weighted_pick_shares(spark):
    df = spark.range(20000).select(
        weighted_pick(uniform(F.col("id"), salt="w"), ("x", "y"), (80, 20)).alias("v"))
    share = df.filter(F.col("v") == "x").count() / 20000
    assert 0.77 < share < 0.83


def test_id64_non_negative_and_unique(spark):
    df = spark.range(5000).select(id64(F.col("id"), tag="t").alias("i"))
    r = df.agg(F.min("i"), F.countDistinct("i")).first()
    assert r[0] >= 0 and r[1] == 5000


def test_shifted_date_clamped(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 20),), (dt.date(2025, 12, 31),)], "d date")
    mx = F.lit(dt.date(2025, 12, 31))
    out = [r[0] for r in df.select(shifted_date_sk(F.col("d"), F.lit(20), mx)).collect()]
    assert out == [20251231, 20251231]
    out5 = df.select(shifted_date_sk(F.col("d"), F.lit(5), mx)).first()[0]
    assert out5 == 20251225


def test_calendar_known_dates(spark):
    days = spark.createDataFrame(
        [(dt.date(2025, 12, 25),), (dt.date(2025, 2, 2),), (dt.date(2025, 2, 1),), (dt.date(2025, 11, 27),),
         (dt.date(2025, 11, 28),), (dt.date(2025, 5, 26),), (dt.date(2025, 9, 1),)], "date date")
    rows = {r["date"]: r for r in cal.date_attributes(days).collect()}
    xmas = rows[dt.date(2025, 12, 25)]
    assert xmas.is_holiday and xmas.holiday_name == "Christmas Day" and xmas.month_name == "December"
    assert rows[dt.date(2025, 2, 2)].fiscal_year == 2025 and rows[dt.date(2025, 2, 2)].fiscal_week == 1
    assert rows[dt.date(2025, 2, 1)].fiscal_year == 2024
    assert rows[dt.date(2025, 11, 27)].holiday_name == "Thanksgiving"
    assert rows[dt.date(2025, 11, 28)].holiday_name == "Black Friday"
    assert rows[dt.date(2025, 5, 26)].holiday_name == "Memorial Day"
    assert rows[dt.date(2025, 9, 1)].holiday_name == "Labor Day"


def test_fiscal_period_pattern(spark):
    df = spark.range(1, 54).select(F.col("id").alias("fw"))
    got = [r[0] for r in df.select(cal.fiscal_period_of_week(F.col("fw"))).collect()]
    expected = []
    for p, n in enumerate((4, 5, 4, 4, 5, 4, 4, 5, 4, 4, 5, 4), start=1):
        expected += [p] * n
    assert got == expected + [12]  # week 53 stays in period 12


def test_dense_number_matches_row_number_rules(spark):
    # one hot group of 5,000 rows plus many small groups
    hot = spark.range(5000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    small = spark.range(3000).select((F.col("id") + 10).alias("g"), F.col("id").alias("v"))
    df = dense_number(hot.unionByName(small), ["g"], [F.floor(F.col("v") / 100)], ["v"], out="n")
    r = df.groupBy("g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("c"),
                            F.countDistinct("n").alias("d"))
    bad = r.filter((F.col("lo") != 1) | (F.col("hi") != F.col("c")) | (F.col("d") != F.col("c"))).count()
    assert bad == 0
    assert df.where("g = 1 AND n <> v + 1").count() == 0  # the plain order


def test_numbering_and_totals_keep_null_keys(spark):
    rows = spark.createDataFrame([(None, 1, 5), (None, None, 7), (1, 2, 3), (1, None, 4), (1, 2, 3)], "g long, v long, x long")
    n = dense_number(rows, ["g"], [F.col("v")], ["v", "x"], out="n").collect()
    assert sorted((str(r.g), str(r.v), r.n) for r in n) == [("1", "2", 2), ("1", "2", 3), ("1", "None", 1), ("None", "1", 2), ("None", "None", 1)]
    t = running_total(rows, ["g"], ["v"], ["x"], "x", "t").collect()
    assert sorted((str(r.g), str(r.v), r.t) for r in t) == [("1", "2", 7), ("1", "2", 10), ("1", "None", 4), ("None", "1", 12), ("None", "None", 7)]


def test_history_start(spark):
    days = spark.createDataFrame([(dt.date(2026, 1, 31),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)], "d date")
    got = [r[0] for r in days.select(cal.history_start(F.col("d"), 1)).collect()]
    assert got == [dt.date(2025, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 1)]


def test_cap1_keeps_long_text(spark):
    from starlake.functions.keyed import cap1
    assert spark.range(1).select(F.length(cap1(F.repeat(F.lit("aB"), 1_000_000)))).first()[0] == 2_000_000


def test_running_total_equals_plain_window(spark):
    from pyspark.sql import Window
    df = spark.range(4000).select((F.col("id") % 3).alias("g"), (F.col("id") % 50).alias("day"),
                                  F.col("id").alias("k"), ((F.col("id") * 7) % 11 - 5).alias("x"))
    ours = running_total(df, ["g"], ["day", F.floor(F.col("k") / 7)], ["k"], "x", "rt")
    w = Window.partitionBy("g").orderBy("day", "k").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("rt2", F.sum("x").over(w))
    diff = ours.join(ref, ["g", "day", "k", "x"]).filter(F.col("rt") != F.col("rt2")).count()
    assert diff == 0 and ours.count() == 4000


def test_nulls_in_different_places_are_different_keys(spark):
    from starlake.functions.keyed import hash_bits, id128, uniform_slice
    keys = spark.createDataFrame([(None, "5"), ("5", None), (None, None), ("", None), ("1:", "5"), ("1", ":5"), ("a|b", "c"), ("a", "b|c")], "a string, b string")
    assert keys.select(id128("a", "b", tag="t").alias("x")).distinct().count() == 8
    first = keys.limit(4)
    for column in (hash_bits("a", "b", salt="s"), hash_bits("a", "b", salt="s", family="murmur3"), uniform_slice("a", "b", salt="s", part=1)):
        assert first.select(column.alias("x")).distinct().count() == 4


def test_a_key_of_nearly_all_rows_is_numbered_in_many_tasks(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 10 > 0, F.lit(None).cast("int")).otherwise((F.col("id") % 50).cast("int")).alias("g"),
                                    F.when(F.col("id") % 97 > 0, F.col("id") * 7919 % 6000).alias("v"), "id")
    want = sorted(dense_number(rows, ["g"], [F.floor(F.col("v") / 10)], ["v", "id"], out="n").collect(), key=str)
    ours = dense_number(rows.repartition(5), ["g"], [F.floor(F.col("v") / 10)], ["v", "id"], out="n", in_task=1000)
    assert sorted(ours.collect(), key=str) == want and len(want) == 6000
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan  # rows never meet themselves
    assert max(r.n for r in want if r.g is None) == 5400


def test_line_numbers_need_no_join_of_lines_with_lines(wh):
    plan = wh.fact_sales_line._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber") and plan.count("lineitem") <= 1 and plan.count("Relation [l_orderkey") == 1


def test_digests_at_once_are_the_single_ones():
    import hashlib

    import numpy as np
    import pyarrow as pa

    from starlake.functions import digests
    heads = [f"{7 ** i}|{11 ** (i % 6)}|" for i in range(12)] + ["(null)|5|", "", "ä|1|", "x" * 46, "x" * 70]  # 46 and 9 bytes fill a block
    tails = ["8|stock", "20200131|s", "20200131|", "20200229|", ""]
    first = [i % 7 for i in range(len(heads))]
    for part in range(4):
        starts, got = digests.followed(pa.array(["before", *heads])[1:], [t.encode() for t in tails], np.array(first), lambda n, at: n[part].astype("int64") * 8 + at)
        want = [[int(hashlib.md5((h + tails[j]).encode()).hexdigest()[8 * part:8 * part + 8], 16) * 8 + j for j in range(f, len(tails))] for h, f in zip(heads, first)]
        assert [got[a:b].tolist() for a, b in zip(starts, starts[1:])] == want
    n = digests.AT_ONCE + 100
    _, many = digests.followed(pa.array([f"{i}|" for i in range(n)]), [b"20200131|stock"], np.zeros(n, "int64"), lambda n, at: digests.millionths(n[3]).astype("int64"))
    assert many.tolist() == [int(hashlib.md5(f"{i}|20200131|stock".encode()).hexdigest()[24:], 16) % 1_000_000 for i in range(n)]
