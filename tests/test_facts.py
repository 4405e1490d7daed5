"""Derived-fact invariants (the reference's test style: generate small, assert invariants)."""
from pyspark.sql import functions as F


def test_sales_grain_and_identities(wh):
    s = wh.fact_sales_line
    assert s.count() == s.select("transaction_id", "line_number").distinct().count()
    assert s.filter(F.col("net_sales_amount") != F.col("gross_sales_amount") - F.col("discount_amount")).count() == 0


def test_returns_rate_and_refund_bound(wh):
    r, s = wh.fact_returns, wh.fact_sales_line
    rate = r.count() / s.count()
    assert 0.04 <= rate <= 0.13
    j = r.join(s.select(F.col("transaction_id").alias("original_transaction_id"),
                        F.col("line_number").alias("original_line_number"), "net_sales_amount"),
               ["original_transaction_id", "original_line_number"])
    assert j.filter(F.col("refund_amount") > F.col("net_sales_amount")).count() == 0


def test_gl_timing_shift_conserves_gross(wh):
    gl = wh.fact_gl_actuals.join(wh.dim_gl_account, "gl_account_sk").filter(F.col("account_number") == "4000")
    assert gl.agg(F.sum("actual_amount")).first()[0] == wh.fact_sales_line.agg(F.sum("gross_sales_amount")).first()[0]


def test_loyalty_balance_is_running_sum(wh):
    from pyspark.sql import Window
    la = wh.fact_loyalty_activity
    w = Window.partitionBy("customer_sk").orderBy("date_sk", "loyalty_event_id")
    chk = la.withColumn("rt", F.sum("points").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert chk.filter(F.col("rt") != F.col("points_balance")).count() == 0


def test_forecast_interval_and_versions(wh):
    f = wh.fact_sales_forecast
    assert f.filter((F.col("lower_bound") > F.col("forecast_qty")) | (F.col("forecast_qty") > F.col("upper_bound"))).count() == 0
    assert {r[0] for r in f.select("forecast_version").distinct().collect()} == {"baseline", "improved"}


def test_partition_count_invariance(spark):
    from starlake.plans.settings import REGISTERED
    from starlake.plans.warehouse import Warehouse
    from tests.conftest import SF
    fp = []
    for parts in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        w = Warehouse(spark, SF, REGISTERED)
        fp.append(w.fact_returns.agg(F.count("*"), F.sum("refund_amount"), F.sum("quantity")).first())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert fp[0] == fp[1] == fp[2]


def test_rates_and_horizon_are_the_callers(spark, wh):
    from dataclasses import replace
    from starlake.plans.settings import REGISTERED
    from starlake.plans.warehouse import Warehouse
    from tests.conftest import SF
    more = Warehouse(spark, SF, replace(REGISTERED, horizon_weeks=3, review_rate="1", case_rate="0.5", override_rate="1"))
    lines = wh.fact_sales_line.count()
    assert more.product_review_staging.count() == lines
    assert 0.4 * lines < more.service_case_staging.count() < 0.6 * lines
    assert more.fact_sales_forecast.select("fiscal_year", "fiscal_week").distinct().count() == 3
    assert more.forecast_override.count() == more.fact_sales_forecast.count() / 2


def test_every_low_stock_cell_is_ordered(wh):
    low = wh.latest_snapshot.where("available_qty <= reorder_point")
    assert wh.replenishment_order.count() == low.count() > 50


def test_latest_snapshot_equals_the_whole_ones_last_period(wh):
    last = wh.fact_inventory_snapshot.agg(F.max("date_sk")).first()[0]
    whole = wh.fact_inventory_snapshot.where(F.col("date_sk") == last)
    assert sorted(map(str, whole.collect())) == sorted(map(str, wh.latest_snapshot.collect()))


def test_lines_are_numbered_in_the_stated_order(wh):
    from pyspark.sql import Window
    w = Window.partitionBy("transaction_id").orderBy("source_line", "product_sk", "store_sk")
    assert wh.sales_enriched.withColumn("n", F.row_number().over(w)).where("n <> line_number").count() == 0


def test_rows_with_null_keys_stay(spark, tmp_path):
    """A line without part, supplier or number, and events of the anonymous visitor, are rows like others."""
    from starlake.plans.settings import REGISTERED
    from starlake.plans.warehouse import Warehouse
    from tests.conftest import SF
    for t in ("region", "nation", "customer", "supplier", "part", "orders"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    li = spark.read.parquet(f"{SF}/lineitem.parquet").limit(40)
    hole = lambda c: li.withColumn(c, F.lit(None).cast(li.schema[c].dataType))
    li.unionByName(hole("l_partkey")).unionByName(hole("l_suppkey")).unionByName(hole("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    ev = spark.read.parquet(f"{SF}/events.parquet").limit(30)
    ev.unionByName(ev.withColumn("user_id", F.lit(None).cast("long"))).unionByName(ev.withColumn("event_id", F.lit(None).cast("long"))) \
        .write.parquet(f"{tmp_path}/events.parquet")
    w = Warehouse(spark, str(tmp_path), REGISTERED)
    assert w.fact_sales_line.count() == 160 and w.fact_inventory_movement.count() == 160 and w.sales_base.count() == 160
    assert w.fact_web_events.count() == 90
    assert w.fact_web_events.where("customer_sk is null").count() >= 30


def test_no_scan_for_dates_and_no_line_numbering_in_aggregates(wh):
    plan = wh.fact_gl_actuals._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "row_number" not in plan
    assert "lineitem" not in wh.dim_date._jdf.queryExecution().toString()


def test_same_rows_in_another_time_zone(spark):
    from starlake.plans.settings import REGISTERED
    from starlake.plans.warehouse import Warehouse
    from tests.conftest import SF
    seen = []
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        w = Warehouse(spark, SF, REGISTERED)
        seen.append([sorted(map(str, t.collect())) for t in (w.fact_web_events, w.replenishment_order, w.dim_customer)])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1]


def test_large_amounts_and_zero_quantity(spark, wh):
    """A week of 1e9 sales at 1e6 units, and lines of no quantity, give numbers, not errors."""
    from starlake.plans.ai import build_fact_sales_forecast
    from starlake.plans.facts import build_fact_returns
    sales = wh.sales_base.withColumn("net_sales_amount", F.lit("900000000.00").cast("decimal(18,2)")).withColumn("quantity", F.lit(1_000_000))
    f = build_fact_sales_forecast(sales, wh.sale_days, wh.sales_calendar, horizon_weeks=4)
    assert f.agg(F.max("forecast_amount")).first()[0] > 8 * 10**8
    none = build_fact_returns(wh.sales_base.withColumn("quantity", F.lit(0)), wh.sales_calendar, rate="1")
    assert none.count() == wh.sales_base.count() and none.agg(F.min("quantity")).first()[0] == 1


def _small_star(spark):
    """(sales, dim_product, calendar): two stores, a product that is not known, one that is there twice, nulls."""
    from datetime import date
    from starlake.functions import calendar as cal
    days = cal.date_attributes(cal.day_range(spark.createDataFrame([(date(2020, 1, 1), date(2020, 12, 31))], "start date, end date")))
    sales = spark.createDataFrame([(20200115, 1, 10, 4), (20200520, 1, 11, 2), (20200115, 2, 12, 9), (20200801, None, 10, 1), (20200801, 2, None, 3), (20201101, 2, 11, None)],
                                  "date_sk long, store_sk long, product_sk long, quantity int")
    products = spark.createDataFrame([(10, "A", 2.5), (11, "B", 1.25), (11, "C", 1.5)], "product_sk long, category_id string, p double").select(
        "product_sk", "category_id", F.col("p").cast("decimal(18,2)").alias("list_price"), (F.col("p") / 2).cast("decimal(18,2)").alias("standard_cost"))
    return sales, products, days


def test_snapshot_joins_pairs_not_cells(spark):
    from starlake.plans.facts import build_fact_inventory_snapshot
    sales, products, days = _small_star(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if products were many
    try:
        cells = build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8, beside=products.select("product_sk", "category_id"))
        plan = cells._jdf.queryExecution().sparkPlan().toString()
        assert "Generate explode" in plan and "SortMergeJoin" not in plan.split("Generate explode")[0]
        assert cells.columns[-1] == "category_id"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cells_beside_a_product_table_are_the_joined_cells(spark):
    from starlake.plans.facts import build_fact_inventory_snapshot
    sales, products, days = _small_star(spark)
    category = products.select("product_sk", "category_id")
    joined = build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8).join(category, "product_sk")
    beside = build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8, beside=category).select(*joined.columns)
    assert joined.count() and not joined.exceptAll(beside).count() and not beside.exceptAll(joined).count()


def test_draws_of_a_digest_are_the_single_draws(spark):
    from starlake.functions.keyed import millionths, uniform_slice
    one = spark.range(500).select(*[uniform_slice("id", salt="s", part=i).alias(f"a{i}") for i in range(4)],
                                  *[m.alias(f"m{i}") for i, m in enumerate(millionths(F.md5(F.concat(F.col("id").cast("string"), F.lit("|s")))))],
                                  *[F.pmod(F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit("|s"))), 8 * i + 1, 8), 16, 10).cast("long"), F.lit(1000000)).alias(f"o{i}")
                                    for i in range(4)])
    assert one.where(" OR ".join(f"m{i} <> o{i} OR a{i} * 1000000 <> m{i}" for i in range(4))).count() == 0


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Exchange ")[1:]


def test_pairs_are_dealt_by_lines_and_shuffled_once(spark):
    from starlake.plans import facts
    sales, products, days = _small_star(spark)
    few, many = (facts.line_tasks(spark, n) for n in (1, 100 * facts.TASK_LINES))
    assert few == spark.sparkContext.defaultParallelism and many == 100
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if products were many
    try:
        own = facts.build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8, only_latest=True, lines=100 * facts.TASK_LINES)
        skus = own.groupBy("unit_cost").agg(F.countDistinct("product_sk"))
        assert sum("hashpartitioning(store_sk" in x for x in _exchanges(skus)) == 0
        assert sum("hashpartitioning(product_sk" in x and ", 100)" in x for x in _exchanges(skus)) == 2  # lines and products
        plain = facts.build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8, only_latest=True)
        assert own.count() and not own.exceptAll(plain).count() and not plain.exceptAll(own).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_halves_round_up(spark):
    from starlake.plans.facts import _whole_half_up
    xs = [0.0, 0.49999999999999994, 0.5, 1.4999999999999998, 2.5, 3.5, 1e9 + 0.5, 123456.5000001, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert df.where(~_whole_half_up(F.col("x")).eqNullSafe(F.round("x").cast("int"))).count() == 0


def test_a_ledger_dealt_by_store_is_the_same(wh):
    from starlake.plans import facts, finance
    moved, returned = wh.movements(wh.sales), facts.build_fact_returns(wh.sales, wh.sales_calendar)
    plain, dealt = (finance.build_fact_gl_actuals(wh.sales, returned, moved, wh.sales_calendar, wh.dim_gl_account, wh.dim_department, tasks=n) for n in (None, 5))
    assert plain.count() and not plain.exceptAll(dealt).count() and not dealt.exceptAll(plain).count()


def test_budget_lines_are_summed_where_they_are_made(wh):
    from starlake.registry import QUERIES
    plan = QUERIES["budget_plan_by_period"](wh.spark, wh.sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan
    above = plan.split("Generate explode")[0]
    assert above.count("Exchange ") == 1 and "hashpartitioning(fiscal_year" in above  # sums only


def test_cells_of_the_latest_period_are_not_dealt_out_by_store(spark, wh, monkeypatch):
    from starlake.plans import datasets as ds
    from starlake.plans.settings import REGISTERED
    from starlake.plans.warehouse import Warehouse
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = sorted(map(str, ds.inventory_position(wh).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with stores that Spark takes for too many
    try:
        few = ds.inventory_position(Warehouse(spark, wh.sf_dir, REGISTERED))
        assert not any(x.startswith("hashpartitioning(store_sk") for x in _exchanges(few))
        assert sorted(map(str, few.collect())) == expected
        monkeypatch.setattr(ds, "STORES_IN_MEMORY", 0)
        many = ds.inventory_position(Warehouse(spark, wh.sf_dir, REGISTERED))
        assert any(x.startswith("hashpartitioning(store_sk") for x in _exchanges(many))
        assert sorted(map(str, many.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_cells_of_a_pair_are_drawn_at_once(spark):
    """Drawn in one call for all period-ends, not by a text digest a cell; the draws are those that the latest period's cells take by themselves."""
    from starlake.plans.facts import CENTS, TENTHS, build_fact_inventory_snapshot, in_whole_numbers, stock_cells
    sales, products, days = _small_star(spark)
    whole = build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan and "draw(" in plan
    last = whole.agg(F.max("date_sk")).first()[0]
    alone = build_fact_inventory_snapshot(sales, products, days, weeks_of_supply=8, only_latest=True)
    assert alone.count() and sorted(map(str, whole.where(F.col("date_sk") == last).collect())) == sorted(map(str, alone.collect()))
    per_pair = {(r.store_sk, r.product_sk): r.n for r in whole.groupBy("store_sk", "product_sk").agg(F.countDistinct("date_sk").alias("n")).collect()}
    first = {(r.store_sk, r.product_sk): r.d for r in sales.groupBy("store_sk", "product_sk").agg(F.min("date_sk").alias("d")).collect()}
    ends = sorted(r.d for r in days.groupBy("fiscal_year", "fiscal_period").agg(F.max("date_sk").alias("d")).collect())
    assert per_pair == {k: sum(e >= d for e in ends) for k, d in first.items()}
    own = stock_cells(sales, products, days, weeks_of_supply=8).select("date_sk", "store_sk", "product_sk", *CENTS.values(), *TENTHS.values())
    assert sorted(map(str, own.collect())) == sorted(map(str, in_whole_numbers(whole).select(own.columns).collect()))


def test_snapshot_totals_are_those_of_the_decimals(wh):
    """Totals, medians and valuations come from whole cents and tenths, and are those of the money columns."""
    from starlake.registry import QUERIES, as_output
    s = wh.fact_inventory_snapshot
    want = as_output(s.groupBy("date_sk").agg(F.count("*").alias("cells"), *[F.sum(c).alias(c) for c in ("on_hand_retail_value", "on_hand_cost_value", "days_of_supply")]))
    got = QUERIES["inventory_snapshot_by_period"](wh.spark, wh.sf_dir).select(want.columns)
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert QUERIES["days_of_supply_median"](wh.spark, wh.sf_dir).dtypes == [("date_sk", "bigint"), ("median_days", "double")]
    held = wh.fact_inventory_valuation.agg(F.sum("on_hand_cost_value"), F.sum("on_hand_retail_value")).first()
    assert tuple(held) == tuple(s.agg(F.sum("on_hand_cost_value"), F.sum("on_hand_retail_value")).first())
