"""Metric-view compiler: join pruning, routing equality, lint, hand-made measure math."""
from pyspark.sql import functions as F

from starlake.operators.semantic import compile_query, lint, materialize, referenced_aliases
from starlake.plans.views import METRIC_VIEWS, MV_SALES


def test_lint_all_views(wh):
    for v in METRIC_VIEWS:
        assert lint(v, wh.frames) == [], v.name


def test_join_pruning(wh):
    df = compile_query(MV_SALES, wh.frames, ["fiscal_year"], ["net_sales"])
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "channel_type" not in plan and "loyalty_tier" not in plan
    assert referenced_aliases("SUM(source.x) + dim_date.y") == {"source", "dim_date"}


def test_routed_equals_unrouted(wh):
    mv = MV_SALES.materialized[0]
    mats = {mv.name: materialize(MV_SALES, wh.frames, mv)}
    for dims in (["department"], ["region", "department"], []):
        a = compile_query(MV_SALES, wh.frames, dims, ["net_sales", "units"], materialized=mats)
        b = compile_query(MV_SALES, wh.frames, dims, ["net_sales", "units"])
        assert sorted(a.collect()) == sorted(b.collect())


def test_distinct_count_not_rolled_up(wh):
    mv = MV_SALES.materialized[0]
    mats = {mv.name: materialize(MV_SALES, wh.frames, mv)}
    a = compile_query(MV_SALES, wh.frames, ["department"], ["transaction_count"], materialized=mats)
    b = compile_query(MV_SALES, wh.frames, ["department"], ["transaction_count"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_measure_math_on_hand_rows(spark):
    from decimal import Decimal as D
    sales = spark.createDataFrame(
        [(1, 1, 2, D("100"), D("10"), D("90"), D("60"), D("30"), 1),
         (1, 2, 1, D("50"), D("0"), D("50"), D("30"), D("20"), 1)],
        "transaction_id long, line_number int, quantity int, gross_sales_amount decimal(18,2), "
        "discount_amount decimal(18,2), net_sales_amount decimal(18,2), cogs_amount decimal(18,2), "
        "gross_margin_amount decimal(18,2), date_sk long")
    frames = {"fact_sales_line": sales}
    r = compile_query(MV_SALES, frames, [], ["net_sales", "gross_margin_pct", "transaction_count",
                                             "avg_order_value", "avg_unit_price", "discount_rate"]).first()
    assert float(r.net_sales) == 140.0 and r.transaction_count == 1
    assert abs(r.gross_margin_pct - 50 / 140) < 1e-12 and r.avg_order_value == 140.0
    assert abs(r.avg_unit_price - 50.0) < 1e-12 and abs(r.discount_rate - 10 / 150) < 1e-12


def test_filter_pushed_to_scan(wh):
    df = compile_query(MV_SALES, wh.frames, ["category"], ["units"], where="fiscal_year = 1998")
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "Filter" in x and "= 1998" in x)
    assert "Generate explode" in lines[at + 1]  # right above the calendar's days, below every join
    assert df.count() > 0


def test_stored_aggregate_answers_alone(spark, built, tmp_path):
    from starlake.plans.build import stored_aggregate
    from starlake.plans.datasets import net_sales_by_department
    mats = {"mv_sales_daily": stored_aggregate(built, MV_SALES, "mv_sales_daily", str(tmp_path / "mv"))}
    routed = net_sales_by_department(built, mats)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "mv" in plan and "fact_sales_line" not in plan and "sales_enriched" not in plan
    assert sorted(routed.collect()) == sorted(net_sales_by_department(built).collect())


def test_count_over_no_rows_is_zero(spark):
    from starlake.operators.semantic import MaterializedView, MetricField, MetricView
    view = MetricView("v", "f", "", (MetricField("k", "source.k"),), (MetricField("n", "COUNT(1)"), MetricField("s", "SUM(source.x)")),
                      materialized=(MaterializedView("m", ("k",), ("n", "s")),))
    rows = spark.createDataFrame([(1, 5)], "k int, x int")
    stored = materialize(view, {"f": rows}, view.materialized[0])
    r = compile_query(view, {"f": rows}, [], ["n", "s"], where="k = 9", materialized={"m": stored}).first()
    assert (r.n, r.s) == (0, None)


def test_filter_text_is_no_dimension(wh):
    df = compile_query(MV_SALES, wh.frames, ["category"], ["units"], where_col=F.col("fiscal_year") == F.lit(1998), where_dims=["fiscal_year"])
    assert "dim_store" not in df._jdf.queryExecution().analyzed().toString() and df.count() > 0


def test_filters_reach_both_sides_of_the_kpis(wh):
    from starlake.plans.datasets import inventory_position, kpis
    one = kpis(wh, "division = 'Everyday'", "channel_type = 'Digital'").first()
    stock = inventory_position(wh, "division = 'Everyday'").agg(F.sum("on_hand_cost_value")).first()[0]
    assert one.on_hand_value == stock and one.net_sales < kpis(wh, "division = 'Everyday'").first().net_sales
