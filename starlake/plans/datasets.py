"""Analytical datasets and serving queries (DS1-DS16, RS7, RS8).

Dashboard datasets are metric-view queries (SEM2); cross-fact datasets join
two independently aggregated facts on conformed dimensions (drill-across), so
neither fact is ever joined to the other at line grain. Chain totals run as
``over ()`` windows only on category-grain frames (bounded by the taxonomy).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators.semantic import compile_query
from .views import MV_INVENTORY, MV_SALES

WEEKS_PER_YEAR = 52.0
CAT = ["division", "department", "category"]
STORES_IN_MEMORY = 1_000_000  # as many stores may be broadcast: a key and a few short texts each


def _d(x):
    return F.col(x).cast("double")


def _latest_fy(w):
    return w.latest_sale.select("fiscal_year").scalar()


def _latest_frames(w):
    """Frames whose snapshot has its latest period-end only: stock is never summed over dates, and without a
    build no other period's cells are ever expanded.

    Cells lie as their pairs were dealt to tasks. Stores come to them by broadcast up to a bound: to join by a
    shuffle, all cells would be dealt out again, by store and by bytes."""
    from .warehouse import Frames
    stores = F.broadcast(w.dim_store) if w.stores <= STORES_IN_MEMORY else w.dim_store
    return Frames(w, {"fact_inventory_snapshot": w.latest_snapshot, "dim_store": stores})


def sales_performance(w, where: str | None = None) -> DataFrame:
    """DS1: eight measures by year, quarter, period, division, department, category, region, channel type."""
    return compile_query(
        MV_SALES, w.frames,
        ["fiscal_year", "fiscal_quarter", "fiscal_period", "division", "department", "category", "region",
         "channel_type"],
        ["net_sales", "gross_sales", "gross_margin", "gross_margin_pct", "cogs", "units", "transaction_count",
         "discount_rate"], where=where)


def inventory_position(w, where: str | None = None) -> DataFrame:
    """DS2: latest snapshot only (stock is never summed over dates)."""
    return compile_query(
        MV_INVENTORY, _latest_frames(w), ["division", "department", "category", "region"],
        ["on_hand_qty", "on_hand_cost_value", "on_hand_retail_value", "out_of_stock_rate", "avg_days_of_supply",
         "sku_count"],
        where=where)


def bridge(w) -> DataFrame:
    """DS3: latest-fiscal-year sales flow x current inventory at category grain, with chain indices."""
    s = compile_query(MV_SALES, w.frames, CAT, ["net_sales", "gross_margin", "gross_margin_pct", "units", "cogs"],
                      where_col=F.col("fiscal_year") == _latest_fy(w), where_dims=["fiscal_year"])
    i = compile_query(MV_INVENTORY, _latest_frames(w), CAT, ["on_hand_qty", "on_hand_cost_value", "out_of_stock_rate"])
    j = s.join(i, CAT, "left")
    j = j.withColumns({
        "sell_through_pct": _d("units") / F.nullif(_d("units") + _d("on_hand_qty"), F.lit(0.0)),
        "weeks_of_supply": _d("on_hand_qty") * F.lit(WEEKS_PER_YEAR) / F.nullif(_d("units"), F.lit(0.0)),
        "gmroi": _d("gross_margin") / F.nullif(_d("on_hand_cost_value"), F.lit(0.0)),
        "inventory_turns": _d("cogs") / F.nullif(_d("on_hand_cost_value"), F.lit(0.0)),
    })
    chain = Window.partitionBy()      # category grain: a handful of rows
    # chain totals: exact sums first, one conversion to double
    su, sh = (F.sum(F.col(c)).over(chain).cast("double") for c in ("units", "on_hand_qty"))
    sm, sc = (F.sum(F.col(c)).over(chain).cast("double") for c in ("gross_margin", "on_hand_cost_value"))
    return j.withColumns({
        "sell_through_index": F.lit(100.0) * F.col("sell_through_pct")
        / F.nullif(su / F.nullif(su + sh, F.lit(0.0)), F.lit(0.0)),
        "inventory_efficiency_index": F.lit(100.0) * (sh / F.nullif(su, F.lit(0.0)))
        / F.nullif(_d("on_hand_qty") / F.nullif(_d("units"), F.lit(0.0)), F.lit(0.0)),
        "gmroi_index": F.lit(100.0) * F.col("gmroi") / F.nullif(sm / F.nullif(sc, F.lit(0.0)), F.lit(0.0)),
    })


def lost_sales(w, top: int = 25) -> DataFrame:
    """DS4: categories with high out-of-stock and high velocity in the latest period (top 25)."""
    now = (F.col("fiscal_year") == _latest_fy(w)) & (F.col("fiscal_period") == w.latest_sale.select("fiscal_period").scalar())
    s = compile_query(MV_SALES, w.frames, CAT, ["units", "net_sales"], where_col=now, where_dims=["fiscal_year", "fiscal_period"])
    i = compile_query(MV_INVENTORY, _latest_frames(w), CAT, ["out_of_stock_rate"])
    j = s.join(i, CAT)
    return (j.withColumn("risk_score", F.col("out_of_stock_rate") * _d("units"))
            .orderBy(F.col("risk_score").desc(), *CAT).limit(top))


def takeaway_prompt(w) -> DataFrame:
    """DS5: the current year's sales, margin and units, and an instruction that asks a model to comment on them."""
    a = compile_query(MV_SALES, w.frames, [], ["net_sales", "gross_margin", "units"],
                      where_col=F.col("fiscal_year") == _latest_fy(w), where_dims=["fiscal_year"])
    # GM % to one decimal, half away from zero, in exact integers; null without sales
    tenths = F.expr("(CAST(2000 * abs(gross_margin) * 100 AS DECIMAL(38,0)) + CAST(net_sales * 100 AS DECIMAL(38,0))) "
                    "div nullif(CAST(2 * net_sales * 100 AS DECIMAL(38,0)), 0)") * F.signum("gross_margin").cast("long")
    a = a.withColumn("gm_pct_1dp", (tenths.cast("decimal(18,0)") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(18,1)"))
    return a.select(
        "net_sales", "units", "gm_pct_1dp",
        F.concat(F.lit("This fiscal year so far: net sales "), F.round(F.col("net_sales"), 0).cast("long").cast("string"),
                 F.lit(", gross margin "), F.col("gm_pct_1dp").cast("string"), F.lit(" %, units "), F.col("units").cast("string"),
                 F.lit(". Tell the head of merchandising what stands out, in three points, one of them a danger.")).alias("prompt"))


def kpis(w, where: str | None = None, sales_where: str | None = None) -> DataFrame:
    """DS6 (DS11): KPI counters re-aggregated from DS1/DS2 (DOS and OOS are unweighted averages of cells).

    ``where`` filters by dimensions that both facts have (division, department, category, region) and goes
    to both; ``sales_where`` is for what stock has no such dimension for (channel type, fiscal time).
    """
    both = " AND ".join(f"({x})" for x in (where, sales_where) if x) or None
    s = sales_performance(w, both).agg(F.struct(
        F.sum("net_sales").alias("net_sales"), (_d_sum("gross_margin") / F.nullif(_d_sum("net_sales"), F.lit(0.0))).alias("gross_margin_pct"),
        F.sum("units").alias("units")).alias("s"))
    i = inventory_position(w, where).agg(F.struct(
        F.round(F.sum("avg_days_of_supply") / F.nullif(F.count("avg_days_of_supply"), F.lit(0)), 9).alias("avg_days_of_supply"),
        F.sum("on_hand_cost_value").alias("on_hand_value"),
        F.round(F.sum("out_of_stock_rate") / F.nullif(F.count("out_of_stock_rate"), F.lit(0)), 9).alias("out_of_stock_rate")).alias("i"))
    return w.spark.range(1).select(s.scalar().alias("s"), i.scalar().alias("i")).select("s.*", "i.*")


def _d_sum(c):
    return F.sum(F.col(c)).cast("double")


def sales_trend(w) -> DataFrame:
    """DS7: net sales by fiscal period with fiscal year as the series."""
    return compile_query(MV_SALES, w.frames, ["fiscal_period", "fiscal_year"], ["net_sales"])


def net_sales_by_department(w, materialized=None) -> DataFrame:
    """DS8 (SEM4): net sales by department; answered from the stored daily aggregate if one is given."""
    return compile_query(MV_SALES, w.frames, ["department"], ["net_sales", "units"], materialized=materialized)


def inventory_value_by_category(w) -> DataFrame:
    """DS8: the latest stock's cost and retail value by category."""
    return inventory_position(w).groupBy("category").agg(F.sum("on_hand_cost_value").alias("on_hand_cost_value"),
                                                         F.sum("on_hand_retail_value").alias("on_hand_retail_value"))


def sell_through_by_category(w) -> DataFrame:
    """DS8: sell-through and its index against the chain, by category, from the bridge."""
    return bridge(w).select("category", "sell_through_pct", "sell_through_index")


def category_ranking(w) -> DataFrame:
    """DS10: categories of the bridge ranked by net sales, with margin, turns and GMROI."""
    best_first = Window.partitionBy().orderBy(F.desc("net_sales"), *CAT)  # a row per category
    return bridge(w).select(F.row_number().over(best_first).cast("long").alias("rank"), *CAT, "net_sales", "gross_margin_pct", "inventory_turns", "gmroi",
                            "weeks_of_supply")


def oos_by_region(w) -> DataFrame:
    """DS8: out-of-stock rate by region = unweighted mean over DS2 rows."""
    return inventory_position(w).groupBy("region").agg(
        F.round(F.sum("out_of_stock_rate") / F.count("out_of_stock_rate"), 9).alias("out_of_stock_rate"),
        F.sum("on_hand_cost_value").alias("on_hand_cost_value"))


def hierarchy_matrix(w) -> DataFrame:
    """DS9: division -> department -> category matrix with ratio-of-sums cells (one ROLLUP)."""
    base = compile_query(MV_SALES, w.frames, CAT, ["net_sales", "gross_margin", "units"])
    return base.rollup(*CAT).agg(
        F.sum("net_sales").alias("net_sales"),
        (_d_sum("gross_margin") / F.nullif(_d_sum("net_sales"), F.lit(0.0))).alias("gross_margin_pct"),
        F.sum("units").alias("units"),
        F.grouping_id().alias("level"))


LEVELS = {"category": ["category_name"], "product": ["category_name", "product_sk"]}


def forecast_series(w, level: str = "category", ident=None, lo=None, hi=None, version: str = "both") -> DataFrame:
    """DS12 (PR13, PR14, PR18): forecast per week and version with the week's last day, by category or product.

    ``ident`` keeps one category or product; ``lo`` and ``hi`` bound the year-week code (fy*100+fw, inclusive,
    numbers or scalar columns, either may be open); ``version`` is baseline, improved or both.
    """
    key = LEVELS[level]
    f = w.fact_sales_forecast
    if version != "both":
        f = f.filter(F.col("forecast_version") == version)
    week = F.col("fiscal_year") * 100 + F.col("fiscal_week")
    if lo is not None:
        f = f.filter(week >= lo)
    if hi is not None:
        f = f.filter(week <= hi)
    f = f.join(w.dim_product.select("product_sk", "category_name"), "product_sk").join(cal.days(w.dim_date, "date"), "date_sk")
    if ident is not None:
        f = f.filter(F.col(key[-1]) == ident)
    return f.groupBy(*key, "fiscal_year", "fiscal_week", F.col("forecast_version").alias("version")).agg(
        F.max("date").alias("week_end_date"), *[F.sum(c).alias(c) for c in ("forecast_qty", "forecast_amount", "lower_bound", "upper_bound")])


def latest_weeks_series(w, level: str, weeks: int, version: str) -> DataFrame:
    """DS12 with a range: the series of the last ``weeks`` weeks of the horizon."""
    from .ai import recent_weeks
    code = recent_weeks(w.sale_days, w.sales_calendar, weeks).agg(F.min(F.col("fiscal_year") * 100 + F.col("fiscal_week"))).scalar()
    return forecast_series(w, level=level, lo=code, version=version)


def preset_weeks_series(w, level: str, weeks: int, version: str) -> DataFrame:
    """DS12 (PR18) with a preset window: the horizon's first ``weeks`` weeks, or all if it has fewer."""
    from .ai import recent_weeks
    horizon = recent_weeks(w.sale_days, w.sales_calendar, w.settings.horizon_weeks)
    first = horizon.orderBy("fiscal_year", "fiscal_week").limit(weeks)
    return forecast_series(w, level=level, hi=first.agg(F.max(F.col("fiscal_year") * 100 + F.col("fiscal_week"))).scalar(), version=version)


def forecast_summary(w, version: str = "both") -> DataFrame:
    """DS13/AG23: totals for the preferred version (improved unless baseline asked), per category."""
    s = forecast_series(w, version=version)
    pref = "baseline" if version == "baseline" else "improved"
    return s.filter(F.col("version") == pref).groupBy("category_name").agg(
        F.sum("forecast_qty").alias("total_qty"), F.sum("forecast_amount").alias("total_amount"),
        (_d_sum("forecast_qty") / F.countDistinct("fiscal_year", "fiscal_week")).alias("avg_weekly_qty"))


def forecast_pivot(w) -> DataFrame:
    """RS7: versions pivoted to columns per category x week, band from the improved version."""
    s = forecast_series(w)
    return s.groupBy("category_name", "fiscal_year", "fiscal_week").pivot("version", ["baseline", "improved"]).agg(
        F.first("forecast_qty").alias("qty"), F.first("lower_bound").alias("lower"),
        F.first("upper_bound").alias("upper")).select(
        "category_name", "fiscal_year", "fiscal_week", F.col("baseline_qty").alias("baseline"),
        F.col("improved_qty").alias("improved"), F.col("improved_lower").alias("band_lower"),
        F.col("improved_upper").alias("band_upper"))


def product_picker(w) -> DataFrame:
    """DS14/SC16/AG18: distinct forecast products with display labels."""
    p = w.dim_product.select("product_sk", "category_name", "product_name")
    return (w.fact_sales_forecast.select("product_sk").distinct().join(p, "product_sk")
            .filter(F.col("product_name").isNotNull())
            .withColumn("label", F.concat(F.col("product_name"), F.lit(" ("), F.col("category_name"), F.lit(")"))))


def category_picker(w) -> DataFrame:
    """DS14: the categories that have a forecast, with how many products each."""
    p = w.dim_product.select("product_sk", "category_name")
    return (w.fact_sales_forecast.select("product_sk").distinct().join(p, "product_sk").where("category_name is not null")
            .groupBy("category_name").agg(F.count(F.lit(1)).alias("products")))


def product_labels(w, wanted: DataFrame) -> DataFrame:
    """DS15: display labels of the products in ``wanted(product_sk)``; unknown products keep their key as label."""
    p = w.dim_product.select("product_sk", F.concat(F.col("product_name"), F.lit(" ("), F.col("category_name"), F.lit(")")).alias("_label"))
    return (wanted.select("product_sk").distinct().join(p, "product_sk", "left")
            .select("product_sk", F.coalesce("_label", F.col("product_sk").cast("string")).alias("label")))


def week_bounds(w) -> DataFrame:
    """DS14/AG24/SC15: min/max year-week code of the horizon and its split back into year and week; the horizon
    is the forecast's by definition, so its cells are not read."""
    from .ai import recent_weeks
    yw = F.col("fiscal_year") * 100 + F.col("fiscal_week")
    b = recent_weeks(w.sale_days, w.sales_calendar, w.settings.horizon_weeks).agg(F.min(yw).alias("lo"), F.max(yw).alias("hi"))
    return b.select("lo", "hi", F.expr("lo div 100").alias("fy_min"), F.expr("lo % 100").alias("fw_min"),
                    F.expr("hi div 100").alias("fy_max"), F.expr("hi % 100").alias("fw_max"))


def overrides_page(w, limit: int, after: tuple | None = None) -> DataFrame:
    """DS15/JN19/TK5/RS8: the ``limit`` newest overrides with product labels and delta %, or the next page
    after the last row ``(created_at, override_id)`` of the page before."""
    o = w.forecast_override
    if after is not None:
        at, key = F.lit(after[0]).cast("timestamp_ntz"), F.lit(after[1])
        o = o.where((F.col("created_at") < at) | ((F.col("created_at") == at) & (F.col("override_id") > key)))
    page = o.orderBy(F.col("created_at").desc(), F.col("override_id")).limit(limit)
    p = w.dim_product.select("product_sk", "product_name", "category_name")
    delta = F.when(F.col("ai_forecast_qty") != 0, (_d("override_qty") - _d("ai_forecast_qty")) / _d("ai_forecast_qty") * F.lit(100.0))
    return (page.join(p, "product_sk", "left")
            .select("override_id", "product_sk", "product_name", "category_name", "store_sk", "fiscal_year", "fiscal_week", "ai_forecast_qty",
                    "override_qty", "override_reason", "planner_id", "created_at", delta.alias("delta_pct"))
            .orderBy(F.col("created_at").desc(), F.col("override_id")))
