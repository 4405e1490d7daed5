"""Query catalogue: each entry = one Spark plan + one independent oracle SQL."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.semantic import compile_query
from ..oracle.star_sql import with_star
from ..registry import register
from .views import MV_INVENTORY, MV_SALES


@register("sales_by_year_category", with_star() + """
SELECT d.fiscal_year, p.category_name AS category,
       CAST(SUM(s.net_sales_amount) AS DOUBLE) AS net_sales,
       CAST(SUM(s.gross_margin_amount) AS DOUBLE) / NULLIF(CAST(SUM(s.net_sales_amount) AS DOUBLE), 0) AS gross_margin_pct,
       COUNT(DISTINCT s.transaction_id) AS transaction_count
FROM fact_sales_line s LEFT JOIN dim_date d ON s.date_sk = d.date_sk
     LEFT JOIN dim_product p ON s.product_sk = p.product_sk
GROUP BY ALL""")
def sales_by_year_category(w):
    """Minimum slice: fiscal year x category -> net sales, GM %, transactions (SEM2)."""
    return compile_query(MV_SALES, w.frames, ["fiscal_year", "category"],
                         ["net_sales", "gross_margin_pct", "transaction_count"])


@register("dim_date_calendar", with_star() + "SELECT * FROM dim_date")
def dim_date_calendar(w):
    """CAL1-CAL7: the full fiscal date dimension over the data's date range."""
    return w.dim_date


# ----------------------------------------------------------------- tables
from ..functions.keyed import dec  # noqa: E402
from ..operators.fingerprints import wide_sum  # noqa: E402
from ..oracle import facts_sql  # noqa: E402
from ..sources import specs as S  # noqa: E402
from . import facts  # noqa: E402

_DEC = {"money", "qty2", "dec1", "dec4"}


def _sel(spec, alias: str | None = None) -> str:
    cols = []
    for c in spec.columns:
        ref = f"{alias}.{c.name}" if alias else c.name
        cols.append(f"CAST({ref} AS DOUBLE) AS {c.name}" if c.dtype in _DEC else ref)
    return ", ".join(cols)


def _full(cte: str, spec) -> str:
    return with_star(*facts_sql.ALL) + f"\nSELECT {_sel(spec)} FROM {cte}"


def _table_query(name: str, attr: str, spec, cte: str | None = None, doc: str = ""):
    def fn(w):
        return getattr(w, attr)
    fn.__doc__ = doc
    register(name, _full(cte or attr, spec))(fn)


_table_query("fact_sales_line", "fact_sales_line", S.FACT_SALES_LINE,
             doc="FC1/SRC4/JN2: sales lines numbered by source line, part and supplier, and the exact measure chain.")
_table_query("fact_inventory_movement", "fact_inventory_movement", S.FACT_INVENTORY_MOVEMENT,
             doc="FC3/FN6/FN14: one signed movement per sales line, weighted type pick.")
_table_query("fact_web_events", "fact_web_events", S.FACT_WEB_EVENTS,
             doc="FC7: sessions (user x day), skew-safe event numbering, JSON product key.")
_table_query("fact_returns", "fact_returns", S.FACT_RETURNS, "fact_returns_f",
             doc="FC4/PR9/FN3: keyed 8 % return sample, clamped return dates, exact refunds.")
_table_query("fact_fulfillment", "fact_fulfillment", S.FACT_FULFILLMENT, "fact_fulfillment_f",
             doc="FC5/PR8: online lines with promise/ship/delivery dates and SLA.")
_table_query("fact_loyalty_activity", "fact_loyalty_activity", S.FACT_LOYALTY_ACTIVITY,
             doc="FC6/AG2/RS1/WN1: Earn + spin-off ledger with a skew-safe running balance.")
_table_query("fact_gl_actuals", "fact_gl_actuals", S.FACT_GL_ACTUALS,
             doc="FC8/JN10/RS6/WN2/WN3: GL actuals with the conserved timing shift.")
_table_query("fact_inventory_valuation", "fact_inventory_valuation", S.FACT_INVENTORY_VALUATION,
             doc="FC10/JN13/JN14: period-end valuation with COGS, markdown, shrink, GMROI.")
_table_query("fact_sales_forecast", "fact_sales_forecast", S.FACT_SALES_FORECAST,
             doc="FC11/TK3/RS5/PR15: baseline and improved forecasts over the caller's horizon.")
_table_query("ai_anomaly_catalog", "ai_anomaly_catalog", S.AI_ANOMALY_CATALOG,
             doc="FC12/AG11/SRC2: anomaly catalog with calendar-derived windows.")
_table_query("product_review_staging", "product_review_staging", S.PRODUCT_REVIEW_STAGING,
             doc="FC13/TK1/SC7: a keyed share of sales lines, with prompts.")
_table_query("service_case_staging", "service_case_staging", S.SERVICE_CASE_STAGING,
             doc="FC14/TK1/SC7: a keyed share of sales lines, with prompts.")
_table_query("replenishment_order", "replenishment_order", S.REPLENISHMENT_ORDER,
             doc="FC16/PR10/PR11/SC11: a suggestion for every low-stock cell of the latest snapshot.")
_table_query("forecast_override", "forecast_override", S.FORECAST_OVERRIDE,
             doc="FC17/SC11: planner overrides of the improved forecast.")


@register("inventory_snapshot_by_period", with_star(*facts_sql.ALL) + """
SELECT date_sk, COUNT(*) AS cells, CAST(SUM(on_hand_qty) AS BIGINT) AS on_hand_qty,
       CAST(SUM(on_order_qty) AS BIGINT) AS on_order_qty, CAST(SUM(in_transit_qty) AS BIGINT) AS in_transit_qty,
       CAST(SUM(reserved_qty) AS BIGINT) AS reserved_qty, CAST(SUM(available_qty) AS BIGINT) AS available_qty,
       CAST(SUM(safety_stock_qty) AS BIGINT) AS safety_stock_qty, CAST(SUM(reorder_point) AS BIGINT) AS reorder_point,
       CAST(SUM(on_hand_retail_value) AS DOUBLE) AS on_hand_retail_value,
       CAST(SUM(on_hand_cost_value) AS DOUBLE) AS on_hand_cost_value,
       CAST(SUM(days_of_supply) AS DOUBLE) AS days_of_supply,
       COUNT(*) FILTER (WHERE is_out_of_stock) AS out_of_stock_cells
FROM fact_inventory_snapshot GROUP BY date_sk""")
def inventory_snapshot_by_period(w):
    """FC2/JN8/JN9/AG3/AG4: every snapshot column rolled up per period-end (2.4M cells at sf0.01)."""
    s = w.stock_cells
    exact = {**{c: (x, "0.01", 2) for c, x in facts.CENTS.items()}, **{c: (x, "0.1", 1) for c, x in facts.TENTHS.items()}}
    sums = ["on_hand_qty", "on_order_qty", "in_transit_qty", "reserved_qty", "available_qty", "safety_stock_qty",
            "reorder_point"]
    return s.groupBy("date_sk").agg(
        F.count(F.lit(1)).alias("cells"),
        *[F.sum(c).cast("long").alias(c) for c in sums],
        *[(wide_sum(F.col(x)).cast("decimal(28,0)") * dec(unit)).cast(f"decimal(28,{scale})").alias(c) for c, (x, unit, scale) in exact.items()],
        F.count(F.when(F.col("is_out_of_stock"), 1)).alias("out_of_stock_cells"),
    )


@register("budget_plan_by_period", with_star(*facts_sql.ALL) + """
SELECT fiscal_year, fiscal_period, gl_account_sk, plan_version, COUNT(*) AS lines,
       CAST(SUM(plan_amount) AS DOUBLE) AS plan_amount, CAST(SUM(plan_units) AS BIGINT) AS plan_units,
       COUNT(DISTINCT store_sk) AS stores
FROM fact_budget_plan GROUP BY ALL""")
def budget_plan_by_period(w):
    """FC9/JN5/RS5: budget lines rolled up per period x account x version; first by store, as the lines are dealt by store."""
    group = ["fiscal_year", "fiscal_period", "gl_account_sk", "plan_version"]
    by_store = w.fact_budget_plan.groupBy(*group, "store_sk").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("plan_amount").alias("plan_amount"), F.sum("plan_units").alias("plan_units"))
    return by_store.groupBy(*group).agg(
        F.sum("lines").alias("lines"), F.sum("plan_amount").alias("plan_amount"),
        F.sum("plan_units").cast("long").alias("plan_units"), F.count("store_sk").alias("stores"))


def _dimension(name: str, doc: str) -> None:
    spec = S.BY_NAME[name]

    def fn(w):
        return getattr(w, name)
    fn.__doc__ = doc
    register(f"{name}_attributes", with_star() + f"\nSELECT {_sel(spec)} FROM {name}")(fn)


_dimension("dim_product", "DM7/JN3/SC1/SC4/SC6/SC8/FN12/PR4: all columns of the product dimension.")
_dimension("dim_store", "DM2/FN2/SC1/SC8/PR4: all columns of the store dimension, from supplier x nation x region.")
_dimension("dim_customer", "DM6/FN6/SC2/SC14/PR4: all columns of the customer dimension, with keyed loyalty.")
_dimension("dim_promotion", "DM4/SC3/SC8/PR4: one promotion per distinct discount rate, with its campaign and days.")
_dimension("dim_vendor", "DM3/PR4: one vendor per brand.")
_dimension("dim_employee", "DM5/PR4: the associates of every store and their managers.")


# --------------------------------------------------------------- datasets
from ..oracle import datasets_sql as D  # noqa: E402
from . import datasets as ds  # noqa: E402

for _name, _fn, _sql in (
    ("sales_performance", ds.sales_performance, D.SALES_PERFORMANCE),
    ("inventory_position", ds.inventory_position, D.INVENTORY_POSITION),
    ("sales_inventory_bridge", ds.bridge, D.BRIDGE),
    ("lost_sales_risk", ds.lost_sales, D.LOST_SALES),
    ("takeaway_prompt", ds.takeaway_prompt, D.TAKEAWAY),
    ("kpi_counters", ds.kpis, D.KPIS),
    ("net_sales_trend", ds.sales_trend, D.SALES_TREND),
    ("net_sales_by_department", ds.net_sales_by_department, D.NET_SALES_BY_DEPARTMENT),
    ("oos_by_region", ds.oos_by_region, D.OOS_BY_REGION),
    ("category_hierarchy", ds.hierarchy_matrix, D.HIERARCHY),
    ("forecast_series", ds.forecast_series, D.FORECAST_SERIES),
    ("forecast_summary", ds.forecast_summary, D.FORECAST_SUMMARY),
    ("forecast_pivot", ds.forecast_pivot, D.FORECAST_PIVOT),
    ("forecast_product_picker", ds.product_picker, D.PRODUCT_PICKER),
    ("forecast_week_bounds", ds.week_bounds, D.WEEK_BOUNDS),
    ("overrides_page", lambda w: ds.overrides_page(w, limit=100), D.OVERRIDES_PAGE),
    ("kpi_counters_filtered", lambda w: ds.kpis(w, "division = 'Everyday' AND region <> 'ASIA'", "channel_type = 'Digital'"), D.KPIS_FILTERED),
    ("inventory_value_by_category", ds.inventory_value_by_category, D.INVENTORY_VALUE),
    ("sell_through_by_category", ds.sell_through_by_category, D.SELL_THROUGH),
    ("category_ranking", ds.category_ranking, D.CATEGORY_RANKING),
    ("forecast_series_by_product", lambda w: ds.forecast_series(w, level="product"), D.SERIES_PRODUCT),
    ("forecast_series_recent", lambda w: ds.latest_weeks_series(w, "category", 8, "improved"), D.SERIES_RECENT),
    ("forecast_series_preset", lambda w: ds.preset_weeks_series(w, "category", 13, "baseline"), D.SERIES_PRESET),
    ("forecast_category_picker", ds.category_picker, D.CATEGORY_PICKER),
    ("override_product_labels", lambda w: ds.product_labels(w, w.forecast_override), D.OVERRIDE_LABELS),
):
    register(_name, _sql)(_fn)


# ----------------------------------------------------------------- checks
from ..operators.checks import integrity_report as _integrity  # noqa: E402
from ..oracle.checks_sql import INTEGRITY_REPORT  # noqa: E402


@register("integrity_report", INTEGRITY_REPORT)
def integrity_report(w):
    """CHK1-CHK18/SEM6-SEM8/FC18-FC20: keys, orphans, measure identities, tie-outs over a whole built warehouse."""
    return _integrity(built(w).frames)


# ------------------------------------------------------------ stored tables
from ..oracle import misc_sql as M  # noqa: E402
from ..session import new_folder, written  # noqa: E402
from ..sources.versions import Store  # noqa: E402
from . import build as B  # noqa: E402
from .aggregates import refresh, states  # noqa: E402
from .warehouse import Frames  # noqa: E402


def built(w, tables: tuple[str, ...] = B.DIMENSIONS + B.FACTS):
    """The warehouse written to the cluster's shared folder and read back."""
    return B.build(w.spark, w.sf_dir, new_folder(w.spark, "build"), w.settings, tables, family=w.family)


@register("net_sales_by_department_stored", D.NET_SALES_BY_DEPARTMENT)
def net_sales_by_department_stored(w):
    """SEM4: the same answer from the stored daily aggregate alone."""
    wh = built(w, ("dim_product", "dim_store", "dim_date"))
    return ds.net_sales_by_department(w, {"mv_sales_daily": B.stored_aggregate(wh, MV_SALES, "mv_sales_daily", new_folder(w.spark, "aggregate"))})


@register("inventory_by_region_stored", D.INVENTORY_BY_REGION)
def inventory_by_region_stored(w):
    """SEM4: stock by period-end and region, from the stored daily aggregate by date, region and department."""
    wh = built(w, ("dim_product", "dim_store", "dim_date"))
    mats = {"mv_inventory_daily": B.stored_aggregate(wh, MV_INVENTORY, "mv_inventory_daily", new_folder(w.spark, "aggregate"))}
    return compile_query(MV_INVENTORY, wh.frames, ["date", "region"], ["on_hand_qty", "on_hand_cost_value"], materialized=mats)


_CORE = ("fact_sales_line", "fact_inventory_movement", "fact_web_events", "fact_returns", "fact_fulfillment", "fact_loyalty_activity")


@register("build_resumed", with_star(*facts_sql.ALL) + M.BUILD_RESUMED)
def build_resumed(w):
    """FC18-FC20/SRC5: a build that ended early goes on: rows of every table, and whether the second run found it valid."""
    path = new_folder(w.spark, "build")
    B.run_build(w.spark, w.sf_dir, path, w.settings, B.DIMENSIONS, family=w.family)
    _, report = B.run_build(w.spark, w.sf_dir, path, w.settings, B.DIMENSIONS + _CORE, family=w.family)
    return w.spark.createDataFrame([(b.name, b.rows, b.reused) for b in report if b.name not in B.STAGED], "table_name string, row_count long, reused boolean")


@register("orders_versioned", M.ORDERS_VERSIONED)
def orders_versioned(w):
    """SNK1: orders in two deliveries, the second with a new column, which is then renamed: older rows read null there."""
    store, orders = Store(w.spark, new_folder(w.spark, "table")), w.t("orders")
    cut = F.lit(w.bounds["last_order"].replace(month=1, day=1)).cast("date")
    day = F.to_date("o_orderdate").alias("order_day")
    store.overwrite("orders", orders.where(F.to_date("o_orderdate") < cut).select("o_orderkey", day))
    store.append("orders", orders.where(F.to_date("o_orderdate") >= cut).select("o_orderkey", day, F.col("o_orderpriority").alias("priority")))
    store.alter("orders", rename={"priority": "urgency"})
    return store.read("orders")


# ------------------------------------------------------------ metric views
from ..oracle import views_sql  # noqa: E402
from . import views as V  # noqa: E402

GRAINS = {
    "mv_sales": (V.MV_SALES, ["fiscal_year", "category"], []),
    "mv_inventory": (V.MV_INVENTORY, ["fiscal_year", "region"], []),
    "mv_inventory_valuation": (V.MV_INVENTORY_VALUATION, ["fiscal_year", "category_name"], []),
    "mv_forecast": (V.MV_FORECAST, ["forecast_version", "fiscal_week"], ["forecast_version"]),
    "mv_gl_actuals": (V.MV_GL_ACTUALS, ["statement", "account"], []),
    "mv_budget_plan": (V.MV_BUDGET_PLAN, ["plan_version", "account"], ["plan_version"]),
}


def _metric_view(name: str) -> None:
    view, fine, coarse = GRAINS[name]

    def fn(w):
        measures = [m.name for m in view.measures]
        a = compile_query(view, w.frames, fine, measures).withColumn("grain", F.lit("fine"))
        b = compile_query(view, w.frames, coarse, measures).withColumn("grain", F.lit("coarse"))
        return a.unionByName(b, allowMissingColumns=True)
    fn.__doc__ = f"SEM1/SEM2/AG12-AG17: every measure of {name} at two grains, each computed from the fact."
    register(name, views_sql.QUERIES[name])(fn)


for _name in GRAINS:
    _metric_view(_name)

# The tables besides the dimensions that a view's stored aggregate starts from.
_STORED = {
    "mv_sales": (), "mv_inventory": ("fact_inventory_snapshot",), "mv_inventory_valuation": ("fact_inventory_snapshot", "fact_inventory_valuation"),
    "mv_forecast": ("fact_sales_forecast",), "mv_gl_actuals": ("fact_gl_actuals",), "mv_budget_plan": ("fact_gl_actuals", "fact_budget_plan"),
}


def _two_grains(view, frames, fine, coarse, mats):
    measures = [m.name for m in view.measures]
    a = compile_query(view, frames, fine, measures, materialized=mats).withColumn("grain", F.lit("fine"))
    b = compile_query(view, frames, coarse, measures, materialized=mats).withColumn("grain", F.lit("coarse"))
    return a.unionByName(b, allowMissingColumns=True)


def _stored_view(name: str) -> None:
    view, fine, coarse = GRAINS[name]
    fine = ["fiscal_year", "department"] if name == "mv_sales" else fine

    def fn(w):
        wh = built(w, B.DIMENSIONS + _STORED[name])
        mv = view.materialized[0]
        return _two_grains(view, wh.frames, fine, coarse, {mv.name: B.stored_aggregate(wh, view, mv.name, new_folder(w.spark, "aggregate"))})
    fn.__doc__ = f"SEM4/AG12-AG16: every measure of {name} at two coarser grains, from the stored daily states alone."
    register(f"{name}_stored", views_sql.STORED[name])(fn)


for _name in _STORED:
    _stored_view(_name)


@register("mv_sales_refreshed", views_sql.STORED["mv_sales"])
def mv_sales_refreshed(w):
    """SEM4: the stored aggregate made before the last days of sales arrived, and refreshed when they had."""
    wh = built(w, B.DIMENSIONS)
    store, mv, last = Store(w.spark, new_folder(w.spark, "aggregate")), MV_SALES.materialized[0], int(w.bounds["last_order"].strftime("%Y%m%d")) - 1
    early = Frames(wh, {"fact_sales_line": wh.sales_metrics.where(F.col("date_sk") < last)})
    for frames in (early, wh.frames):
        refresh(store, MV_SALES, mv, frames, written)
    return _two_grains(MV_SALES, wh.frames, ["fiscal_year", "department"], [], {mv.name: states(store, MV_SALES, mv)})


# -------------------------------------------------- functions and statistics
from ..functions import calendar as C  # noqa: E402
from ..functions import keyed as K  # noqa: E402


@register("sale_date_spread", with_star() + M.SALE_DATE_SPREAD)
def sale_date_spread(w):
    """AG21/CHK11: mean over stores of the distinct sale dates, and of the lines."""
    per_store = w.sales_metrics.groupBy("store_sk").agg(F.countDistinct("date_sk").alias("days"), F.count(F.lit(1)).alias("lines"))
    return per_store.agg(F.count(F.lit(1)).alias("stores"), F.avg("days").alias("avg_days"), F.avg("lines").alias("avg_lines"))


@register("table_fingerprints", with_star(*facts_sql.ALL) + M.FINGERPRINTS)
def table_fingerprints(w):
    """AG22/CHK12: row count and exact totals of four facts; two builds of the same input agree."""
    parts = [("fact_sales_line", w.sales_metrics, "net_sales_amount"), ("fact_returns", w.fact_returns, "refund_amount"),
             ("fact_gl_actuals", w.fact_gl_actuals, "actual_amount"), ("fact_loyalty_activity", w.fact_loyalty_activity, "points_balance")]
    out = None
    for name, df, amount in parts:
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(amount).cast("decimal(38,2)")).alias("total")).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@register("days_of_supply_median", with_star(*facts_sql.ALL) + M.MEDIAN)
def days_of_supply_median(w):
    """AG19: median days of supply per period-end, exact: from the counts of its values, so no group is sorted whole."""
    from pyspark.sql import Window
    tenths = facts.TENTHS["days_of_supply"]  # counted as whole numbers
    counts = w.stock_cells.where(F.col(tenths).isNotNull()).groupBy("date_sk", tenths).count()
    upto = Window.partitionBy("date_sk").orderBy(tenths)
    marked = counts.select("date_sk", tenths, F.sum("count").over(upto).alias("upto"), F.sum("count").over(Window.partitionBy("date_sk")).alias("n"))
    median = (F.min(tenths).cast("decimal(18,0)") * dec("0.1", 2, 1)).cast("decimal(18,1)")
    return marked.where(F.col("upto") * 2 >= F.col("n")).groupBy("date_sk").agg(median.alias("median_days"))


@register("calendar_weights", with_star() + M.CALENDAR_WEIGHTS)
def calendar_weights(w):
    """CAL11/CAL12: sampling weight of every calendar day, and where a two-year history before it starts."""
    days = w.sales_calendar.select("date_sk", C.history_start(F.col("date"), 2).alias("history_start"))
    return C.seasonality_weight(w.sales_calendar).join(days, "date_sk")


@register("keyed_draws", M.KEYED_DRAWS)
def keyed_draws(w):
    """FN1-FN4, FN8-FN13, FN16: the keyed draws of every order, independent per column."""
    key = F.col("o_orderkey")
    u = K.uniform(key, salt="u")
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    return w.t("orders").select(
        "o_orderkey", u.alias("u"), K.bounded_int(key, salt="low_high", lo=-5, hi=17).alias("between"),
        K.affine(K.uniform(key, salt="range"), "2.5", "7.5").alias("in_range"), K.long_tail_rank(u, 1000).alias("tail_rank"),
        K.rank_pick(u, 1000).alias("rank"), K.nullable(K.uniform(key, salt="gap"), "0.25", F.col("o_orderpriority")).alias("gappy"),
        K.safe_ratio(cents, F.pmod(key, F.lit(3)).cast("decimal(18,2)")).alias("ratio"))


@register("taxonomy_paths", with_star() + M.TAXONOMY_PATHS)
def taxonomy_paths(w):
    """RS9: the nested taxonomy flattened to paths with positional ids, times the brands that occur in each."""
    brands = w.t("part").select("p_type", "p_brand").distinct()
    return w.taxonomy.join(brands, "p_type").select("division_name", "department_name", F.col("p_type").alias("category"), "path_id",
                                                    F.col("p_brand").alias("brand"))


# ----------------------------------------------------- samples and assortment
from ..operators.sampling import bottom_k  # noqa: E402
from ..sources.star import LINE_KEY  # noqa: E402
from . import assortment as A  # noqa: E402


@register("product_review_sample", with_star() + M.REVIEW_SAMPLE)
def product_review_sample(w):
    """TK1: exactly 500 sales lines to be reviewed, the same ones under any partitioning."""
    return bottom_k(w.sales_base.select(*LINE_KEY, "customer_sk"), 500, LINE_KEY, "review_sample")


@register("replenishment_sample", with_star(*facts_sql.ALL) + M.REPLENISHMENT_SAMPLE)
def replenishment_sample(w):
    """TK2: exactly 200 replenishment orders."""
    return bottom_k(w.replenishment_order.select("store_sk", "product_sk"), 200, ["store_sk", "product_sk"], "replenishment_sample")


@register("store_assortment", with_star() + M.ASSORTMENT + "SELECT * FROM assortment")
def store_assortment(w):
    """JN6/JN8: the products that each store carries, by keyed skip sampling, with what it sold of them (0 if nothing)."""
    return A.store_assortment(w.sales_base, w.dim_product, w.dim_store, family=w.family)


@register("assortment_by_period", with_star() + M.ASSORTMENT + M.ASSORTMENT_BY_PERIOD)
def assortment_by_period(w):
    """JN7/JN8: the planned assortment at every period-end, by popularity class."""
    return A.assortment_by_period(A.store_assortment(w.sales_base, w.dim_product, w.dim_store, family=w.family), w.sales_calendar)


# ------------------------------------------------------------- fingerprints
from functools import reduce  # noqa: E402

from ..operators.fingerprints import fingerprint  # noqa: E402


def _fingerprint_sql() -> str:
    named = {"fact_returns": "fact_returns_f", "fact_fulfillment": "fact_fulfillment_f"}
    return with_star(*facts_sql.ALL) + M.fingerprints({named.get(t, t): S.BY_NAME[t] for t in B.DIMENSIONS + B.FACTS})


@register("warehouse_fingerprints", _fingerprint_sql())
def warehouse_fingerprints(w):
    """AG22/CHK12: order-free fingerprints over all columns of all 26 tables of a build, by year."""
    wh = built(w)
    return reduce(lambda a, b: a.unionByName(b), [fingerprint(getattr(wh, t), S.BY_NAME[t]) for t in B.DIMENSIONS + B.FACTS])


from ..operators import independence as I  # noqa: E402


@register("attribute_independence", with_star(*facts_sql.ALL) + M.INDEPENDENCE)
def attribute_independence(w):
    """CHK11: mutual information of every two drawn attributes of a row, against what chance allows."""
    wh = built(w, B.DIMENSIONS + ("fact_returns", "fact_inventory_movement"))
    return reduce(lambda a, b: a.unionByName(b), [I.independence(getattr(wh, p.table), p) for p in I.DRAWN])


# ------------------------------------------------- stored quantiles and upserts
from ..operators import quantiles as Q  # noqa: E402
from ..operators.upsert import upsert  # noqa: E402


@register("days_of_supply_sketched", with_star(*facts_sql.ALL) + M.SKETCHED)
def days_of_supply_sketched(w):
    """AG19: median days of supply by period-end and by year from stored daily sketches, held against the exact median."""
    cells = built(w, ("dim_product", "fact_inventory_snapshot")).fact_inventory_snapshot.select("date_sk", "days_of_supply", F.expr("date_sk div 10000").alias("year"))
    k, out = 400, None
    states_ = written(Q.sketches(cells, ["year", "date_sk"], "days_of_supply", k))
    for grain in ("date_sk", "year"):
        found = Q.rank_range(cells, [grain], "days_of_supply", Q.quantile(states_, [grain], 0.5, "estimate"), "estimate")
        exact = Q.exact_quantile(cells, [grain], "days_of_supply", F.lit(0.5), "exact_median")
        off = 2 * Q.rank_error(k)
        one = found.join(exact, grain).select(F.lit(grain).alias("grain"), F.col(grain).alias("part"), F.col("n").alias("cells"), "exact_median",
                                              ((F.col("below") <= 0.5 + off) & (F.col("upto") >= 0.5 - off)).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@register("override_submissions", M.SUBMISSIONS)
def override_submissions(w):
    """DS16/PR17/RS3: planners' submissions (derived from orders) in two batches; the second starts from what each planner saw."""
    orders = w.t("orders")
    sent = orders.select(
        F.col("o_custkey").cast("long").alias("cell"), F.substring("o_orderpriority", 1, 1).alias("planner"),
        F.concat(F.lit("s"), F.col("o_orderkey")).alias("submission_id"), F.to_date("o_orderdate").alias("submitted_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("qty"), (F.col("o_orderkey") % 2).cast("long").alias("revision"))
    half = F.lit(w.bounds["last_order"].replace(month=1, day=1)).cast("date")
    keys, values = ["cell", "planner"], ["qty"]
    none = sent.limit(0).select(*keys, *values, "revision", "submission_id", "submitted_at")
    first = sent.where(F.col("submitted_at") < half)
    state, one = upsert(none, first.unionByName(first.where(F.col("qty") < 50000)), keys, values, F.col("qty") >= 1000)  # some are sent twice
    state = written(state)
    last, two = upsert(state, sent.where(F.col("submitted_at") >= half), keys, values, F.col("qty") >= 1000)
    outcomes = one.select("outcome").unionByName(two.select("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    cells = last.select("cell", "planner", "qty", "revision", "submission_id")
    return cells.unionByName(outcomes.select(F.lit(None).cast("long").alias("cell"), F.lit(None).cast("string").alias("planner"), F.lit(None).cast("decimal(18,2)").alias("qty"),
                                             F.col("n").alias("revision"), F.col("outcome").alias("submission_id")))


# ---------------------------------------------------- filled texts and serving
from ..sources import prompts as P  # noqa: E402
from ..sources import serving  # noqa: E402

REVIEW_TEXTS = {"review_text": "prompt", "review_title": "title_prompt"}


def plain_answers(prompts: list[str]) -> list[str]:
    """A stand-in for a model that any SQL engine can repeat: the prompt in capitals."""
    return [p.upper() for p in prompts]


@register("product_review_filled", with_star(*facts_sql.ALL) + M.REVIEW_FILLED)
def product_review_filled(w):
    """FC15/SNK7/CHK18: review texts through the store of answers, filled twice; with what each run sent and what the check found."""
    staged, store, texts = w.product_review_staging, new_folder(w.spark, "answers"), list(REVIEW_TEXTS.values())
    staged = written(staged)
    sent = [P.ask(staged, texts, plain_answers, store, model="plain-1") for _ in range(2)]
    full = written(P.fill_stored(staged, REVIEW_TEXTS, plain_answers, store, model="plain-1"))
    bad = P.text_violations(staged, full, ["review_id"], REVIEW_TEXTS).agg(F.sum("bad").alias("violations"))
    found = bad.first()["violations"]
    return full.select("review_id", "review_title", "review_text").withColumns(
        {"violations": F.lit(found).cast("long"), "sent_first": F.lit(sent[0]).cast("long"), "sent_again": F.lit(sent[1]).cast("long")})


@register("forecast_point_reads", with_star(*facts_sql.ALL) + f"""
SELECT {_sel(S.FACT_SALES_FORECAST)} FROM fact_sales_forecast WHERE product_sk = (SELECT MAX(product_sk) FROM fact_sales_forecast)""")
def forecast_point_reads(w):
    """SNK6: the forecast published as a snapshot clustered by product and store, and the rows of its last product read back."""
    path = new_folder(w.spark, "serving")
    serving.publish(w.fact_sales_forecast, path, ["product_sk", "store_sk"])
    last = serving.snapshot_index(w.spark, path).agg(F.max("last")).first()[0]
    return serving.point_read(w.spark, path, ["product_sk", "store_sk"], [None if last is None else last["k0"]])
