"""The six metric views over the star schema (SEM1).

View, dimension and measure names and what a measure computes are fixed values that must equal the
reference's for right results; the notes are this library's.

Measure expressions keep money exact (decimal sums) and compute every ratio
and average in double from exact sums, so any engine returns the same bits.
"""
from __future__ import annotations

from dataclasses import replace

from ..operators.measures import Measure, difference, distinct, mean, ratio, rows, share, total
from ..operators.semantic import MaterializedView, MetricField, MetricJoin, MetricView

# What a user reads about a dimension or measure, by its name.
NOTES = {
    "date": "Day of the calendar",
    "fiscal_year": "4-5-4 year",
    "fiscal_period": "4-5-4 month, 1 to 12",
    "fiscal_quarter": "Three fiscal periods",
    "selling_season": "Season of the shop, by month",
    "is_weekend": "Saturday or Sunday",
    "is_holiday": "Public holiday of the calendar",
    "division": "Top of the taxonomy",
    "department": "Second level (of products) or cost centre (of the ledger)",
    "category": "Third level of the taxonomy",
    "subcategory": "Category and noun of the name",
    "brand": "Brand of the part",
    "product": "Name of the part",
    "region": "Region of the supplier's nation",
    "district": "Nation of the supplier",
    "store_format": "By floor space",
    "store": "Name of the supplier",
    "state": "Nation, as there are no states",
    "channel": "How the order came in",
    "channel_type": "In person or online",
    "customer_segment": "Market segment",
    "loyalty_tier": "Tier of members, None for others",
    "customer_type": "Household or business",
    "promo_type": "Kind of promotion",
    "funding_source": "Who pays for the promotion",
    "gross_sales": "Before promotions",
    "net_sales": "After promotions, before tax",
    "discount": "Taken off by promotions",
    "discount_rate": "Taken off, as a share of gross",
    "cogs": "What the sold goods cost",
    "gross_margin": "Net sales less their cost",
    "gross_margin_pct": "Margin as a share of net sales",
    "units": "Pieces sold",
    "line_count": "Receipt lines",
    "transaction_count": "Receipts",
    "avg_order_value": "Net sales a receipt",
    "avg_basket_units": "Pieces a receipt",
    "avg_unit_price": "Gross a piece",
    "on_hand_qty": "Pieces in stock",
    "available_qty": "In stock and not reserved",
    "on_order_qty": "Ordered from vendors",
    "reserved_qty": "Promised to customers",
    "on_hand_cost_value": "Stock at standard cost",
    "on_hand_retail_value": "Stock at list price",
    "avg_days_of_supply": "Mean over cells, not weighted",
    "out_of_stock_rate": "Share of cells with no stock",
    "sku_count": "Different products",
    "stocked_store_count": "Different stores",
    "category_id": "Key of the category",
    "category_name": "Third level of the taxonomy",
    "markdown": "Share of gross written down",
    "shrink": "Share of stock lost",
    "avg_gmroi": "Mean margin per cost of stock, not weighted",
    "forecast_version": "baseline or improved",
    "model_name": "Model behind the version",
    "fiscal_week": "4-5-4 week, 1 to 53",
    "forecast_qty": "Pieces expected",
    "forecast_amount": "Pieces expected, at the week's price",
    "lower_bound": "Lower end of the band",
    "upper_bound": "Upper end of the band",
    "interval_width": "Width of the band",
    "account_type": "Kind of account",
    "statement": "Statement the account is in",
    "account": "Name of the account",
    "account_category": "Group of accounts",
    "department_group": "Whether the cost centre carries goods",
    "actual_amount": "Posted",
    "plan_version": "Which plan",
    "scenario": "Case the plan is for",
    "plan_amount": "Planned",
    "plan_units": "Planned pieces",
}


# Other words users search by.
SYNONYMS = {"net_sales": ("turnover",), "gross_margin_pct": ("margin rate",), "transaction_count": ("receipts",), "avg_order_value": ("basket value",),
            "avg_days_of_supply": ("stock reach",), "out_of_stock_rate": ("gaps",), "avg_gmroi": ("return on stock",)}


def F_(name: str, what: str | Measure, format: str | None = None) -> MetricField:
    expr, measure = (what.sql, what) if isinstance(what, Measure) else (what, None)
    return MetricField(name, expr, NOTES[name], name.replace("_", " ").capitalize(), SYNONYMS.get(name, ()), format, measure)


J_DATE = MetricJoin("dim_date", "dim_date", "date_sk", "date_sk")
J_PRODUCT = MetricJoin("dim_product", "dim_product", "product_sk", "product_sk")
J_STORE = MetricJoin("dim_store", "dim_store", "store_sk", "store_sk")
J_CUSTOMER = MetricJoin("dim_customer", "dim_customer", "customer_sk", "customer_sk")
J_CHANNEL = MetricJoin("dim_channel", "dim_channel", "channel_sk", "channel_sk")
J_PROMO = MetricJoin("dim_promotion", "dim_promotion", "promotion_sk", "promotion_sk")
J_GL = MetricJoin("dim_gl_account", "dim_gl_account", "gl_account_sk", "gl_account_sk")
J_DEPT = MetricJoin("dim_department", "dim_department", "department_sk", "department_sk")


def daily(view: MetricView, name: str, *dims: str) -> MetricView:
    """The view with a stored aggregate of all its measures by day and ``dims``."""
    return replace(view, materialized=(MaterializedView(name, ("date", *dims), tuple(m.name for m in view.measures), "date_sk"),))


DATE_DIMS = (
    F_("date", "dim_date.date"),
    F_("fiscal_year", "dim_date.fiscal_year"),
    F_("fiscal_period", "dim_date.fiscal_period"),
    F_("fiscal_quarter", "dim_date.fiscal_quarter"),
    F_("selling_season", "dim_date.selling_season"),
)
DATE_PARTS = tuple(d.name for d in DATE_DIMS if d.name != "date")
PRODUCT_DIMS = (
    F_("division", "dim_product.division_name"),
    F_("department", "dim_product.department_name"),
    F_("category", "dim_product.category_name"),
    F_("subcategory", "dim_product.subcategory_name"),
    F_("brand", "dim_product.brand_name"),
    F_("product", "dim_product.product_name"),
)
STORE_DIMS = (
    F_("region", "dim_store.region_name"),
    F_("district", "dim_store.district_name"),
    F_("store_format", "dim_store.store_format"),
    F_("store", "dim_store.store_name"),
    F_("state", "dim_store.state"),
)

MV_SALES = daily(MetricView(
    name="mv_sales", source="fact_sales_line",
    comment="One row of the source is a receipt line.",
    joins=(J_DATE, J_PRODUCT, J_STORE, J_CUSTOMER, J_CHANNEL, J_PROMO),
    dimensions=(
        *DATE_DIMS,
        F_("is_weekend", "dim_date.is_weekend"),
        F_("is_holiday", "dim_date.is_holiday"),
        *PRODUCT_DIMS, *STORE_DIMS,
        F_("channel", "dim_channel.channel_name"),
        F_("channel_type", "dim_channel.channel_type"),
        F_("customer_segment", "dim_customer.segment"),
        F_("loyalty_tier", "dim_customer.loyalty_tier"),
        F_("customer_type", "dim_customer.customer_type"),
        F_("promo_type", "dim_promotion.promo_type"),
        F_("funding_source", "dim_promotion.funding_source"),
    ),
    measures=(
        F_("gross_sales", total("gross_sales_amount"), "currency"),
        F_("net_sales", total("net_sales_amount"), "currency"),
        F_("discount", total("discount_amount"), "currency"),
        F_("discount_rate", ratio(total("discount_amount"), total("gross_sales_amount")), "percentage"),
        F_("cogs", total("cogs_amount"), "currency"),
        F_("gross_margin", total("gross_margin_amount"), "currency"),
        F_("gross_margin_pct", ratio(total("gross_margin_amount"), total("net_sales_amount")), "percentage"),
        F_("units", total("quantity")),
        F_("line_count", rows()),
        F_("transaction_count", distinct("transaction_id")),
        F_("avg_order_value", ratio(total("net_sales_amount"), distinct("transaction_id")), "currency"),
        F_("avg_basket_units", ratio(total("quantity"), distinct("transaction_id"))),
        F_("avg_unit_price", ratio(total("gross_sales_amount"), total("quantity")), "currency"),
    ),
    determines={"date": (*DATE_PARTS, "is_weekend", "is_holiday"), "department": ("division",)},
), "mv_sales_daily", "region", "department")

MV_INVENTORY = daily(MetricView(
    name="mv_inventory", source="fact_inventory_snapshot",
    comment="Stock at the end of fiscal periods; don't add it up over dates.",
    joins=(J_DATE, J_PRODUCT, J_STORE),
    dimensions=(*DATE_DIMS, *PRODUCT_DIMS, *STORE_DIMS),
    measures=(
        F_("on_hand_qty", total("on_hand_qty")),
        F_("available_qty", total("available_qty")),
        F_("on_order_qty", total("on_order_qty")),
        F_("reserved_qty", total("reserved_qty")),
        F_("on_hand_cost_value", total("on_hand_cost_value"), "currency"),
        F_("on_hand_retail_value", total("on_hand_retail_value"), "currency"),
        F_("avg_days_of_supply", mean("days_of_supply")),
        F_("out_of_stock_rate", share("source.is_out_of_stock"), "percentage"),
        F_("sku_count", distinct("product_sk")),
        F_("stocked_store_count", distinct("store_sk")),
    ),
    determines={"date": DATE_PARTS, "department": ("division",)},
), "mv_inventory_daily", "region", "department")

MV_INVENTORY_VALUATION = daily(MetricView(
    name="mv_inventory_valuation", source="fact_inventory_valuation",
    comment="Stock value and what the category sold meanwhile.",
    joins=(J_DATE, J_STORE),
    dimensions=(
        *DATE_DIMS, *STORE_DIMS,
        F_("category_id", "source.category_id"),
        F_("category_name", "source.category_name"),
    ),
    measures=(
        F_("on_hand_cost_value", total("on_hand_cost_value"), "currency"),
        F_("on_hand_retail_value", total("on_hand_retail_value"), "currency"),
        F_("cogs", total("cogs_amount"), "currency"),
        F_("markdown", total("markdown_amount"), "currency"),
        F_("shrink", total("shrink_amount"), "currency"),
        F_("avg_gmroi", mean("gmroi")),
    ),
    determines={"date": DATE_PARTS},
), "mv_inventory_valuation_daily", "region", "category_name")

MV_FORECAST = daily(MetricView(
    name="mv_forecast", source="fact_sales_forecast",
    comment="Both models' forecasts by week.",
    joins=(J_DATE, J_PRODUCT, J_STORE),
    dimensions=(
        *DATE_DIMS, *PRODUCT_DIMS, *STORE_DIMS,
        F_("forecast_version", "source.forecast_version"),
        F_("model_name", "source.model_name"),
        F_("fiscal_week", "source.fiscal_week"),
    ),
    measures=(
        F_("forecast_qty", total("forecast_qty")),
        F_("forecast_amount", total("forecast_amount"), "currency"),
        F_("lower_bound", total("lower_bound")),
        F_("upper_bound", total("upper_bound")),
        F_("interval_width", difference("upper_bound", "lower_bound")),
    ),
    determines={"date": DATE_PARTS, "department": ("division",)},
), "mv_forecast_daily", "region", "department", "forecast_version", "fiscal_week")

MV_GL_ACTUALS = daily(MetricView(
    name="mv_gl_actuals", source="fact_gl_actuals",
    comment="The ledger by period-end.",
    joins=(J_DATE, J_STORE, J_GL, J_DEPT),
    dimensions=(
        *DATE_DIMS, *STORE_DIMS,
        F_("account_type", "dim_gl_account.account_type"),
        F_("statement", "dim_gl_account.statement"),
        F_("account", "dim_gl_account.account_name"),
        F_("account_category", "dim_gl_account.account_category"),
        F_("department", "dim_department.department_name"),
        F_("department_group", "dim_department.department_group"),
    ),
    measures=(F_("actual_amount", total("actual_amount"), "currency"),),
    determines={"date": DATE_PARTS, "account": ("account_type", "statement", "account_category"), "department": ("department_group",)},
), "mv_gl_actuals_daily", "region", "account", "department")

MV_BUDGET_PLAN = daily(MetricView(
    name="mv_budget_plan", source="fact_budget_plan",
    comment="Plans beside the ledger.",
    joins=(J_DATE, J_STORE, J_GL, J_DEPT),
    dimensions=(
        *DATE_DIMS, *STORE_DIMS,
        F_("plan_version", "source.plan_version"),
        F_("scenario", "source.scenario"),
        F_("account_type", "dim_gl_account.account_type"),
        F_("account", "dim_gl_account.account_name"),
        F_("department", "dim_department.department_name"),
    ),
    measures=(
        F_("plan_amount", total("plan_amount"), "currency"),
        F_("plan_units", total("plan_units")),
    ),
    determines={"date": DATE_PARTS, "account": ("account_type",)},
), "mv_budget_plan_daily", "region", "plan_version", "account")

METRIC_VIEWS = (MV_SALES, MV_INVENTORY, MV_INVENTORY_VALUATION, MV_FORECAST, MV_GL_ACTUALS, MV_BUDGET_PLAN)
