"""Every measure of the six metric views at two grains, in DuckDB SQL written out by hand."""
from __future__ import annotations

from .facts_sql import ALL
from .star_sql import with_star


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _per(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


_ORDERS = "COUNT(DISTINCT s.transaction_id)"
# view: (from, fine dimensions, coarse ones, measures)
_VIEWS = {
    "mv_sales": (
        "fact_sales_line s LEFT JOIN dim_date d ON s.date_sk = d.date_sk LEFT JOIN dim_product p ON s.product_sk = p.product_sk",
        {"fiscal_year": "d.fiscal_year", "category": "p.category_name"}, [],
        {"gross_sales": _d("SUM(gross_sales_amount)"), "net_sales": _d("SUM(net_sales_amount)"), "discount": _d("SUM(discount_amount)"),
         "discount_rate": _per("SUM(discount_amount)", "SUM(gross_sales_amount)"), "cogs": _d("SUM(cogs_amount)"),
         "gross_margin": _d("SUM(gross_margin_amount)"), "gross_margin_pct": _per("SUM(gross_margin_amount)", "SUM(net_sales_amount)"),
         "units": "CAST(SUM(quantity) AS BIGINT)", "line_count": "COUNT(*)", "transaction_count": _ORDERS,
         "avg_order_value": _per("SUM(net_sales_amount)", _ORDERS), "avg_basket_units": _per("SUM(quantity)", _ORDERS),
         "avg_unit_price": _per("SUM(gross_sales_amount)", "SUM(quantity)")}),
    "mv_inventory": (
        "fact_inventory_snapshot s LEFT JOIN dim_date d ON s.date_sk = d.date_sk LEFT JOIN dim_store t ON s.store_sk = t.store_sk",
        {"fiscal_year": "d.fiscal_year", "region": "t.region_name"}, [],
        {**{q: f"CAST(SUM({q}) AS BIGINT)" for q in ("on_hand_qty", "available_qty", "on_order_qty", "reserved_qty")},
         "on_hand_cost_value": _d("SUM(on_hand_cost_value)"), "on_hand_retail_value": _d("SUM(on_hand_retail_value)"),
         "avg_days_of_supply": _d("SUM(days_of_supply)") + " / NULLIF(COUNT(days_of_supply), 0)",
         "out_of_stock_rate": "AVG(CASE WHEN is_out_of_stock THEN 1 ELSE 0 END)", "sku_count": "COUNT(DISTINCT s.product_sk)",
         "stocked_store_count": "COUNT(DISTINCT s.store_sk)"}),
    "mv_inventory_valuation": (
        "fact_inventory_valuation s LEFT JOIN dim_date d ON s.date_sk = d.date_sk",
        {"fiscal_year": "d.fiscal_year", "category_name": "s.category_name"}, [],
        {"on_hand_cost_value": _d("SUM(on_hand_cost_value)"), "on_hand_retail_value": _d("SUM(on_hand_retail_value)"), "cogs": _d("SUM(cogs_amount)"),
         "markdown": _d("SUM(markdown_amount)"), "shrink": _d("SUM(shrink_amount)"), "avg_gmroi": _d("SUM(gmroi)") + " / NULLIF(COUNT(gmroi), 0)"}),
    "mv_forecast": (
        "fact_sales_forecast s", {"forecast_version": "s.forecast_version", "fiscal_week": "s.fiscal_week"}, ["forecast_version"],
        {**{q: _d(f"SUM({q})") for q in ("forecast_qty", "forecast_amount", "lower_bound", "upper_bound")},
         "interval_width": _d("SUM(upper_bound - lower_bound)")}),
    "mv_gl_actuals": (
        "fact_gl_actuals s LEFT JOIN dim_gl_account a USING (gl_account_sk)", {"statement": "a.statement", "account": "a.account_name"}, [],
        {"actual_amount": _d("SUM(actual_amount)")}),
    "mv_budget_plan": (
        "fact_budget_plan s LEFT JOIN dim_gl_account a USING (gl_account_sk)", {"plan_version": "s.plan_version", "account": "a.account_name"},
        ["plan_version"], {"plan_amount": _d("SUM(plan_amount)"), "plan_units": "CAST(SUM(plan_units) AS BIGINT)"}),
}


def _query(name: str, dims: dict[str, str] | None = None) -> str:
    source, fine, coarse, measures = _VIEWS[name]
    fine = dims or fine
    values = ", ".join(f"{x} AS {m}" for m, x in measures.items())

    def at(grain: str, kept: list[str]) -> str:
        dims = ", ".join(f"{x if d in kept else 'NULL'} AS {d}" for d, x in fine.items())
        return f"SELECT {dims}, {values}, '{grain}' AS grain FROM {source}" + (" GROUP BY " + ", ".join(fine[d] for d in kept) if kept else "")

    return with_star(*ALL) + f"\n{at('fine', list(fine))}\nUNION ALL\n{at('coarse', coarse)}"


QUERIES = {name: _query(name) for name in _VIEWS}
# at grains that the stored aggregates reach: sales are stored by department, not category
STORED = {name: _query(name, {"fiscal_year": "d.fiscal_year", "department": "p.department_name"} if name == "mv_sales" else None) for name in _VIEWS}
