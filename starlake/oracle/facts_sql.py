"""Derived facts written independently in DuckDB SQL (oracle side).

Each constant is a list of CTEs appended after ``with_star``.
"""
from __future__ import annotations

from ..plans.ai import ANOMALIES, CASE_CHANNELS, CASE_STATUSES, CASE_TYPES, SUPPLY_PERIOD
from ..plans.facts import DISPOSITIONS, FULFILLMENT_TYPES, RETURN_REASONS
from ..plans.finance import DEPARTMENTS, GL_ACCOUNTS, PLAN_VERSIONS
from ..plans.ops import OVERRIDE_REASONS, PLANNERS, REPLEN_STATUSES
from ..plans.settings import REGISTERED
from ..sources.star import LINE_KEY
from .sqlfn import bnd, bounded_by, id128, pct, pick, sk, u, u_part, weighted

K = list(LINE_KEY)
MAXD = "(SELECT max(date) FROM sales_cal)"


def _shift(date: str, lag: str) -> str:
    return sk(f"least({date} + CAST({lag} AS INTEGER), {MAXD})")


RETURNS = f"""
fact_returns AS (
  SELECT 'RMA-' || CAST(transaction_id AS VARCHAR) || '-' || CAST(line_number AS VARCHAR) AS rma_id,
         transaction_id AS original_transaction_id, line_number AS original_line_number,
         {_shift('d.date', bnd(K, 'return_lag', 1, 30))} AS date_sk,
         product_sk, store_sk, customer_sk, employee_sk, channel_sk,
         {bounded_by(K, 'return_units', 'greatest(quantity, 1)')} AS quantity,
         {pick(RETURN_REASONS, K, 'return_reason')} AS return_reason,
         {pick(DISPOSITIONS, K, 'return_route')} AS disposition,
         CAST(CAST((2 * CAST(net_sales_amount * 100 AS HUGEINT) * {bounded_by(K, 'return_units', 'greatest(quantity, 1)')} + greatest(quantity, 1))
                   // (2 * CAST(greatest(quantity, 1) AS HUGEINT)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS refund_amount,
         {u(K, 'return_fraud')} < 0.02 AS is_fraud_suspected
  FROM fact_sales_line s JOIN sales_cal d USING (date_sk)
  WHERE {u(K, 'return')} < 0.08
),
fact_returns_f AS (
  SELECT *, CASE WHEN disposition = 'Restock' THEN CAST(round(refund_amount * 0.10, 2) AS DECIMAL(18,2))
                 ELSE CAST(0 AS DECIMAL(18,2)) END AS restocking_fee
  FROM fact_returns
)"""

FULFILLMENT = f"""
fact_fulfillment AS (
  SELECT 'ORD-' || CAST(transaction_id AS VARCHAR) || '-' || CAST(line_number AS VARCHAR) AS order_id,
         date_sk, product_sk, store_sk, customer_sk, channel_sk,
         {pick(FULFILLMENT_TYPES, K, 'ship_how')} AS fulfillment_type, quantity,
         {_shift('d.date', bnd(K, 'ship_promise', 2, 7))} AS promised_date_sk,
         {_shift('d.date', bnd(K, 'ship_wait', 0, 3))} AS actual_ship_date_sk,
         {_shift('d.date', bnd(K, 'ship_wait', 0, 3) + ' + ' + bnd(K, 'ship_travel', 1, 6))} AS delivery_date_sk,
         CASE WHEN {pick(FULFILLMENT_TYPES, K, 'ship_how')} IN ('BOPIS', 'Curbside') THEN CAST(0 AS DECIMAL(18,2))
              ELSE CAST(round(4.99 + {u(K, 'ship_price')} * 10, 2) AS DECIMAL(18,2)) END AS shipping_cost
  FROM fact_sales_line s JOIN sales_cal d USING (date_sk)
  WHERE channel_sk IN (2, 3, 4)
),
fact_fulfillment_f AS (SELECT *, delivery_date_sk <= promised_date_sk AS sla_met_flag FROM fact_fulfillment)"""

_LK = ["transaction_id", "store_sk"]
# A receipt's entries are a list: it earns, and a share of receipts has one event more. 500 points, a quarter, +-50.
LOYALTY = f"""
earned AS (
  SELECT transaction_id, store_sk, s.customer_sk, date_sk, channel_sk, any_value(c.loyalty_tier) AS tier, CAST(SUM(loyalty_points_earned) AS BIGINT) AS n
  FROM fact_sales_line s SEMI JOIN (SELECT * FROM dim_customer WHERE loyalty_member_flag) m ON m.customer_sk = s.customer_sk
       JOIN dim_customer c ON c.customer_sk = s.customer_sk
  GROUP BY transaction_id, store_sk, s.customer_sk, date_sk, channel_sk
),
entries AS (
  SELECT e.*, day.date, unnest(list_filter([
    {{'kind': 'Earn', 'lag': 0, 'points': n}},
    CASE WHEN {u(_LK, 'points_event')} < 0.15 THEN {{
      'kind': ['Redeem', 'Expire', 'Adjust'][{bnd(_LK, 'points_kind', 1, 3)}], 'lag': {bnd(_LK, 'points_lag', 1, 45)},
      'points': [-least(n, 500), -(n // 4), CAST({bnd(_LK, 'points_adjust', -50, 50)} AS BIGINT)][{bnd(_LK, 'points_kind', 1, 3)}]}} END
  ], lambda x: x IS NOT NULL)) AS entry
  FROM (SELECT * FROM earned WHERE n > 0) e JOIN sales_cal day USING (date_sk)
),
named AS (
  SELECT *, entry.kind AS kind, {_shift('date', 'entry.lag')} AS on_day, {id128(['customer_sk', 'entry.kind', 'transaction_id', 'store_sk'], 'points')} AS id FROM entries
),
fact_loyalty_activity AS (
  SELECT id AS loyalty_event_id, on_day AS date_sk, customer_sk, store_sk, channel_sk, kind AS activity_type, entry.points AS points,
         CAST(SUM(entry.points) OVER upto AS BIGINT) AS points_balance, tier AS tier_at_event, CASE kind WHEN 'Earn' THEN transaction_id END AS related_transaction_id
  FROM named WINDOW upto AS (PARTITION BY customer_sk ORDER BY on_day, id)
)"""

_CELL = ["store_sk", "product_sk", "date_sk"]
SNAPSHOT = f"""
periods AS (
  SELECT date_sk, fiscal_year, fiscal_period, fiscal_week, CAST(fiscal_year * 12 + fiscal_period - 1 AS INTEGER) AS pidx
  FROM sales_cal
),
pe AS (
  SELECT fiscal_year, fiscal_period, max(date_sk) AS period_end_date_sk, max(fiscal_week) AS period_max_week,
         CAST(fiscal_year * 12 + fiscal_period - 1 AS INTEGER) AS pidx
  FROM sales_cal GROUP BY fiscal_year, fiscal_period
),
sp AS (SELECT s.store_sk, s.product_sk, s.quantity, p.pidx FROM fact_sales_line s JOIN periods p USING (date_sk)),
seasonal AS (
  SELECT pidx, greatest(CAST(pu AS DOUBLE) / (CAST(SUM(pu) OVER () AS DOUBLE) / COUNT(*) OVER ()), 0.1) AS season
  FROM (SELECT pidx, SUM(quantity) AS pu FROM sp GROUP BY pidx)
),
pairs AS (
  SELECT store_sk, product_sk, CAST(SUM(quantity) AS BIGINT) AS units, min(pidx) AS first_pidx
  FROM sp GROUP BY store_sk, product_sk
),
nd AS (SELECT CAST(count(*) AS BIGINT) AS nd FROM sales_cal),
grid AS (
  SELECT g.store_sk, g.product_sk, g.units, pe.period_end_date_sk AS date_sk, seasonal.season,
         p.list_price, p.standard_cost AS unit_cost, nd.nd AS _nd, g.units * 20 < nd.nd AS slow
  FROM (SELECT store_sk, product_sk, units,
               unnest(generate_series(first_pidx, (SELECT max(pidx) FROM pe))) AS pidx FROM pairs) g
  JOIN pe USING (pidx) LEFT JOIN seasonal USING (pidx)
  LEFT JOIN dim_product p ON g.product_sk = p.product_sk
  CROSS JOIN nd
),
snap0 AS (
  SELECT *,
    CASE WHEN {u_part(_CELL, 'stock', 0)} < 0.04 THEN 0
         ELSE greatest(CAST(round({REGISTERED.weeks_of_supply * 7}.0 * greatest(CAST(units AS DOUBLE) / CAST(_nd AS DOUBLE), 0.05)
                                  * coalesce(season, 1.0)
                                  * CAST(0.85 + {u_part(_CELL, 'stock', 1)} * 0.30 AS DOUBLE)) AS INTEGER), 0) END AS on_hand_qty,
    CAST(floor({u_part(_CELL, 'stock', 2)} * 5) AS INTEGER) AS reserved_qty,
    CAST(CASE WHEN slow THEN 1 ELSE (units * 3 + _nd - 1) // _nd END AS INTEGER) AS safety_stock_qty,
    CAST(CASE WHEN slow THEN 1 ELSE (units * 7 + _nd - 1) // _nd END AS INTEGER) AS reorder_point,
    CAST(CASE WHEN slow THEN 1 ELSE (units * 14 + _nd - 1) // _nd END AS INTEGER) AS _oo
  FROM grid
),
snap1 AS (
  SELECT *, CAST(CASE WHEN on_hand_qty < reorder_point THEN _oo ELSE 0 END AS INTEGER) AS on_order_qty FROM snap0
),
fact_inventory_snapshot AS (
  SELECT date_sk, store_sk, product_sk, on_hand_qty, on_order_qty,
         CAST(CASE WHEN on_order_qty > 0 THEN floor({u_part(_CELL, 'stock', 3)} * on_order_qty) ELSE 0 END AS INTEGER)
           AS in_transit_qty,
         reserved_qty, CAST(greatest(on_hand_qty - reserved_qty, 0) AS INTEGER) AS available_qty,
         safety_stock_qty, reorder_point, unit_cost,
         CAST(on_hand_qty * list_price AS DECIMAL(18,2)) AS on_hand_retail_value,
         CAST(on_hand_qty * unit_cost AS DECIMAL(18,2)) AS on_hand_cost_value,
         CAST(CAST(CASE WHEN slow THEN on_hand_qty * 200
                        ELSE (20 * on_hand_qty * _nd + units) // (2 * units) END AS DECIMAL(18,0)) * 0.1
              AS DECIMAL(18,1)) AS days_of_supply,
         on_hand_qty = 0 AS is_out_of_stock
  FROM snap1
)"""

_GL_ROWS = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS gl_account_sk, '{a[0]}' AS account_number, '{a[1]}' AS account_name, "
    f"'{a[2]}' AS account_type, '{a[3]}' AS statement, '{a[4]}' AS statement_section, '{a[5]}' AS account_category, "
    f"'{a[6]}' AS normal_balance, {str(a[7]).lower()} AS is_contra"
    for i, a in enumerate(GL_ACCOUNTS, start=1)
)
_DEPT_ROWS = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS department_sk, '{n}' AS department_name, '{g}' AS department_group"
    for i, (n, g) in enumerate(DEPARTMENTS, start=1)
)


# Fixed values of the postings: account, department, what it is a share of, the share (of a month: an amount of money),
# and whether it varies by store. A share of nothing per month gives every store and period the account.
_POSTINGS = """(VALUES
    ('4100', 'Merchandising', 'returned', -1.000, false), ('4100', 'Merchandising', 'month', 0, false),
    ('4200', 'Merchandising', 'recognized', -0.010, false), ('4200', 'Merchandising', 'month', 0, false),
    ('5200', 'Merchandising', 'recognized', 0.015, false), ('5200', 'Merchandising', 'month', 0, false),
    ('5300', 'Supply Chain', 'shrunk', 1.000, false), ('5300', 'Supply Chain', 'month', 0, false),
    ('6000', 'Store Operations', 'month', 8000, true), ('6000', 'Store Operations', 'recognized', 0.110, true),
    ('6100', 'Store Operations', 'month', 6000, true),
    ('6200', 'Marketing', 'month', 0, true), ('6200', 'Marketing', 'recognized', 0.040, true),
    ('6300', 'Supply Chain', 'month', 0, true), ('6300', 'Supply Chain', 'recognized', 0.030, true),
    ('6400', 'G&A', 'month', 4000, true), ('6400', 'G&A', 'recognized', 0.020, true),
    ('6500', 'G&A', 'month', 3500, true)) AS postings(account_number, dept_name, basis, share, varies)"""

GL = f"""
dim_gl_account AS ({_GL_ROWS}),
dim_department AS ({_DEPT_ROWS}),
ga0 AS (
  SELECT s.store_sk, s.channel_sk IN (2, 3, 4) AS is_online, p.pidx,
         CAST(SUM(gross_sales_amount) AS DECIMAL(18,2)) AS gross, CAST(SUM(cogs_amount) AS DECIMAL(18,2)) AS cogs,
         CAST(SUM(CASE WHEN p.fiscal_week = pe.period_max_week THEN gross_sales_amount ELSE 0 END) AS DECIMAL(18,2))
           AS last_week_gross
  FROM fact_sales_line s JOIN periods p USING (date_sk) JOIN pe USING (pidx)
  GROUP BY s.store_sk, is_online, p.pidx
),
ga1 AS (
  SELECT *, CASE WHEN lead(pidx) OVER (PARTITION BY store_sk, is_online ORDER BY pidx) IS NOT NULL
                 THEN CAST(round(last_week_gross * 0.05, 2) AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS shift_out
  FROM ga0
),
ga AS (
  SELECT *, CAST(gross - shift_out + coalesce(lag(shift_out) OVER (PARTITION BY store_sk, is_online ORDER BY pidx), 0)
                 AS DECIMAL(18,2)) AS recognized_gross,
         CASE WHEN is_online THEN 'E-commerce' ELSE 'Merchandising' END AS dept_name
  FROM ga1
),
base_amounts AS (
  SELECT store_sk, pidx, 'recognized' AS basis, recognized_gross AS amount FROM ga
  UNION ALL SELECT store_sk, pidx, 'returned', refund_amount FROM fact_returns_f JOIN periods USING (date_sk)
  UNION ALL SELECT store_sk, pidx, 'shrunk', abs(quantity) * unit_cost FROM fact_inventory_movement JOIN periods USING (date_sk) WHERE movement_type = 'Shrink'
),
bases AS (
  SELECT store_sk, pidx, basis, CAST(SUM(amount) AS DECIMAL(18,2)) AS amount FROM base_amounts GROUP BY ALL
  UNION ALL SELECT DISTINCT store_sk, pidx, 'month', CAST(1 AS DECIMAL(18,2)) FROM base_amounts
),
posted AS (
  SELECT store_sk, pidx, dept_name, account_number, varies, CAST(SUM(CAST(share AS DECIMAL(9,3)) * amount) AS DECIMAL(24,5)) AS amount
  FROM bases JOIN {_POSTINGS} USING (basis) GROUP BY ALL
),
gl_lines AS (
  SELECT store_sk, pidx, dept_name, '4000' AS account_number, recognized_gross AS amount FROM ga
  UNION ALL SELECT store_sk, pidx, dept_name, '5000', cogs FROM ga
  UNION ALL
  SELECT store_sk, pidx, dept_name, account_number, CAST(round(
    amount * CASE WHEN varies THEN CAST(0.95 + {u(['store_sk', 'account_number'], 'opex')} * 0.10 AS DECIMAL(8,6)) ELSE CAST(1 AS DECIMAL(8,6)) END, 2) AS DECIMAL(18,2))
  FROM posted
),
fact_gl_actuals AS (
  SELECT pe.period_end_date_sk AS date_sk, a.gl_account_sk, l.store_sk, d.department_sk,
         CAST(pe.fiscal_year AS INTEGER) AS fiscal_year, CAST(pe.fiscal_period AS INTEGER) AS fiscal_period,
         l.amount AS actual_amount, 'USD' AS currency
  FROM gl_lines l JOIN dim_gl_account a USING (account_number)
       JOIN dim_department d ON l.dept_name = d.department_name JOIN pe USING (pidx)
),
fact_budget_plan AS (
  SELECT date_sk, gl_account_sk, store_sk, department_sk, plan_version, fiscal_year, fiscal_period, plan_amount,
         CAST(abs(CAST(plan_amount * 100 AS BIGINT)) // 5000 AS BIGINT) AS plan_units, 'Base' AS scenario
  FROM (
    SELECT g.*, v.plan_version,
           CAST(round(actual_amount * (1 + CAST(({u(['store_sk', 'gl_account_sk', 'v.plan_version'], 'plan')} * 2 - 1)
                                               * 0.08 AS DECIMAL(10,8))), 2) AS DECIMAL(18,2)) AS plan_amount
    FROM fact_gl_actuals g
    JOIN (SELECT unnest([{', '.join(repr(v) for v in PLAN_VERSIONS)}]) AS plan_version) v ON true
    WHERE gl_account_sk IN (SELECT gl_account_sk FROM dim_gl_account WHERE statement = 'P&L')
  )
)"""

VALUATION = """
val_base AS (
  SELECT s.store_sk, p.category_id, p.category_name, s.date_sk, pe.pidx,
         CAST(pe.fiscal_year AS INTEGER) AS fiscal_year, CAST(pe.fiscal_period AS INTEGER) AS fiscal_period,
         CAST(SUM(on_hand_cost_value) AS DECIMAL(18,2)) AS on_hand_cost_value,
         CAST(SUM(on_hand_retail_value) AS DECIMAL(18,2)) AS on_hand_retail_value
  FROM fact_inventory_snapshot s JOIN pe ON s.date_sk = pe.period_end_date_sk
       JOIN dim_product p ON s.product_sk = p.product_sk
  GROUP BY ALL
),
val_sales AS (
  SELECT s.store_sk, p.category_id, pr.pidx,
         CAST(SUM(gross_sales_amount) AS DECIMAL(18,2)) AS cat_gross,
         CAST(SUM(net_sales_amount) AS DECIMAL(18,2)) AS cat_net,
         CAST(SUM(cogs_amount) AS DECIMAL(18,2)) AS cat_cogs
  FROM fact_sales_line s JOIN periods pr USING (date_sk) JOIN dim_product p ON s.product_sk = p.product_sk
  GROUP BY ALL
),
val0 AS (
  SELECT b.*, coalesce(cat_gross, 0) AS g, coalesce(cat_net, 0) AS n, coalesce(cat_cogs, 0) AS c,
         CAST((coalesce(cat_net, 0) - coalesce(cat_cogs, 0)) * 100 AS BIGINT) AS _mc,
         greatest(CAST(on_hand_cost_value * 100 AS BIGINT), 100) AS _cc
  FROM val_base b LEFT JOIN val_sales USING (store_sk, category_id, pidx)
),
fact_inventory_valuation AS (
  SELECT date_sk, store_sk, category_id, category_name, fiscal_year, fiscal_period, on_hand_cost_value,
         on_hand_retail_value, CAST(c AS DECIMAL(18,2)) AS cogs_amount,
         CAST(round(0.015 * g, 2) AS DECIMAL(18,2)) AS markdown_amount,
         CAST(round(0.005 * on_hand_cost_value, 2) AS DECIMAL(18,2)) AS shrink_amount,
         CAST(sign(_mc) * CAST((2 * abs(_mc) * 10000 + _cc) // (2 * _cc) AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(18,4))
           AS gmroi
  FROM val0
)"""

_BK = ["product_sk", "store_sk", "fiscal_week"]
FORECAST = f"""
wc AS (
  SELECT fiscal_year, fiscal_week, max(date_sk) AS date_sk, max(fiscal_period) AS fiscal_period,
         bool_or(selling_season = 'Holiday') AS is_holiday_week
  FROM sales_cal GROUP BY fiscal_year, fiscal_week
),
weekly AS (
  SELECT product_sk, store_sk, d.fiscal_year, d.fiscal_week, CAST(SUM(quantity) AS BIGINT) AS actual_qty,
         CAST(SUM(net_sales_amount) AS DECIMAL(18,2)) AS actual_net
  FROM fact_sales_line s JOIN sales_cal d USING (date_sk) GROUP BY ALL
),
fweeks AS (
  SELECT DISTINCT fiscal_year, fiscal_week FROM sales_cal WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders) ORDER BY fiscal_year DESC, fiscal_week DESC LIMIT {REGISTERED.horizon_weeks}
),
fbase AS (
  SELECT w.*, wc.date_sk, wc.fiscal_period, wc.is_holiday_week,
         CASE WHEN is_holiday_week AND w.fiscal_year = (SELECT max(fiscal_year) FROM sales_cal) THEN 0.6
              WHEN wc.fiscal_period = {SUPPLY_PERIOD} AND w.fiscal_year = (SELECT max(fiscal_year) FROM sales_cal)
                   AND {pct(['product_sk'], 'supply_band', 25)} THEN 1.4 ELSE 1.0 END AS _mult,
         {u(_BK, 'forecast_error')} * 0.10 - 0.05 AS _bias
  FROM weekly w JOIN fweeks USING (fiscal_year, fiscal_week) JOIN wc USING (fiscal_year, fiscal_week)
),
fv AS (
  SELECT b.*, v.forecast_version,
         CAST(round(greatest(CASE WHEN v.forecast_version = 'baseline' THEN actual_qty * (1 + _bias) * _mult
                                  ELSE actual_qty * (1 + _bias * 0.4) END, 0), 2) AS DECIMAL(18,2)) AS forecast_qty
  FROM fbase b JOIN (SELECT unnest(['baseline', 'improved']) AS forecast_version) v ON true
),
fact_sales_forecast AS (
  SELECT date_sk, product_sk, store_sk, forecast_version, CAST(fiscal_year AS INTEGER) AS fiscal_year,
         CAST(fiscal_week AS INTEGER) AS fiscal_week, forecast_qty,
         CAST(CAST((CAST(forecast_qty * 100 AS HUGEINT) * CAST(actual_net * 100 AS HUGEINT) * 2
                    + greatest(actual_qty, 1) * 100) // (greatest(actual_qty, 1) * 200) AS DECIMAL(18,0)) * 0.01
              AS DECIMAL(18,2)) AS forecast_amount,
         CAST(round(forecast_qty * 0.85, 2) AS DECIMAL(18,2)) AS lower_bound,
         CAST(round(forecast_qty * 1.15, 2) AS DECIMAL(18,2)) AS upper_bound,
         CASE WHEN forecast_version = 'baseline' THEN 'seasonal_naive_v1' ELSE 'gbt_v2' END AS model_name,
         (SELECT max(date) FROM sales_cal) AS forecast_generated_date
  FROM fv
)"""

_ANOM = " UNION ALL ".join(
    "SELECT CAST({0} AS BIGINT) AS anomaly_id, '{1}' AS anomaly_type, '{2}' AS description, '{3}' AS win, "
    "'{4}' AS affected_dimension, '{5}' AS expected_signal, '{6}' AS realized_in".format(
        *[str(x).replace("'", "''") for x in a])
    for a in ANOMALIES
)
_REV = ["transaction_id", "source_line", "s.product_sk", "store_sk"]
AI = f"""
anom_rows AS ({_ANOM}),
anom_win AS (
  SELECT 'holiday' AS win, min(date_sk) AS start_date_sk, max(date_sk) AS end_date_sk FROM sales_cal
  WHERE fiscal_year = (SELECT max(fiscal_year) FROM sales_cal) AND selling_season = 'Holiday'
  UNION ALL
  SELECT 'supply', min(date_sk), max(date_sk) FROM sales_cal
  WHERE fiscal_year = (SELECT max(fiscal_year) FROM sales_cal) AND fiscal_period = {SUPPLY_PERIOD}
),
ai_anomaly_catalog AS (
  SELECT anomaly_id, anomaly_type, description, start_date_sk, end_date_sk, affected_dimension, expected_signal,
         realized_in
  FROM anom_rows LEFT JOIN anom_win USING (win)
),
rev0 AS (
  SELECT s.*, coalesce(p.product_name, 'an item') AS _name, coalesce(p.category_name, 'general') AS _category,
         CASE WHEN {u(_REV, 'review_glad')} < 0.7 THEN {bnd(_REV, 'review_high', 4, 5)} ELSE {bnd(_REV, 'review_any', 1, 5)} END AS rating
  FROM fact_sales_line s LEFT JOIN dim_product p ON s.product_sk = p.product_sk
  WHERE {u(_REV, 'review')} < {REGISTERED.review_rate}
),
product_review_staging AS (
  SELECT {id128(['transaction_id', 'line_number'], 'review')} AS review_id, product_sk, customer_sk, date_sk, CAST(rating AS INTEGER) AS rating,
         true AS verified_purchase, {bnd(list(LINE_KEY), 'review_votes', 0, 50)} AS helpful_votes,
         'A shopper bought ' || _name || ' (' || _category || ') and rates it ' || CAST(rating AS VARCHAR) ||
           ' of 5. Put their opinion in two to four sentences, in their own voice.' AS prompt,
         'Headline of at most eight words for a ' || CAST(rating AS VARCHAR) || ' of 5 opinion about ' || _name || '.' AS title_prompt
  FROM rev0
),
case0 AS (
  SELECT *, {pick(CASE_TYPES, K, 'case_type')} AS case_type, {pick(CASE_CHANNELS, K, 'case_channel')} AS channel,
         {pick(CASE_STATUSES, K, 'case_status')} AS status
  FROM fact_sales_line WHERE {u(K, 'case')} < {REGISTERED.case_rate}
),
service_case_staging AS (
  SELECT {id128(['transaction_id', 'line_number'], 'case')} AS case_id, customer_sk, product_sk, store_sk, date_sk, case_type, channel, status,
         CASE WHEN status IN ('Resolved', 'Closed') THEN {bnd(K, 'case_glad', 4, 5)} ELSE {bnd(K, 'case_sad', 1, 3)} END AS csat_score,
         'An agent took a ' || case_type || ' request by ' || channel ||
           '. Note in one to three sentences what the customer says is wrong.' AS notes_prompt,
         CASE WHEN status IN ('Resolved', 'Closed') THEN 'The ' || case_type ||
              ' request is settled. Say in a sentence or two what was done.' END AS resolution_prompt
  FROM case0
)"""

_RK = ["product_sk", "store_sk"]
_OK = ["product_sk", "store_sk", "date_sk"]
OPS = f"""
replen0 AS (
  SELECT c.*, d.date, CAST(greatest(reorder_point + safety_stock_qty - available_qty, 0) AS INTEGER) AS suggested_qty,
         {weighted(u(_RK, 'order_stage'), [s for s, _ in REPLEN_STATUSES], [w for _, w in REPLEN_STATUSES])} AS status
  FROM fact_inventory_snapshot c JOIN sales_cal d USING (date_sk)
  WHERE date_sk = (SELECT max(date_sk) FROM fact_inventory_snapshot) AND available_qty <= reorder_point
),
replenishment_order AS (
  SELECT {id128(['product_sk', 'store_sk', 'date_sk'], 'replen')} AS replen_id, product_sk, store_sk, suggested_qty,
         CASE WHEN status <> 'Suggested' THEN CAST(greatest(suggested_qty + {bnd(_RK, 'order_change', -2, 2)}, 0) AS INTEGER)
         END AS approved_qty,
         status, reorder_point, 'system' AS created_by,
         CASE WHEN status <> 'Suggested' THEN {pick(PLANNERS, _RK, 'order_planner')} END AS approved_by,
         CAST(date AS TIMESTAMP) AS created_at,
         CASE WHEN status = 'Suggested' THEN CAST(date AS TIMESTAMP) ELSE CAST(date AS TIMESTAMP) + INTERVAL 2 DAY END
           AS updated_at
  FROM replen0
),
forecast_override AS (
  SELECT {id128(_OK, 'override')} AS override_id, product_sk, store_sk, f.fiscal_year, f.fiscal_week, forecast_qty AS ai_forecast_qty,
         CAST(round(greatest(forecast_qty * (0.7 + {u(_OK, 'override_by')} * 0.6), 0), 2) AS DECIMAL(18,2)) AS override_qty,
         {pick(OVERRIDE_REASONS, _OK, 'override_why')} AS override_reason, {pick(PLANNERS, _OK, 'override_planner')} AS planner_id,
         CAST(d.date AS TIMESTAMP) AS created_at, CAST(d.date AS TIMESTAMP) + INTERVAL 1 DAY AS updated_at
  FROM fact_sales_forecast f JOIN sales_cal d USING (date_sk)
  WHERE forecast_version = 'improved' AND {u(_OK, 'override')} < {REGISTERED.override_rate}
)"""

ALL = [RETURNS, FULFILLMENT, LOYALTY, SNAPSHOT, GL, VALUATION, FORECAST, AI, OPS]
