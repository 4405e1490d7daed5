"""The star-schema mapping written independently in DuckDB SQL (oracle side).

``STAR_CTES`` is a list of ``name AS (...)`` common table expressions over the
driver's tables; oracle queries prepend ``with_star(...)``.
"""
from __future__ import annotations

from ..sources.star import (
    CHANNELS, DEVICES, LINE_KEY, LOYALTY_TIERS, MOVEMENT_TYPES, REASON_CODES, REFERRERS, STORE_STAFF, TAXONOMY, TENDERS,
)
from .sqlfn import bnd, cap1, id128, pct, pick, sk, u, weighted


def _fsun(y: str) -> str:
    f1 = f"make_date(CAST({y} AS BIGINT), 2, 1)"
    return f"({f1} + CAST((7 - dayofweek({f1})) % 7 AS INTEGER))"


def _nth(y: str, month: int, duck_dow: int, n: int) -> str:
    first = f"make_date(CAST({y} AS BIGINT), {month}, 1)"
    return f"({first} + CAST(({duck_dow} - dayofweek({first}) + 7) % 7 + {7 * (n - 1)} AS INTEGER))"


def _last(y: str, month: int, duck_dow: int) -> str:
    last = f"last_day(make_date(CAST({y} AS BIGINT), {month}, 1))"
    return f"({last} - CAST((dayofweek({last}) - {duck_dow} + 7) % 7 AS INTEGER))"


_SEASON = " ".join(
    f"WHEN {m} THEN '{s}'" for m, s in {
        1: "Post-Holiday", 2: "Post-Holiday", 3: "Spring", 4: "Spring", 5: "Spring", 6: "Summer",
        7: "Back-to-School", 8: "Back-to-School", 9: "Back-to-School", 10: "Fall", 11: "Holiday",
        12: "Holiday"}.items()
)

DIM_DATE = f"""
hist AS (
  SELECT (SELECT make_date(CAST(year(min(o_orderdate)) AS BIGINT), 1, 1) FROM orders) AS hs,
         (SELECT make_date(CAST(year(max(l_shipdate)) AS BIGINT), 12, 31) FROM lineitem) AS he
),
dd_days AS (
  SELECT CAST(unnest(generate_series(CAST((SELECT hs FROM hist) AS TIMESTAMP), CAST((SELECT he FROM hist) AS TIMESTAMP),
    INTERVAL 1 DAY)) AS DATE) AS d
  UNION
  SELECT CAST(unnest(generate_series(
    CAST((SELECT make_date(CAST(year(min(ts)) AS BIGINT), 1, 1) FROM events) AS TIMESTAMP),
    CAST((SELECT make_date(CAST(year(max(ts)) AS BIGINT), 12, 31) FROM events) AS TIMESTAMP),
    INTERVAL 1 DAY)) AS DATE) AS d
),
dd_fy AS (
  SELECT d, year(d) AS y,
         CASE WHEN d >= {_fsun('year(d)')} THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
         CASE WHEN d >= {_fsun('year(d)')} THEN {_fsun('year(d)')} ELSE {_fsun('year(d) - 1')} END AS fy_start
  FROM dd_days
),
dd_fw AS (
  SELECT *, CAST(datediff('day', fy_start, d) // 7 + 1 AS INTEGER) AS fiscal_week FROM dd_fy
),
dim_date AS (
  SELECT {sk('d')} AS date_sk, d AS date,
         CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
         CAST(weekofyear(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         CAST(fiscal_year AS INTEGER) AS fiscal_year, fiscal_week,
         CAST(CASE WHEN fiscal_week <= 4 THEN 1 WHEN fiscal_week <= 9 THEN 2 WHEN fiscal_week <= 13 THEN 3
              WHEN fiscal_week <= 17 THEN 4 WHEN fiscal_week <= 22 THEN 5 WHEN fiscal_week <= 26 THEN 6
              WHEN fiscal_week <= 30 THEN 7 WHEN fiscal_week <= 35 THEN 8 WHEN fiscal_week <= 39 THEN 9
              WHEN fiscal_week <= 43 THEN 10 WHEN fiscal_week <= 48 THEN 11 ELSE 12 END AS INTEGER) AS fiscal_period,
         CAST(NULL AS INTEGER) AS fiscal_quarter,
         isodow(d) >= 6 AS is_weekend,
         CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
              WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
              WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day'
              WHEN d = {_nth('y', 11, 4, 4)} THEN 'Thanksgiving'
              WHEN d = {_nth('y', 11, 4, 4)} + 1 THEN 'Black Friday'
              WHEN d = {_last('y', 5, 1)} THEN 'Memorial Day'
              WHEN d = {_nth('y', 9, 1, 1)} THEN 'Labor Day' END AS holiday_name,
         CASE month(d) {_SEASON} END AS selling_season
  FROM dd_fw
)"""

# fiscal_quarter and is_holiday derived in a second step to keep the CTE readable.
DIM_DATE_FULL = DIM_DATE.replace("dim_date AS (", "dim_date0 AS (") + """,
dim_date AS (
  SELECT date_sk, date, day_of_week, day_name, week, month, month_name, quarter, year, fiscal_year, fiscal_week,
         fiscal_period, CAST((fiscal_period - 1) // 3 + 1 AS INTEGER) AS fiscal_quarter, is_weekend,
         holiday_name IS NOT NULL AS is_holiday, holiday_name, selling_season
  FROM dim_date0
),
sales_cal AS (SELECT * FROM dim_date WHERE date BETWEEN (SELECT hs FROM hist) AND (SELECT he FROM hist))"""

_TAX = " UNION ALL ".join(f"SELECT '{c}' AS p_type, '{d}' AS department_name, '{v}' AS division_name"
                          for v, departments in TAXONOMY for d, categories in departments for c in categories)
_CHAN = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS channel_sk, 'CH{i:02d}' AS channel_id, '{n}' AS channel_name, '{t}' AS channel_type"
    for i, (n, t) in enumerate(CHANNELS, start=1)
)
_NOUN = "split_part(p_name, ' ', 2)"

DIMS = f"""
dim_channel AS ({_CHAN}),
taxonomy AS ({_TAX}),
dim_product AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_sk,
         'SKU' || lpad(CAST(p_partkey + 1 AS VARCHAR), 8, '0') AS sku,
         p_name AS product_name,
         p_name || ', ' || lower(p_type) || ' range, size ' || CAST(p_size AS VARCHAR) AS product_description,
         'BR-' || regexp_extract(p_brand, '(\\d+)', 1) AS brand_id, p_brand AS brand_name,
         upper(replace(division_name, ' ', '')) AS division_id, division_name,
         upper(replace(department_name, ' ', '')) AS department_id, department_name,
         'CAT-' || p_type AS category_id, {cap1('p_type')} AS category_name,
         'SUB-' || p_type || '-' || upper({cap1(_NOUN)}) AS subcategory_id,
         {cap1('p_type')} || ' ' || {cap1(_NOUN)} AS subcategory_name,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS primary_vendor_sk,
         {pct(['p_partkey'], 'private_label', 10)} AS private_label_flag,
         {pct(['p_partkey'], 'marketplace', 15)} AS is_marketplace,
         {pick(("Each", "Each", "Each", "Pack", "Case"), ['p_partkey'], 'uom')} AS uom,
         '{{"size":' || CAST(p_size AS VARCHAR) || ',"brand":"' || p_brand || '"}}' AS spec_attributes,
         CAST(p_size AS INTEGER) AS size,
         CAST(p_retailprice AS DECIMAL(18,2)) AS msrp, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
         CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * 0.65, 2) AS DECIMAL(18,2)) AS standard_cost,
         {weighted(u(['p_partkey'], 'lifecycle'), ("Active", "New", "Clearance", "Discontinued"), (70, 15, 10, 5))} AS lifecycle_status,
         CAST(TIMESTAMP '1900-01-01' AS TIMESTAMP) AS effective_start_ts, CAST(NULL AS TIMESTAMP) AS effective_end_ts, true AS is_current,
         CAST(1 AS BIGINT) AS version
  FROM part LEFT JOIN taxonomy USING (p_type)
),
dim_store AS (
  SELECT CAST(s_suppkey AS BIGINT) AS store_sk,
         'ST' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 5, '0') AS store_id, s_name AS store_name,
         CASE WHEN {bnd(['s_suppkey'], 'sqft', 15000, 45000)} >= 35000 THEN 'Flagship'
              WHEN {bnd(['s_suppkey'], 'sqft', 15000, 45000)} >= 20000 THEN 'Standard' ELSE 'Outlet' END AS store_format,
         'R' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS region_id, r_name AS region_name,
         'D' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS district_id, n_name AS district_name,
         n_name AS state, 'N/A' AS country,
         CAST({bnd(['s_suppkey'], 'sqft', 15000, 45000)} AS BIGINT) AS square_footage,
         CAST(DATE '1990-01-01' + {bnd(['s_suppkey'], 'open', 0, 1800)} AS DATE) AS open_date, 'Active' AS status,
         {pct(['s_suppkey'], 'sfs', 60)} AS is_ship_from_store, {pct(['s_suppkey'], 'bopis', 70)} AS is_bopis_enabled,
         'CC' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 5, '0') AS cost_center_id,
         CAST(TIMESTAMP '1900-01-01' AS TIMESTAMP) AS effective_start_ts, CAST(NULL AS TIMESTAMP) AS effective_end_ts, true AS is_current,
         CAST(1 AS BIGINT) AS version
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
),
dim_customer AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_sk, 'CUST' || lpad(CAST(c_custkey + 1 AS VARCHAR), 8, '0') AS customer_id,
         c_name AS full_name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Commercial-B2B' ELSE 'Retail' END AS customer_type,
         n_name AS state,
         {u(['c_custkey'], 'loyal')} < 0.5 AS loyalty_member_flag,
         CASE WHEN {u(['c_custkey'], 'loyal')} < 0.5
              THEN {weighted(u(['c_custkey'], 'tier'), [t for t, _ in LOYALTY_TIERS], [w for _, w in LOYALTY_TIERS])}
              ELSE 'None' END AS loyalty_tier,
         CASE WHEN {u(['c_custkey'], 'loyal')} < 0.5 THEN CAST(DATE '1994-01-01' + {bnd(['c_custkey'], 'enroll', 0, 2500)} AS DATE) END
           AS loyalty_enroll_date,
         {pick(("Store", "Web", "Referral", "Social"), ['c_custkey'], 'acq')} AS acquisition_channel,
         {cap1('c_mktsegment')} AS segment, {pct(['c_custkey'], 'optin', 55)} AS email_opt_in,
         CAST(TIMESTAMP '1900-01-01' AS TIMESTAMP) AS effective_start_ts, CAST(NULL AS TIMESTAMP) AS effective_end_ts, true AS is_current,
         CAST(1 AS BIGINT) AS version
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
dim_promotion AS (
  SELECT k AS promotion_sk, 'PR' || lpad(CAST(k AS VARCHAR), 5, '0') AS promotion_id, CAST(k AS VARCHAR) || '% off' AS promo_name,
         {pick(("Spring", "Summer", "Fall", "Holiday"), ['k'], 'campaign')} || ' ' || {pick(("Savings", "Days", "Event"), ['k'], 'campaign_kind')}
           AS campaign_name,
         {pick(("Price Cut", "Bundle", "Clearance", "Seasonal"), ['k'], 'ptype')} AS promo_type, 'Percent' AS discount_method,
         rate AS discount_value, first + {bnd(['k'], 'campaign_start', 0, 300)} AS start_date,
         first + {bnd(['k'], 'campaign_start', 0, 300)} + {bnd(['k'], 'campaign_days', 7, 90)} AS end_date,
         {pick(("All", "Store", "Online"), ['k'], 'scope')} AS channel_scope,
         {pick(("Retailer", "Vendor"), ['k'], 'fund')} AS funding_source,
         CAST(TIMESTAMP '1900-01-01' AS TIMESTAMP) AS effective_start_ts, CAST(NULL AS TIMESTAMP) AS effective_end_ts, true AS is_current,
         CAST(1 AS BIGINT) AS version
  FROM (SELECT DISTINCT CAST(l_discount AS DECIMAL(4,2)) AS rate, CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT) AS k FROM lineitem),
       (SELECT CAST(min(o_orderdate) AS DATE) AS first FROM orders)
  WHERE rate > 0
),
dim_vendor AS (
  SELECT k AS vendor_sk, 'V' || lpad(CAST(k AS VARCHAR), 5, '0') AS vendor_id, p_brand || ' Supply Co' AS vendor_name,
         {pick(("Manufacturer", "Distributor", "Wholesaler"), ['k'], 'vtype')} AS vendor_type,
         CAST({bnd(['k'], 'rating', 1, 5)} AS BIGINT) AS vendor_scorecard_rating, CAST({bnd(['k'], 'lead', 3, 44)} AS BIGINT) AS avg_lead_time_days,
         {pick(("Net 30", "Net 45", "Net 60"), ['k'], 'terms')} AS payment_terms,
         CAST(TIMESTAMP '1900-01-01' AS TIMESTAMP) AS effective_start_ts, CAST(NULL AS TIMESTAMP) AS effective_end_ts, true AS is_current,
         CAST(1 AS BIGINT) AS version
  FROM (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS k FROM part)
),
dim_employee AS (
  SELECT e AS employee_sk, 'E' || lpad(CAST(e AS VARCHAR), 8, '0') AS employee_id,
         CASE WHEN k = 1 THEN 'Store Manager' ELSE {pick(("Sales Associate", "Cashier", "Stock Associate"), ['e'], 'role')} END AS role,
         store_sk, CASE WHEN k > 1 THEN store_sk * 100 + 1 END AS manager_employee_sk, 'Active' AS status,
         CAST(TIMESTAMP '1900-01-01' AS TIMESTAMP) AS effective_start_ts, CAST(NULL AS TIMESTAMP) AS effective_end_ts, true AS is_current,
         CAST(1 AS BIGINT) AS version
  FROM (SELECT store_sk, k, CAST(store_sk * 100 + k AS BIGINT) AS e FROM dim_store, (SELECT unnest(generate_series(1, {STORE_STAFF})) AS k))
)"""

SALES = f"""
lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
           l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
           l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS INTEGER) AS line_number
  FROM lineitem
),
sales0 AS (
  SELECT CAST(l_orderkey AS BIGINT) AS transaction_id, line_number, CAST(l_linenumber AS BIGINT) AS source_line,
         {sk('o_orderdate')} AS date_sk,
         CAST(l_partkey AS BIGINT) AS product_sk, CAST(l_suppkey AS BIGINT) AS store_sk,
         CAST(o_custkey AS BIGINT) AS customer_sk,
         CAST(l_suppkey * 100 + {bnd(['l_orderkey', 'l_suppkey'], 'emp', 1, STORE_STAFF)} AS BIGINT) AS employee_sk,
         CASE WHEN CAST(l_discount AS DECIMAL(4,2)) > 0 THEN CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT) END
           AS promotion_sk,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_sk,
         CAST(l_quantity AS INTEGER) AS quantity,
         p.list_price AS unit_price, p.standard_cost AS unit_cost,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_sales_amount,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
           AS discount_amount,
         CAST(l_tax AS DECIMAL(4,2)) AS _tax_rate,
         CAST(l_shipdate AS DATE) AS ship_date,
         {pick(TENDERS, ['l_orderkey'], 'tender')} AS tender_type
  FROM lines JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN dim_product p ON l_partkey = p.product_sk
),
sales1 AS (
  SELECT *, CAST(gross_sales_amount - discount_amount AS DECIMAL(18,2)) AS net_sales_amount,
         CAST(quantity * unit_cost AS DECIMAL(18,2)) AS cogs_amount
  FROM sales0
),
fact_sales_line AS (
  SELECT transaction_id, line_number, 'RCPT-' || CAST(transaction_id AS VARCHAR) AS receipt_id,
         date_sk, product_sk, store_sk, customer_sk, employee_sk, promotion_sk, channel_sk, quantity,
         unit_price, unit_cost, gross_sales_amount, discount_amount, net_sales_amount,
         CAST(round(net_sales_amount * _tax_rate, 2) AS DECIMAL(18,2)) AS tax_amount,
         cogs_amount, CAST(net_sales_amount - cogs_amount AS DECIMAL(18,2)) AS gross_margin_amount,
         CAST(floor(net_sales_amount) AS BIGINT) AS loyalty_points_earned,
         false AS is_return, channel_sk = 4 AS is_marketplace, tender_type, ship_date, source_line
  FROM sales1
)"""

_MOV_TYPES = [t for t, _ in MOVEMENT_TYPES]
_MOV_W = [w for _, w in MOVEMENT_TYPES]
MOVEMENT = f"""
mov0 AS (
  SELECT s.*, {weighted(u(LINE_KEY, 'mtype'), _MOV_TYPES, _MOV_W)} AS movement_type
  FROM fact_sales_line s
),
fact_inventory_movement AS (
  SELECT {id128(['transaction_id', 'line_number'], 'mov')} AS movement_id, {sk('ship_date')} AS date_sk,
         m.product_sk, store_sk,
         CASE WHEN movement_type IN ('Receipt', 'Return-to-Vendor') THEN p.primary_vendor_sk END AS vendor_sk,
         movement_type,
         CAST(CASE WHEN movement_type IN ('Shrink', 'Return-to-Vendor') THEN -quantity ELSE quantity END AS INTEGER)
           AS quantity,
         unit_cost,
         'MOV-' || CAST(transaction_id AS VARCHAR) || '-' || CAST(line_number AS VARCHAR) AS reference_doc_id,
         {pick(REASON_CODES, ['transaction_id', 'source_line', 'm.product_sk', 'store_sk'], 'reason')} AS reason_code
  FROM mov0 m LEFT JOIN dim_product p ON m.product_sk = p.product_sk
)"""

WEB = f"""
ev AS (
  SELECT *, CAST(ts AS DATE) AS _day,
         CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS INTEGER) AS event_number
  FROM events
),
fact_web_events AS (
  SELECT {id128(['user_id', '_day'], 'session')} AS session_id,
         event_number,
         {sk('_day')} AS date_sk,
         CASE WHEN c.c_custkey IS NOT NULL AND {u(['user_id', '_day'], 'anon')} >= 0.35
              THEN CAST(user_id AS BIGINT) END AS customer_sk,
         CASE WHEN event_type IN ('view', 'click', 'purchase')
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_sk,
         CAST(CASE WHEN {u(['user_id', '_day'], 'chan')} < 0.6 THEN 2 ELSE 3 END AS BIGINT) AS channel_sk,
         ts AS event_ts, event_type, CAST(NULL AS VARCHAR) AS search_term,
         {pick(DEVICES, ['user_id', '_day'], 'device')} AS device_type,
         {pick(REFERRERS, ['user_id', '_day'], 'ref')} AS referrer,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS cart_value
  FROM ev LEFT JOIN customer c ON c.c_custkey = ev.user_id
)"""

STAR_CTES = [DIM_DATE_FULL, DIMS, SALES, MOVEMENT, WEB]


def with_star(*extra: str) -> str:
    """``WITH`` clause holding the star mapping plus any extra CTEs."""
    return "WITH " + ",\n".join(s.strip() for s in [*STAR_CTES, *extra])
