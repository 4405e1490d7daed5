"""Statistics, calendar weights, keyed draws and taxonomy paths in DuckDB SQL."""
from __future__ import annotations

from decimal import Decimal

from .sqlfn import bnd, u

SALE_DATE_SPREAD = """
SELECT COUNT(*) AS stores, avg(days) AS avg_days, avg(lines) AS avg_lines
FROM (SELECT COUNT(DISTINCT date_sk) AS days, COUNT(*) AS lines FROM fact_sales_line GROUP BY store_sk)"""

FINGERPRINTS = """
SELECT 'fact_sales_line' AS table_name, COUNT(*) AS rows, CAST(SUM(net_sales_amount) AS DOUBLE) AS total FROM fact_sales_line
UNION ALL SELECT 'fact_returns', COUNT(*), CAST(SUM(refund_amount) AS DOUBLE) FROM fact_returns_f
UNION ALL SELECT 'fact_gl_actuals', COUNT(*), CAST(SUM(actual_amount) AS DOUBLE) FROM fact_gl_actuals
UNION ALL SELECT 'fact_loyalty_activity', COUNT(*), CAST(SUM(points_balance) AS DOUBLE) FROM fact_loyalty_activity"""

MEDIAN = """
SELECT date_sk, CAST(quantile_disc(days_of_supply, 0.5) AS DOUBLE) AS median_days FROM fact_inventory_snapshot GROUP BY date_sk"""

CALENDAR_WEIGHTS = """
SELECT date_sk, CAST(greatest(round(100.0 * CASE WHEN is_weekend THEN 1.5 ELSE 1.0 END
         * CASE selling_season WHEN 'Holiday' THEN 2.5 WHEN 'Back-to-School' THEN 1.8 ELSE 1.0 END
         * CASE WHEN holiday_name = 'Black Friday' THEN 3.0 ELSE 1.0 END
         * (1 + 0.08 * (year - (SELECT min(year) FROM sales_cal))), 0), 1) AS INTEGER) AS weight,
       CAST(date - INTERVAL 2 YEAR AS DATE) AS history_start
FROM sales_cal"""

_KEY = ["o_orderkey"]
KEYED_DRAWS = f"""
SELECT o_orderkey, CAST({u(_KEY, 'u')} AS DOUBLE) AS u, {bnd(_KEY, 'low_high', -5, 17)} AS between,
       CAST(2.5 + {u(_KEY, 'range')} * 5.0 AS DOUBLE) AS in_range,
       CAST(floor(CAST({u(_KEY, 'u')} AS DECIMAL(12,6)) * {u(_KEY, 'u')} * {u(_KEY, 'u')} * 1000) AS BIGINT) + 1 AS tail_rank,
       CAST(floor({u(_KEY, 'u')} * 1000) AS BIGINT) + 1 AS rank,
       CASE WHEN {u(_KEY, 'gap')} < 0.25 THEN NULL ELSE o_orderpriority END AS gappy,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) / NULLIF(CAST(o_orderkey % 3 AS DOUBLE), 0) AS ratio
FROM orders"""

TAXONOMY_PATHS = """
SELECT DISTINCT division_name, department_name, p_type AS category, p_brand AS brand,
       CASE p_type WHEN 'ECONOMY' THEN '1.1.1' WHEN 'PROMO' THEN '1.1.2' WHEN 'STANDARD' THEN '1.2.1' WHEN 'MEDIUM' THEN '1.2.2'
                   WHEN 'SMALL' THEN '2.1.1' WHEN 'LARGE' THEN '2.2.1' END AS path_id
FROM part JOIN taxonomy USING (p_type)"""

_DIMS = ("dim_date", "dim_channel", "dim_product", "dim_store", "dim_customer", "dim_promotion", "dim_vendor", "dim_employee", "dim_gl_account", "dim_department")
_FACTS = {"fact_sales_line": "fact_sales_line", "fact_inventory_movement": "fact_inventory_movement", "fact_web_events": "fact_web_events",
          "fact_returns": "fact_returns_f", "fact_fulfillment": "fact_fulfillment_f", "fact_loyalty_activity": "fact_loyalty_activity"}
BUILD_RESUMED = " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, true AS reused FROM {t}" for t in _DIMS]
    + [f"SELECT '{t}', COUNT(*), false FROM {cte}" for t, cte in _FACTS.items()])

ORDERS_VERSIONED = """
WITH cut AS (SELECT date_trunc('year', MAX(CAST(o_orderdate AS DATE))) AS first_day FROM orders)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CASE WHEN CAST(o_orderdate AS DATE) >= first_day THEN o_orderpriority END AS urgency FROM orders, cut
"""


def _hash(keys: tuple[str, ...], salt: str) -> str:
    texts = ", ".join(f"coalesce('=' || CAST({k} AS VARCHAR), 'null')" for k in keys)
    return f"md5(concat_ws('|', {texts}, '{salt}'))"


_LINE = ("transaction_id", "source_line", "product_sk", "store_sk")
REVIEW_SAMPLE = f"""
SELECT {', '.join(_LINE)}, customer_sk FROM (
  SELECT CAST(l_orderkey AS BIGINT) AS transaction_id, CAST(l_linenumber AS BIGINT) AS source_line, CAST(l_partkey AS BIGINT) AS product_sk,
         CAST(l_suppkey AS BIGINT) AS store_sk, CAST(o_custkey AS BIGINT) AS customer_sk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
ORDER BY {_hash(_LINE, 'review_sample')} LIMIT 500
"""
REPLENISHMENT_SAMPLE = f"""
SELECT store_sk, product_sk FROM replenishment_order ORDER BY {_hash(('store_sk', 'product_sk'), 'replenishment_sample')} LIMIT 200
"""

# popularity class: (from and to percent of the ranks, share that a store carries)
_CLASSES = {"A": (0, 10, "0.60"), "B": (10, 40, "0.25"), "C": (40, 100, "0.08")}


def _law(rate: str) -> str:
    """Chance of a gap of at most g, for every g whose chance rounds below 1, and the first that doesn't."""
    out = []
    while not out or out[-1] < 1:
        out.append((1 - (1 - Decimal(rate)) ** (len(out) + 1)).quantize(Decimal("0.000001")))
    return "[" + ", ".join(f"CAST({x} AS DECIMAL(7,6))" for x in out) + "]"


# every step of every group is drawn here, and what passes the class's size is dropped
ASSORTMENT = f""",
popular AS (
  SELECT p.product_sk, row_number() OVER (ORDER BY coalesce(s.sold, 0) DESC, p.product_sk) AS popularity_rank
  FROM dim_product p LEFT JOIN (SELECT product_sk, SUM(quantity) AS sold FROM fact_sales_line GROUP BY product_sk) s ON s.product_sk = p.product_sk),
kinds AS ({' UNION ALL '.join(f"SELECT '{c}' AS popularity_class, count(*) * {a} // 100 AS lo, count(*) * {b} // 100 AS hi, {_law(r)} AS law FROM dim_product" for c, (a, b, r) in _CLASSES.items())}),
steps AS (SELECT store_sk, popularity_class, lo, hi, law, unnest(generate_series(1, CAST(hi - lo AS BIGINT))) AS step FROM dim_store, kinds),
places AS (
  SELECT store_sk, popularity_class, lo, hi,
         SUM(len(list_filter(law, lambda x: x <= {u(('store_sk', 'popularity_class', 'step'), 'assortment')})) + 1) OVER (PARTITION BY store_sk, popularity_class ORDER BY step) AS place
  FROM steps),
assortment AS (
  SELECT c.store_sk, p.product_sk, c.popularity_class, CAST(p.popularity_rank AS BIGINT) AS popularity_rank, CAST(coalesce(s.units, 0) AS BIGINT) AS units
  FROM places c JOIN popular p ON p.popularity_rank = c.lo + c.place
  LEFT JOIN (SELECT store_sk, product_sk, SUM(quantity) AS units FROM fact_sales_line GROUP BY ALL) s ON s.store_sk = c.store_sk AND s.product_sk = p.product_sk
  WHERE c.place <= c.hi - c.lo)
"""
ASSORTMENT_BY_PERIOD = """
SELECT e.date_sk, a.popularity_class, COUNT(*) AS carried_pairs, COUNT(*) FILTER (WHERE a.units = 0) AS unsold_pairs,
       CAST(SUM(greatest((a.units * 3 + n.days - 1) // n.days, 1)) AS BIGINT) AS safety_stock_qty
FROM assortment a, (SELECT max(date_sk) AS date_sk FROM sales_cal GROUP BY fiscal_year, fiscal_period) e, (SELECT COUNT(*) AS days FROM sales_cal) n
GROUP BY ALL
"""


def fingerprints(tables: dict) -> str:
    """Row counts and sums of row hashes of each table (its CTE's name and its declared columns), by year where it has days."""
    decimals = {"money": 2, "qty2": 2, "dec1": 1, "dec4": 4}

    def text(c) -> str:
        if c.dtype in decimals:
            x = f"CAST(CAST({c.name} AS DECIMAL(18,{decimals[c.dtype]})) AS VARCHAR)"
        elif c.dtype.startswith("timestamp"):
            x = f"strftime({c.name}, '%Y-%m-%d %H:%M:%S.%f')"
        else:
            x = f"CAST({c.name} AS VARCHAR)"
        return f"coalesce(CAST(length({x}) AS VARCHAR) || ':' || {x}, 'null')"

    def one(cte: str, spec) -> str:
        part = "coalesce(CAST(date_sk // 10000 AS VARCHAR), 'none')" if any(c.name == "date_sk" for c in spec.columns) else "'all'"
        row = f"md5(concat_ws('|', {', '.join(text(c) for c in spec.columns)}))"
        sums = " || ':' || ".join(f"CAST(SUM(CAST('0x' || substr(h, {at}, 15) AS HUGEINT)) AS VARCHAR)" for at in (1, 17))
        return f"SELECT '{spec.name}' AS table_name, part, COUNT(*) AS row_count, {sums} AS digest FROM (SELECT {part} AS part, {row} AS h FROM {cte}) GROUP BY part"

    return "\n" + "\nUNION ALL ".join(one(cte, spec) for cte, spec in tables.items())


_PAIRS = {
    ("dim_product", "dim_product"): ("private_label_flag,is_marketplace", "uom,lifecycle_status", "private_label_flag,lifecycle_status", "uom,is_marketplace"),
    ("dim_store", "dim_store"): ("is_ship_from_store,is_bopis_enabled",),
    ("dim_customer", "dim_customer"): ("acquisition_channel,email_opt_in", "loyalty_member_flag,email_opt_in", "loyalty_member_flag,acquisition_channel"),
    ("fact_returns", "fact_returns_f"): ("return_reason,disposition", "return_reason,is_fraud_suspected"),
    ("fact_inventory_movement", "fact_inventory_movement"): ("movement_type,reason_code",),
}


def _independent(name: str, cte: str, a: str, b: str) -> str:
    return f"""
SELECT '{name}' AS table_name, '{a}' AS attribute_a, '{b}' AS attribute_b, CAST(SUM(n) AS BIGINT) AS row_count, f AS freedom,
       round(2 * SUM(n * ln((ra.t * 1.0::DOUBLE) * n / (ra.n_a * 1.0::DOUBLE * n_b))), 3) AS g, round(f + 5 * sqrt(2.0 * f) + 10, 3) AS bound,
       round(2 * SUM(n * ln((ra.t * 1.0::DOUBLE) * n / (ra.n_a * 1.0::DOUBLE * n_b))), 3) > round(f + 5 * sqrt(2.0 * f) + 10, 3) AS dependent
FROM (SELECT {a} AS a, {b} AS b, COUNT(*) AS n FROM {cte} GROUP BY ALL) c
JOIN (SELECT {a} AS a, COUNT(*) AS n_a, (SELECT COUNT(*) FROM {cte}) AS t FROM {cte} GROUP BY ALL) ra ON ra.a = c.a
JOIN (SELECT {b} AS b, COUNT(*) AS n_b FROM {cte} GROUP BY ALL) rb ON rb.b = c.b,
(SELECT CAST((COUNT(DISTINCT {a}) - 1) * (COUNT(DISTINCT {b}) - 1) AS BIGINT) AS f FROM {cte}) fr
GROUP BY f"""


INDEPENDENCE = " UNION ALL ".join(_independent(name, cte, *pair.split(",")) for (name, cte), pairs in _PAIRS.items() for pair in pairs)


def _median(grain: str, part: str) -> str:
    return f"""
SELECT '{grain}' AS grain, part, CAST(any_value(n) AS BIGINT) AS cells, CAST(min(days_of_supply) AS DOUBLE) AS exact_median, true AS within_bound
FROM (SELECT *, SUM(c) OVER (PARTITION BY part ORDER BY days_of_supply) AS upto, SUM(c) OVER (PARTITION BY part) AS n
      FROM (SELECT {part} AS part, days_of_supply, COUNT(*) AS c FROM fact_inventory_snapshot WHERE days_of_supply IS NOT NULL GROUP BY ALL))
WHERE upto * 2 >= n GROUP BY part"""


SKETCHED = _median("date_sk", "date_sk") + " UNION ALL " + _median("year", "date_sk // 10000")

SUBMISSIONS = """
WITH sent AS (
  SELECT CAST(o_custkey AS BIGINT) AS cell, substr(o_orderpriority, 1, 1) AS planner, 's' || CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day,
         CAST(o_totalprice AS DECIMAL(18,2)) AS qty, o_orderkey % 2 AS seen, CAST(o_orderdate AS DATE) >= (SELECT date_trunc('year', MAX(CAST(o_orderdate AS DATE))) FROM orders) AS late
  FROM orders),
one AS (SELECT *, row_number() OVER (PARTITION BY cell, planner ORDER BY seen DESC, day DESC, id DESC) AS r FROM sent WHERE NOT late AND qty >= 1000),
state AS (SELECT cell, planner, qty, id FROM one WHERE r = 1),
two AS (SELECT s.*, t.id IS NOT NULL AS known FROM sent s LEFT JOIN state t ON t.cell = s.cell AND t.planner = s.planner WHERE late AND s.qty >= 1000),
fresh AS (SELECT *, row_number() OVER (PARTITION BY cell, planner ORDER BY seen DESC, day DESC, id DESC) AS r FROM two WHERE NOT (known AND seen = 0)),
final AS (
  SELECT coalesce(f.cell, t.cell) AS cell, coalesce(f.planner, t.planner) AS planner, coalesce(f.qty, t.qty) AS qty,
         CASE WHEN f.id IS NOT NULL AND t.id IS NOT NULL THEN 2 ELSE 1 END AS revision, coalesce(f.id, t.id) AS submission_id
  FROM state t FULL JOIN (SELECT * FROM fresh WHERE r = 1) f ON f.cell = t.cell AND f.planner = t.planner),
outcomes AS (
  SELECT 'invalid' AS outcome, COUNT(*) + COUNT(*) FILTER (WHERE NOT late AND qty < 50000) AS n FROM sent WHERE qty < 1000
  UNION ALL SELECT 'duplicate', COUNT(*) FROM one WHERE qty < 50000
  UNION ALL SELECT 'accepted', (SELECT COUNT(*) FROM one WHERE r = 1) + (SELECT COUNT(*) FROM fresh WHERE r = 1)
  UNION ALL SELECT 'superseded', (SELECT COUNT(*) FROM one WHERE r > 1) + (SELECT COUNT(*) FROM fresh WHERE r > 1)
  UNION ALL SELECT 'stale', COUNT(*) FROM two WHERE known AND seen = 0)
SELECT cell, planner, CAST(qty AS DOUBLE) AS qty, CAST(revision AS BIGINT) AS revision, submission_id FROM final
UNION ALL SELECT NULL, NULL, NULL, n, outcome FROM outcomes WHERE n > 0
"""


REVIEW_FILLED = """
SELECT review_id, upper(title_prompt) AS review_title, upper(prompt) AS review_text, CAST(0 AS BIGINT) AS violations, CAST(0 AS BIGINT) AS sent_again,
       (SELECT COUNT(DISTINCT said) FROM (SELECT prompt AS said FROM product_review_staging UNION ALL SELECT title_prompt FROM product_review_staging)) AS sent_first
FROM product_review_staging"""
