"""The registered queries in plain SQL for DuckDB, as independent checks."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"


def quotient(numerator: str, scale: int, denominator: str, digits: int, precision: int) -> str:
    """Exact decimal division rounded half up, for a numerator with ``scale`` digits.

    DuckDB divides decimals as doubles, so the quotient is taken on integers.
    """
    top = f"CAST(({numerator}) * {10 ** scale} AS HUGEINT) * {10 ** (digits - scale)}"
    whole = f"((2 * ({top}) + ({denominator})) // (2 * ({denominator})))"
    unit = f"CAST('{10 ** -digits:.{digits}f}' AS DECIMAL({digits},{digits}))"
    width = min(precision, 38 - digits)
    value = f"CAST({whole} AS DECIMAL({width},0)) * {unit}"
    return f"CAST(CASE WHEN ({denominator}) = 0 THEN NULL ELSE {value} END AS DECIMAL({precision},{digits}))"


def average(column: str, scale: int, precision: int, digits: int = 6) -> str:
    total = f"SUM({column})"
    return quotient(total, scale, f"COUNT({column})", digits, precision)


# Named parts; each may use the ones it mentions.
PARTS: dict[str, str] = {}

PARTS["sale_lines"] = """
SELECT l.*, o_custkey, o_orderpriority,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CAST(l_quantity AS INTEGER) AS units,
       CAST(l_discount AS DECIMAL(4,2)) AS rate,
       CAST(l_tax AS DECIMAL(4,2)) AS tax
FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
"""

PARTS["pos"] = """
SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS store_id,
       CAST(units AS VARCHAR) AS quantity,
       CAST(price AS VARCHAR) AS unit_price,
       CAST(CAST(units * price * rate AS DECIMAL(10,2)) AS VARCHAR) AS discount_amount,
       CAST(l_shipdate AS VARCHAR) AS transaction_time
FROM sale_lines
"""

PARTS["flawed"] = """
SELECT CASE WHEN tax = 0.08 AND rate = 0.10 THEN NULL WHEN tax = 0.08 AND rate = 0.09 THEN '  '
            ELSE l_orderkey || '-' || l_linenumber END AS transaction_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            WHEN tax = 0.01 AND rate = 0.10 THEN ' null '
            WHEN tax = 0.01 AND rate = 0.09 THEN ' ' ELSE o_custkey || ' ' END AS customer_id,
       CASE WHEN tax = 0.07 AND rate = 0.10 THEN 'Null' WHEN tax = 0.07 AND rate = 0.09 THEN ''
            ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
       CASE WHEN tax = 0.02 AND rate = 0.10 THEN NULL WHEN tax = 0.02 AND rate = 0.09 THEN ' '
            ELSE CAST(l_suppkey AS VARCHAR) END AS store_id,
       CASE WHEN tax = 0.06 AND rate = 0.10 THEN '0' WHEN tax = 0.06 AND rate = 0.09 THEN '-1'
            WHEN tax = 0.05 AND rate = 0.10 THEN 'abc' WHEN tax = 0.05 AND rate = 0.09 THEN NULL
            WHEN tax = 0.06 AND rate = 0.08 THEN ' '
            ELSE CAST(units AS VARCHAR) END AS quantity,
       CASE WHEN tax = 0.04 AND rate = 0.10 THEN '-0.01'
            WHEN tax = 0.04 AND rate = 0.09 THEN '0.00' WHEN tax = 0.04 AND rate = 0.08 THEN ''
            ELSE CAST(price AS VARCHAR) END AS unit_price,
       CASE WHEN rate = 0.00 THEN NULL
            ELSE CAST(CAST(units * price * rate AS DECIMAL(10,2)) AS VARCHAR) END AS discount_amount,
       CASE WHEN tax = 0.03 AND rate = 0.10 THEN '2026-13-01'
            WHEN tax = 0.03 AND rate = 0.09 THEN NULL WHEN tax = 0.03 AND rate = 0.08 THEN '  '
            ELSE CAST(l_shipdate AS VARCHAR) END AS transaction_time
FROM sale_lines
"""

_SALE_TYPES = """
       TRY_CAST(quantity AS INTEGER) AS quantity,
       TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
       TRY_CAST(discount_amount AS DECIMAL(10,2)) AS discount_amount,
       TRY_CAST(transaction_time AS TIMESTAMP) AS transaction_time
"""
_IDS = "transaction_id, customer_id, product_id, store_id"

PARTS["typed"] = f"SELECT {_IDS}, {_SALE_TYPES} FROM pos"
PARTS["flawed_typed"] = f"SELECT {_IDS}, {_SALE_TYPES} FROM flawed"


def _clean(name: str) -> str:
    return f"CASE WHEN upper(trim({name})) NOT IN ('NULL', '') THEN trim({name}) END"


_POS_COLUMNS = (
    "transaction_id customer_id product_id store_id quantity unit_price"
    " discount_amount transaction_time"
).split()

# The raw row is kept beside its cleansed values.
PARTS["cleansed"] = (
    "SELECT "
    + ", ".join(f"{_clean(c)} AS {c}, {c} AS raw_{c}" for c in _POS_COLUMNS)
    + " FROM flawed"
)


def derived(rows: str, columns: str = _IDS) -> str:
    return f"""
    SELECT {columns}, quantity, unit_price, discount_amount, transaction_time,
           CAST(transaction_time AS DATE) AS transaction_date,
           CAST(quantity * unit_price AS DECIMAL(21,2)) AS subtotal,
           CAST(quantity * unit_price - COALESCE(discount_amount, 0) AS DECIMAL(22,2)) AS net_amount,
           CAST(year(transaction_time) AS INTEGER) AS transaction_year,
           CAST(month(transaction_time) AS INTEGER) AS transaction_month,
           CAST(day(transaction_time) AS INTEGER) AS transaction_day,
           CAST(dayofweek(transaction_time) + 1 AS INTEGER) AS transaction_weekday,
           strftime(transaction_time, '%Y-%m') AS year_month
    FROM {rows}
    """


PARTS["derived"] = derived("typed")

PARTS["products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category_id,
       CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, p_brand AS brand
FROM part
"""
PARTS["categories"] = """
SELECT DISTINCT p_type AS category_id, 'Category ' || lower(p_type) AS category_name,
       'ALL' AS parent_category_id
FROM part
"""
PARTS["customers"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       lower(c_name) || '@example.com' AS email,
       '090' || c_nationkey || c_custkey AS phone,
       CASE WHEN c_acctbal < 0 THEN NULL
            ELSE CAST((1950 + c_nationkey) || '-01-15' AS DATE) END AS birth_date,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE 'f' END AS gender,
       c_mktsegment AS segment
FROM customer
"""
PARTS["stores"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, r_name AS region,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE DATE '1990-06-01' END AS open_date
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
"""
PARTS["calendar"] = """
SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS VARCHAR) AS day_of_week,
       CAST(CASE WHEN month(d) < 4 THEN year(d) - 1 ELSE year(d) END AS INTEGER) AS fiscal_year,
       month(d) >= 11 AS is_retail_peak
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
"""

# Masters with gaps.
PARTS["some_products"] = "SELECT * FROM products WHERE brand <> 'Brand#7'"
PARTS["some_categories"] = "SELECT * FROM categories WHERE category_id <> 'PROMO'"
PARTS["some_customers"] = "SELECT * FROM customers WHERE segment <> 'MACHINERY'"
PARTS["some_stores"] = "SELECT * FROM stores WHERE region <> 'ASIA'"

def enriched(rows: str, prefix: str = "") -> str:
    """Left joins with all masters and the fact's money columns."""
    percent = (
        "CASE WHEN subtotal = 0 THEN NULL ELSE CAST("
        "CAST((2 * CAST(d.discount_amount * 100 AS HUGEINT) * 10000"
        " + CAST(subtotal * 100 AS HUGEINT))"
        " // (2 * CAST(subtotal * 100 AS HUGEINT)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(5,2)) END"
    )
    return f"""
    SELECT d.transaction_id, d.transaction_time, d.transaction_date,
           d.product_id, p.product_name, p.category_id, g.category_name,
           d.customer_id, c.customer_name, d.store_id, s.store_name, s.region AS store_region,
           d.quantity, CAST(d.unit_price AS DECIMAL(18,2)) AS unit_price,
           CAST(d.subtotal AS DECIMAL(18,2)) AS amount,
           CAST(d.discount_amount AS DECIMAL(18,2)) AS discount_amount,
           {percent} AS discount_percentage,
           CAST(d.net_amount AS DECIMAL(18,2)) AS sales_amount,
           d.transaction_year, d.transaction_month, d.transaction_day, d.transaction_weekday,
           d.year_month, t.fiscal_year, t.is_retail_peak,
           concat_ws(',',
             CASE WHEN p.product_id IS NULL AND d.product_id IS NOT NULL THEN 'E006:product_id' END,
             CASE WHEN c.customer_id IS NULL AND d.customer_id IS NOT NULL
                  THEN 'E006:customer_id' END,
             CASE WHEN s.store_id IS NULL AND d.store_id IS NOT NULL THEN 'E006:store_id' END
           ) AS missing_masters
    FROM {rows} d
    LEFT JOIN {prefix}products p ON p.product_id = d.product_id
    LEFT JOIN {prefix}categories g ON g.category_id = p.category_id
    LEFT JOIN {prefix}customers c ON c.customer_id = d.customer_id
    LEFT JOIN {prefix}stores s ON s.store_id = d.store_id
    LEFT JOIN calendar t ON t.date = d.transaction_date
    """


PARTS["fact"] = enriched("derived")

# Rule names in order of precedence.
_RULES = {
    "R1_ID_MISSING": "transaction_id IS NULL",
    "R2_PRODUCT_MISSING": "product_id IS NULL",
    "R3_QUANTITY_NOT_POSITIVE": "TRY_CAST(quantity AS INTEGER) <= 0",
    "R4_PRICE_NEGATIVE": "TRY_CAST(unit_price AS DECIMAL(10,2)) < 0",
    "R5_TIME_IN_FUTURE": f"TRY_CAST(transaction_time AS TIMESTAMP) > {AS_OF}",
    "R6_DUPLICATE_ID": "transaction_id IS NOT NULL AND copy > 1",
    "R7_STORE_MISSING": "store_id IS NULL",
    "R8_QUANTITY_MISSING": "quantity IS NULL",
    "R9_PRICE_MISSING": "unit_price IS NULL",
    "R10_TIME_MISSING": "transaction_time IS NULL",
    "R11_QUANTITY_UNREADABLE": "quantity IS NOT NULL AND TRY_CAST(quantity AS INTEGER) IS NULL",
    "R12_PRICE_UNREADABLE": (
        "unit_price IS NOT NULL AND TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL"
    ),
    "R13_TIME_UNREADABLE": (
        "transaction_time IS NOT NULL AND TRY_CAST(transaction_time AS TIMESTAMP) IS NULL"
    ),
}


def _reasons(but: str | None = None) -> str:
    cases = [f"CASE WHEN {c} THEN '{r}' END" for r, c in _RULES.items() if r != but]
    return f"concat_ws(',', {', '.join(cases)})"


_RAW_ORDER = ", ".join(f"raw_{c} NULLS FIRST" for c in _POS_COLUMNS)
_VALUE_ORDER = """
customer_id NULLS FIRST, product_id NULLS FIRST, store_id NULLS FIRST,
TRY_CAST(quantity AS INTEGER) NULLS FIRST, TRY_CAST(unit_price AS DECIMAL(10,2)) NULLS FIRST,
TRY_CAST(discount_amount AS DECIMAL(10,2)) NULLS FIRST"""


def judged(rows: str) -> str:
    return f"""
    SELECT *, {_reasons()} AS reasons
    FROM (
      SELECT *, row_number() OVER (
        PARTITION BY transaction_id
        ORDER BY faults <> '', TRY_CAST(transaction_time AS TIMESTAMP) NULLS FIRST,
                 {_VALUE_ORDER}, {_RAW_ORDER}
      ) AS copy
      FROM (SELECT *, {_reasons("R6_DUPLICATE_ID")} AS faults FROM {rows})
    )
    """


PARTS["judged"] = judged("cleansed")
PARTS["accepted_text"] = "SELECT * FROM judged WHERE reasons = ''"
PARTS["accepted_typed"] = f"SELECT {_IDS}, {_SALE_TYPES} FROM accepted_text"
PARTS["accepted_derived"] = derived("accepted_typed")
PARTS["accepted_fact"] = enriched("accepted_derived", "some_")


# Usable sales in the order of their arrival, the newest first.
PARTS["arrived"] = """
SELECT transaction_id, TRY_CAST(transaction_time AS TIMESTAMP) AS sold,
       CASE WHEN raw_transaction_time >= '1999' THEN '2001-08-01'
            WHEN coalesce(length(raw_quantity), 0) > 1 THEN '2001-08-02' ELSE '2001-08-03' END AS _job_date
FROM judged WHERE faults = ''
"""

# Two days: sales of one before 1998, all others on the other. The first is run without
# discounted sales, then the second, then the first again with all its sales. An id that the
# other day has accepted by then is rejected.
EARLY = "coalesce(raw_transaction_time < '1998', false)"
PARTS["some_first"] = judged(f"(SELECT * FROM cleansed WHERE {EARLY} AND raw_discount_amount IS NULL)")
PARTS["second_judged"] = judged(f"(SELECT * FROM cleansed WHERE NOT {EARLY})")
PARTS["first_judged"] = judged(f"(SELECT * FROM cleansed WHERE {EARLY})")
PARTS["second_text"] = """
SELECT * FROM second_judged WHERE reasons = ''
  AND transaction_id NOT IN (SELECT transaction_id FROM some_first WHERE reasons = '')
"""
PARTS["first_text"] = """
SELECT * FROM first_judged WHERE reasons = ''
  AND transaction_id NOT IN (SELECT transaction_id FROM second_text)
"""
PARTS["days_text"] = "SELECT * FROM first_text UNION ALL SELECT * FROM second_text"
PARTS["days_typed"] = f"SELECT {_IDS}, {_SALE_TYPES} FROM days_text"
PARTS["days_derived"] = derived("days_typed")
PARTS["days_fact"] = enriched("days_derived", "some_")

# The same two days run once each. Sales of the first that lacked a checked master row are joined with
# all masters later; the others keep what they have, so theirs is the category the first day knew.
PARTS["once_text"] = f"""
SELECT *, {EARLY} AS early FROM (
  SELECT * FROM first_judged WHERE reasons = '' UNION ALL
  SELECT * FROM second_judged WHERE reasons = ''
    AND transaction_id NOT IN (SELECT transaction_id FROM first_judged WHERE reasons = ''))
"""
PARTS["once_typed"] = f"SELECT {_IDS}, {_SALE_TYPES} FROM once_text"
PARTS["once_derived"] = derived("once_typed")
PARTS["once_some"] = enriched("once_derived", "some_")
PARTS["once_all"] = enriched("once_derived")
PARTS["late_fact"] = """
SELECT * FROM once_some WHERE missing_masters = '' AND transaction_time < TIMESTAMP '1998-01-01'
UNION ALL SELECT a.* FROM once_all a JOIN once_some s USING (transaction_id)
WHERE s.missing_masters <> '' OR s.transaction_time >= TIMESTAMP '1998-01-01'
"""


def daily(fact: str) -> str:
    return f"""
    SELECT transaction_date, COUNT(DISTINCT transaction_id) AS transaction_count,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity,
           CAST(SUM(amount) AS DECIMAL(28,2)) AS total_sales,
           CAST(SUM(discount_amount) AS DECIMAL(28,2)) AS total_discount,
           {average("amount", 2, 22)} AS avg_transaction_value,
           AVG(quantity) AS avg_items_per_transaction,
           {average("discount_percentage", 2, 9)} AS avg_discount_rate,
           COUNT(DISTINCT customer_id) AS unique_customers,
           COUNT(DISTINCT product_id) AS unique_products_sold
    FROM {fact} GROUP BY transaction_date
    """


def customer_sql(fact: str) -> str:
    return f"""
    SELECT *, CASE WHEN customer_tenure_days > 0
                   THEN CAST(total_transactions AS DOUBLE) / customer_tenure_days
                   ELSE CAST(total_transactions AS DOUBLE) END AS purchase_frequency
    FROM (
      SELECT customer_id, COUNT(DISTINCT transaction_id) AS total_transactions,
             COUNT(DISTINCT transaction_date) AS purchase_days,
             CAST(SUM(amount) AS DECIMAL(28,2)) AS lifetime_value,
             {average("amount", 2, 22)} AS avg_transaction_value,
             CAST(SUM(quantity) AS BIGINT) AS total_items_purchased,
             COUNT(DISTINCT product_id) AS unique_products_purchased,
             MIN(transaction_date) AS first_purchase_date,
             MAX(transaction_date) AS last_purchase_date,
             CAST(date_diff('day', MIN(transaction_date), MAX(transaction_date)) AS INTEGER)
               AS customer_tenure_days
      FROM {fact} GROUP BY customer_id
    )
    """


def product_sql(fact: str) -> str:
    return f"""
    SELECT product_id, product_name, category_id,
           CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
           COUNT(DISTINCT transaction_id) AS times_purchased,
           CAST(SUM(amount) AS DECIMAL(28,2)) AS total_revenue,
           {average("unit_price", 2, 22)} AS avg_unit_price,
           COUNT(DISTINCT customer_id) AS unique_customers,
           MIN(transaction_date) AS first_sale_date, MAX(transaction_date) AS last_sale_date,
           {quotient("SUM(amount)", 2, "COUNT(DISTINCT transaction_id)", 12, 38)}
             AS avg_revenue_per_transaction
    FROM {fact} GROUP BY product_id, product_name, category_id
    """


def category_sql(fact: str) -> str:
    share = (
        "CAST(round(CAST(total_revenue AS DOUBLE) * 100"
        " / CAST(SUM(total_revenue) OVER () AS DOUBLE), 2) AS DECIMAL(5,2))"
    )
    return f"""
    SELECT *, {share} AS revenue_share_pct
    FROM (
      SELECT category_id, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
             COUNT(DISTINCT product_id) AS products_in_category,
             COUNT(DISTINCT transaction_id) AS transactions,
             CAST(SUM(amount) AS DECIMAL(28,2)) AS total_revenue,
             {average("amount", 2, 22)} AS avg_transaction_value,
             COUNT(DISTINCT customer_id) AS unique_customers,
             {quotient("SUM(amount)", 2, "COUNT(DISTINCT product_id)", 12, 38)}
               AS revenue_per_product
      FROM {fact} GROUP BY category_id
    )
    """


PARTS["daily_summary"] = daily("fact")
PARTS["customer_summary"] = customer_sql("fact")
PARTS["product_summary"] = product_sql("fact")
PARTS["category_summary"] = category_sql("fact")
PARTS["best_products"] = """
SELECT * FROM product_summary ORDER BY total_revenue DESC, product_id, product_name LIMIT 10
"""
PARTS["best_customers"] = """
SELECT * FROM customer_summary ORDER BY lifetime_value DESC, customer_id NULLS FIRST LIMIT 10
"""



def by_day(rows: str, by: str) -> str:
    """Demand in days of the calendar: what is missing counts as 0, what was before the first day not at all."""
    frame = f"OVER (PARTITION BY {by} ORDER BY day RANGE BETWEEN {{}} PRECEDING AND {{}})"
    return f"""
    SELECT {by}, transaction_date, units, revenue,
           CASE WHEN day - first >= 7
                THEN coalesce(CAST(SUM(units) {frame.format(7, "7 PRECEDING")} AS BIGINT), 0) END AS units_lag_7,
           CAST(SUM(units) {frame.format(6, "CURRENT ROW")} AS DOUBLE) / least(7, day - first + 1) AS units_avg_7,
           CAST(SUM(units) {frame.format(27, "CURRENT ROW")} AS DOUBLE) / least(28, day - first + 1) AS units_avg_28
    FROM (
      SELECT *, date_diff('day', DATE '1970-01-01', transaction_date) AS day,
             MIN(date_diff('day', DATE '1970-01-01', transaction_date)) OVER (PARTITION BY {by}) AS first
      FROM {rows})
    """


PARTS["daily_categories"] = """
SELECT category_id, transaction_date, CAST(SUM(quantity) AS BIGINT) AS units,
       CAST(SUM(amount) AS DECIMAL(28,2)) AS revenue
FROM accepted_fact GROUP BY category_id, transaction_date
"""
PARTS["filled_categories"] = """
SELECT category_id, transaction_date, CAST(SUM(units) AS BIGINT) AS units,
       CAST(SUM(revenue) AS DECIMAL(28,2)) AS revenue
FROM (
  SELECT * FROM daily_categories UNION ALL
  SELECT category_id, date, 0, 0 FROM (
    SELECT category_id, MIN(transaction_date) AS a, MAX(transaction_date) AS z
    FROM daily_categories GROUP BY category_id)
  JOIN calendar ON date BETWEEN a AND z)
GROUP BY category_id, transaction_date
"""
PARTS["holidays"] = """
SELECT date, 'Holiday ' || strftime(date, '%m-%d') AS holiday_name FROM calendar
WHERE strftime(date, '%m-%d') IN ('01-01', '05-01', '12-25', '12-26')
"""

PARTS["orders_text"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
       CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_timestamp,
       o_orderpriority AS payment_method, CAST(NULL AS VARCHAR) AS shipping_address
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

PARTS["log_lines"] = """
SELECT CASE WHEN event_type = 'signup' THEN stamp
            WHEN event_type = 'error' THEN stamp || ' ERROR ip=10.0.0.' || user_id
                 || ' user_id=' || user_id || ' action=error'
            ELSE stamp || ' INFO ip=10.0.0.' || user_id || ' user_id=' || user_id
                 || ' page=/shop/' || event_type || ' action=' || event_type END AS line
FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events)
"""

PARTS["batches"] = """
SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS _job_date,
       l_returnflag || '-' || o_orderpriority AS _batch_id,
       CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 1 END AS hour
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

PARTS["daily_products"] = """
SELECT product_id, transaction_date, CAST(SUM(quantity) AS BIGINT) AS units,
       CAST(SUM(amount) AS DECIMAL(28,2)) AS revenue
FROM fact GROUP BY product_id, transaction_date
"""


def sql(body: str) -> str:
    """``body`` with the parts it needs, in the order of their definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)) & PARTS.keys() - needed:
            needed.add(word)
            visit(PARTS[word])

    visit(body)
    parts = [f"{name} AS ({PARTS[name].strip()})" for name in PARTS if name in needed]
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()
