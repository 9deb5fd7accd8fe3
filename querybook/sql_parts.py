"""Common table expressions of the comparison SQL."""

from __future__ import annotations

# ---- raw tables, as in adapters.py ----

PLACES = """places AS (
  SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RAW_CUSTOMERS = (
    PLACES
    + """, raw_customers AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN v = 1 THEN ' ' || c_name || '　' END AS customer_name,
    '　' || lower(n_name) || ' ' AS city,
    ' ' || c_mktsegment || '  ' AS customer_level
  FROM places CROSS JOIN (VALUES (1), (2)) AS d(v) WHERE v = 1 OR c_acctbal < 0)"""
)

BASE_ORDERS = """refunds AS (
  SELECT l_orderkey, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2)
    AS DECIMAL(18,2)) AS refund
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
base_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount,
    CAST(o_orderdate AS DATE) AS order_date,
    CASE r_name WHEN 'AFRICA' THEN ' zar ' WHEN 'AMERICA' THEN 'usd' WHEN 'ASIA' THEN 'cny' WHEN 'EUROPE' THEN 'eur' ELSE '' END
      AS currency_code,
    CASE WHEN n_name = 'NATION_0' THEN '' ELSE n_name END AS ship_country,
    refund AS refund_amount, o_orderstatus, o_orderpriority, c_acctbal, c_mktsegment
  FROM orders JOIN places ON o_custkey = c_custkey LEFT JOIN refunds ON o_orderkey = l_orderkey)"""

RAW_ORDERS = (
    BASE_ORDERS
    + """, raw_orders AS (
  SELECT order_id, customer_id, order_amount, order_date, currency_code, ship_country, refund_amount
  FROM base_orders CROSS JOIN (VALUES (1), (2)) AS d(v) WHERE v = 1 OR o_orderstatus = 'P')"""
)

def known_code(column: str) -> str:
    """A code in capitals, UNKNOWN for none."""
    bare = f"upper(trim(ifnull({column}, '')))"
    return f"CASE {bare} WHEN '' THEN 'UNKNOWN' ELSE {bare} END"


STG_CUSTOMERS = """stg_customers AS (
  SELECT customer_id, any_value(n) AS customer_name, any_value(c) AS city, any_value(l) AS customer_level FROM (
    SELECT customer_id, trim(customer_name) AS n, upper(trim(city)) AS c, lower(trim(customer_level)) AS l FROM raw_customers)
  GROUP BY customer_id, ifnull(n, chr(1)), ifnull(c, chr(1)), ifnull(l, chr(1)))"""

# One row a customer: the one that no other row of the customer precedes; missing text comes last.
_SORTED = ", ".join(f"ifnull({{t}}.{c}, chr(1114111))" for c in ("customer_name", "city", "customer_level"))
DIM = f"""dim_customers AS (
  SELECT kept.* FROM stg_customers AS kept WHERE NOT EXISTS (
    FROM stg_customers AS other WHERE other.customer_id = kept.customer_id
      AND row({_SORTED.format(t="other")}) < row({_SORTED.format(t="kept")})))"""

# Cancelled or free orders go first, then copies, then the rest is derived.
STG_ORDERS = f"""stg_orders AS (
  SELECT order_id, customer_id, order_amount, order_date, strftime(order_date, '%Y-%m') AS order_month,
    {known_code('currency_code')} AS currency_code, {known_code('ship_country')} AS ship_country, back AS refund_amount,
    CASE WHEN back > order_amount THEN 0 ELSE order_amount - back END AS net_amount
  FROM (SELECT order_id, customer_id, order_amount, order_date, {known_code('currency_code')} AS currency_code,
      {known_code('ship_country')} AS ship_country, ifnull(refund_amount, 0) AS back
    FROM raw_orders WHERE order_amount > 0 GROUP BY ALL))"""
FACT = "fact_orders AS (FROM stg_orders)"

CUSTOMERS = f"{RAW_CUSTOMERS}, {STG_CUSTOMERS}, {DIM}"
ORDERS = f"{RAW_ORDERS}, {STG_ORDERS}, {FACT}"
WAREHOUSE = f"{CUSTOMERS}, {ORDERS}"


def cents_mean(total: str, count: str) -> str:
    """Exact half-up mean with two places."""
    return f"((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count})) / 100"


def _per_customer(name: str, *keys: str) -> str:
    """Sums per customer and keys: every customer is one row of a key, so counting rows counts customers."""
    return f"""{name} AS (
  SELECT customer_id, {", ".join(keys)}, count(*) AS n, sum(order_amount) AS paid, sum(refund_amount) AS back, sum(net_amount) AS net
  FROM fact_orders GROUP BY customer_id, {", ".join(keys)})"""


_SUMS = f"""CAST(sum(n) AS BIGINT) AS order_count, count(customer_id) AS customer_count,
    sum(paid) AS gross_merchandise_value, sum(back) AS total_refunds, sum(net) AS net_sales,
    {cents_mean('sum(net)', 'CAST(sum(n) AS HUGEINT)')} AS average_order_value"""


def _mart(name: str, months: str, *keys: str) -> str:
    listed = ", ".join(keys)
    return f"{_per_customer(months, 'order_month', 'currency_code')}, {name} AS (\n  SELECT {listed}, {_SUMS}\n  FROM dim_customers JOIN {months} USING (customer_id) GROUP BY {listed})"


SUMMARY = f"""{_per_customer('summary_months', 'order_month', 'currency_code')}, mart_sales_summary AS (
  SELECT concat_ws('|', city, customer_level, order_month, currency_code) AS summary_key, city, customer_level, order_month,
    currency_code, CAST(sum(n) AS BIGINT) AS order_count, sum(paid) AS gross_sales, sum(back) AS total_refunds, sum(net) AS net_sales,
    {cents_mean('sum(net)', 'CAST(sum(n) AS HUGEINT)')} AS avg_order_amount
  FROM dim_customers JOIN summary_months USING (customer_id) GROUP BY ALL)"""

DAILY = f"""{_per_customer('customer_days', 'order_date', 'order_month', 'currency_code')}, mart_daily_sales AS (
  SELECT order_date, order_month, currency_code, {_SUMS} FROM customer_days GROUP BY order_date, order_month, currency_code)"""

CITY = _mart("mart_city_sales", "city_months", "city", "order_month", "currency_code")
LEVEL = _mart("mart_customer_level_sales", "level_months", "customer_level", "order_month", "currency_code")

ORDER_OUT = """order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount, order_date, order_month, currency_code,
  ship_country, CAST(refund_amount AS DOUBLE) AS refund_amount, CAST(net_amount AS DOUBLE) AS net_amount"""

RAW_OUT = """order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount, order_date, currency_code,
  ship_country, CAST(refund_amount AS DOUBLE) AS refund_amount"""

SUMMARY_OUT = """summary_key, city, customer_level, order_month, currency_code, order_count,
  CAST(gross_sales AS DOUBLE) AS gross_sales, CAST(total_refunds AS DOUBLE) AS total_refunds,
  CAST(net_sales AS DOUBLE) AS net_sales, avg_order_amount"""

SALES_OUT = """order_month, currency_code, order_count, customer_count,
  CAST(gross_merchandise_value AS DOUBLE) AS gross_merchandise_value, CAST(total_refunds AS DOUBLE) AS total_refunds,
  CAST(net_sales AS DOUBLE) AS net_sales, average_order_value"""

# ---- nested documents ----

LINES = """lines AS (
  SELECT l_orderkey, l_linenumber AS n, l_returnflag AS flag, CAST(l_quantity AS BIGINT) AS qty,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS unit, CAST(l_discount AS DECIMAL(12,2)) AS disc, CAST(l_tax AS DECIMAL(18,2)) AS tax,
    CASE l_returnflag WHEN 'A' THEN 'SKU-A' WHEN 'N' THEN 'SKU-N' WHEN 'R' THEN 'DG-002' END AS sku
  FROM lineitem),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n, flag, qty, unit, disc, tax) - 1 AS position FROM lines),
sums AS (
  SELECT l_orderkey, sum(qty) AS qty, sum(disc) AS disc,
    sum(unit * qty) FILTER (flag <> 'R') AS product_amount, sum(disc * qty) FILTER (flag <> 'R') AS product_discount,
    sum(tax) AS tax, sum(unit) FILTER (flag = 'R') AS refunded
  FROM lines GROUP BY l_orderkey)"""


def text(clock: str) -> str:
    return f"strftime({clock}, '%Y-%m-%d %H:%M:%S')"


_WALL = """(date_trunc('day', o_orderdate) + CASE o_orderstatus WHEN 'F' THEN INTERVAL '23 hours 30 minutes'
      WHEN 'O' THEN INTERVAL '1 hour 15 minutes 30 seconds' ELSE INTERVAL '2 hours 30 minutes' END)"""
_OFFSET = "(CASE o_orderstatus WHEN 'F' THEN INTERVAL '0 hours' WHEN 'O' THEN INTERVAL '8 hours' ELSE INTERVAL '-5 hours' END)"

WIDE = f"""{PLACES}, {LINES}, docs AS (
  SELECT *, {_WALL} AS wall, {_WALL} - {_OFFSET} AS utc FROM orders JOIN places ON o_custkey = c_custkey
  LEFT JOIN sums ON o_orderkey = l_orderkey),
wide AS (
  SELECT 'gid://shop/Order/' || o_orderkey AS shopify_gid, 'demo' AS shop_name, '#' || o_orderkey AS order_id,
    o_orderkey AS legacy_order_id,
    CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') OR c_custkey = 0 THEN 5000000000000 + o_orderkey
      ELSE c_custkey END AS customer_legacy_id,
    {text('wall')} AS created_at,
    {text("utc AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Shanghai'")} AS beijing_created_at,
    {text("utc AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'")} AS use_created_at,
    {text("utc AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin'")} AS berlin_created_at,
    o_orderstatus AS order_status, CAST(coalesce(qty, 0) AS INTEGER) AS product_quantity,
    coalesce(product_amount, 0) AS total_product_amount,
    CASE WHEN o_orderstatus <> 'F' THEN 12.50 ELSE 0 END AS shippingfee,
    coalesce(product_discount, 0) AS total_product_discount, coalesce(disc, 0) AS discountfee, coalesce(tax, 0) AS tax,
    o_orderpriority AS logistics_status, CAST(c_acctbal > 0 AS INTEGER) AS marketing_intention,
    CASE r_name WHEN 'AFRICA' THEN ' zar ' WHEN 'AMERICA' THEN 'usd' WHEN 'ASIA' THEN 'cny' WHEN 'EUROPE' THEN 'eur' ELSE '' END
      AS currency_code,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total_price, CAST(o_totalprice AS DECIMAL(18,2)) AS product_sales,
    coalesce(refunded, 0) AS totalrefunded, '' AS discount_method,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment || ' ' || n_name
      ELSE c_name END AS customer_display_name,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE c_name || '@example.com' END AS customer_email,
    '' AS customer_phone, CASE WHEN c_acctbal >= 0 THEN n_name ELSE '' END AS bill_country,
    '' AS shipping_address1, '' AS shipping_address2, lower(n_name) AS shipping_city, '' AS shipping_province,
    r_name AS shipping_country, '' AS shipping_zip, '' AS shipping_phone, c_name AS shipping_name, '' AS discount_code,
    {text("date_trunc('day', o_orderdate) + INTERVAL '12 hours'")} AS updated_at,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
      THEN {text("date_trunc('day', o_orderdate) + INTERVAL '5 hours'")} END AS cancelled_at,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'CUSTOMER' ELSE '' END AS cancel_reason,
    CASE WHEN c_acctbal >= 0 THEN '{{"country":"' || n_name || '"}}' ELSE '{{}}' END AS billing_address
  FROM docs)"""

NARROW = """raw_orders AS (
  SELECT legacy_order_id AS order_id, customer_legacy_id AS customer_id, total_price AS order_amount,
    CAST(left(created_at, 10) AS DATE) AS order_date,
    CASE WHEN ifnull(currency_code, '') = '' THEN 'UNKNOWN' ELSE trim(currency_code) END AS currency_code,
    ifnull(trim(shipping_country), '') AS ship_country, ifnull(totalrefunded, 0) AS refund_amount
  FROM wide WHERE legacy_order_id + customer_legacy_id IS NOT NULL AND created_at IS NOT NULL AND total_price IS NOT NULL
  GROUP BY ALL),
raw_customers AS (
  SELECT last.customer_legacy_id AS customer_id,
    CASE WHEN ifnull(trim(customer_display_name), '') = '' THEN 'guest' ELSE trim(customer_display_name) END AS customer_name,
    CASE WHEN ifnull(shipping_city, '') = '' THEN 'UNKNOWN' ELSE upper(trim(shipping_city)) END AS city, 'standard' AS customer_level
  FROM wide AS last WHERE customer_legacy_id IS NOT NULL AND NOT EXISTS (
    FROM wide AS later WHERE later.customer_legacy_id = last.customer_legacy_id
      AND row(ifnull(later.legacy_order_id, -1), later.shopify_gid) > row(ifnull(last.legacy_order_id, -1), last.shopify_gid)))"""

def number_text(value: str) -> str:
    """Short text of a decimal number."""
    v = f"CAST({value} AS DECIMAL(28,4))"

    def scaled(factor: str, places: int) -> str:
        return f"CAST(CAST(round({v} * CAST({factor} AS DECIMAL(7,6)), {places}) AS DECIMAL(28,{places})) AS VARCHAR)"

    return f"""CASE WHEN {v} IS NULL THEN '—' WHEN abs({v}) >= 1000000 THEN {scaled('0.000001', 2)} || 'M'
      WHEN abs({v}) >= 10000 THEN {scaled('0.001', 1)} || 'k'
      WHEN {v} = round({v}, 0) THEN CAST(CAST({v} AS HUGEINT) AS VARCHAR) ELSE {scaled('1', 2)} END"""


def cards(source: str, items: list[tuple[str, str, str]]) -> str:
    """One row per card out of the rows of a table."""
    rows = [
        f"SELECT {i} AS position, '{label}' AS label, CAST({value} AS DECIMAL(32,4)) AS v, '{hint}' AS hint FROM {source}"
        for i, (label, value, hint) in enumerate(items)
    ]
    return " UNION ALL ".join(rows)


PRESENTED = f"position, label, CAST(v AS DOUBLE) AS value, {number_text('v')} AS text, hint"
