"""Nested documents: wide orders, child tables, catalogue, inbox."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook import adapters
from querybook import sql_parts as sql
from querybook.registry import query
from salesloom import schemas
from salesloom.functions.money import as_doubles
from salesloom.functions.text import level_from_tags, shop_label, store_domain
from salesloom.operators import children, narrow, products
from salesloom.operators.wide import wide_columns
from salesloom.operators.wide import wide_orders as map_orders
from salesloom.plans.run import day_summary
from salesloom.sources import inbox, pages

_WIDE_MONEY = ("total_product_amount", "shippingfee", "total_product_discount", "discountfee", "tax", "total_price",
               "product_sales", "totalrefunded")
# The JSON lists are compared as rows by the child-table queries.
_COMPARED = [c for c in schemas.WIDE_ORDER_COLUMNS if c not in ("product_details", "discount_information", "refunds", "etl_synced_at")]


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    return pages.order_nodes(adapters.order_pages(spark, folder))


def wide(spark: SparkSession, folder: str) -> DataFrame:
    return map_orders(nodes(spark, folder), "demo")


def some_wide(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    return wide_columns(adapters.order_pages(spark, folder), "demo", columns)


def _wide_sql(columns: list[str]) -> str:
    shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _WIDE_MONEY else c for c in columns)
    return f"WITH {sql.WIDE} SELECT {shown} FROM wide"


@query(_wide_sql(_COMPARED))
def wide_orders(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(wide(spark, folder).select(*_COMPARED))


_TOTALS = ["shopify_gid", "product_quantity", "total_product_amount", "total_product_discount"]


@query(_wide_sql(_TOTALS))
def wide_line_totals(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(wide(spark, folder).select(*_TOTALS))


_CLOCKS = ["shopify_gid", "created_at", "beijing_created_at", "use_created_at", "berlin_created_at", "updated_at", "cancelled_at"]


@query(_wide_sql(_CLOCKS))
def wide_clocks(spark: SparkSession, folder: str) -> DataFrame:
    return wide(spark, folder).select(*_CLOCKS)


_IDS = ["shopify_gid", "order_id", "legacy_order_id", "customer_legacy_id", "customer_display_name"]


@query(_wide_sql(_IDS))
def wide_ids(spark: SparkSession, folder: str) -> DataFrame:
    return wide(spark, folder).select(*_IDS)


@query(
    f"""WITH {sql.LINES}, given AS (
  SELECT l_orderkey, position, sku, qty, 'Deal ' || flag AS title, tax AS amount FROM placed WHERE tax > 0
  UNION ALL SELECT l_orderkey, position, sku, qty, 'Bulk', disc FROM placed WHERE qty > 25)
SELECT 'gid://shop/Order/' || l_orderkey AS shopify_gid, position, sku, qty AS quantity, 'ManualDiscountApplication' AS type, title,
  CAST(NULL AS VARCHAR) AS code, CAST(amount AS DOUBLE) AS amount, 'USD' AS currency
FROM given JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
)
def wide_discounts(spark: SparkSession, folder: str) -> DataFrame:
    """The discount list of the wide table, read back from its JSON text."""
    shape = (
        "array<struct<name: string, sku: string, quantity: bigint,"
        " discounts: array<struct<type: string, title: string, code: string, amount: double, currency: string>>>>"
    )
    info = wide(spark, folder).select("shopify_gid", F.from_json("discount_information", shape).alias("info"))
    lines = info.select("shopify_gid", F.posexplode("info").alias("position", "line"))
    return lines.select(
        "shopify_gid", F.col("position").cast("bigint").alias("position"), "line.sku", "line.quantity", F.inline("line.discounts")
    )


@query(f"WITH {sql.WIDE}, {sql.NARROW} SELECT {sql.RAW_OUT} FROM raw_orders")
def narrow_orders(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(narrow.narrow_orders(some_wide(spark, folder, narrow.ORDER_READS)))


@query(f"WITH {sql.WIDE}, {sql.NARROW} SELECT * FROM raw_customers")
def narrow_customers(spark: SparkSession, folder: str) -> DataFrame:
    return narrow.narrow_customers(some_wide(spark, folder, narrow.CUSTOMER_READS))


@query(
    f"""WITH {sql.WIDE} SELECT customer_legacy_id, arg_max(shopify_gid, legacy_order_id) AS shopify_gid,
  arg_max(customer_email, legacy_order_id) AS customer_email, CAST(arg_max(total_price, legacy_order_id) AS DOUBLE) AS total_price
FROM wide GROUP BY customer_legacy_id"""
)
def latest_customer_attributes(spark: SparkSession, folder: str) -> DataFrame:
    from salesloom.operators.incremental import latest

    rows = wide(spark, folder).select("customer_legacy_id", "legacy_order_id", "shopify_gid", "customer_email", "total_price")
    newest = latest(rows, ["customer_legacy_id"], ["legacy_order_id", "shopify_gid"])
    return as_doubles(newest.drop("legacy_order_id"))


_KNOWN = "JOIN customer ON o_custkey = c_custkey"


@query(
    f"""WITH {sql.LINES} SELECT 'gid://shop/Order/' || o_orderkey AS shopify_gid, o_orderkey AS legacy_order_id, position,
  'gid://shop/LineItem/' || n || '-' || o_orderkey AS line_id, 'Line ' || n AS line_name, sku, qty AS quantity,
  CAST(coalesce(unit, 0) AS DOUBLE) AS unit_price, CAST(coalesce(disc, 0) AS DOUBLE) AS total_discount
FROM orders {_KNOWN} LEFT JOIN placed ON l_orderkey = o_orderkey"""
)
def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    parsed = pages.order_nodes(adapters.order_pages(spark, folder), fields=children.LINE_READS)
    rows = children.order_lines(parsed).select(
        "shopify_gid", "legacy_order_id", F.col("position").cast("bigint").alias("position"), "line_id", "line_name", "sku",
        F.col("quantity").cast("bigint").alias("quantity"), "unit_price", "total_discount",
    )
    return as_doubles(rows)


@query(
    f"""WITH {sql.LINES} SELECT 'gid://shop/Order/' || o_orderkey AS shopify_gid, o_orderkey AS legacy_order_id,
  'gid://shop/Refund/' || n || '-' || o_orderkey AS refund_id, strftime(o_orderdate, '%Y-%m-%d') || 'T20:00:00Z' AS refunded_at,
  CAST(unit AS DOUBLE) AS refund_total, 'gid://shop/LineItem/' || n || '-' || o_orderkey AS line_id, 'Line ' || n AS line_name, 'DG-002' AS sku,
  qty AS quantity, CAST(unit AS DOUBLE) AS unit_price
FROM orders {_KNOWN} JOIN lines ON l_orderkey = o_orderkey WHERE flag = 'R'"""
)
def refund_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = children.refund_lines(nodes(spark, folder)).drop("position", "line_position", "note")
    return as_doubles(rows.withColumn("quantity", F.col("quantity").cast("bigint")))


@query(
    f"""SELECT 'gid://shop/Order/' || o_orderkey AS shopify_gid, o_orderkey AS legacy_order_id, 'SUCCESS' AS status,
  CAST(o_orderkey AS VARCHAR) AS tracking_number, 'Carrier' AS company FROM orders {_KNOWN} WHERE o_orderstatus = 'F'"""
)
def order_fulfillments(spark: SparkSession, folder: str) -> DataFrame:
    return children.fulfillments(nodes(spark, folder)).drop("position", "tracking_url")


@query(
    f"""SELECT 'gid://shop/Order/' || o_orderkey AS shopify_gid, 'gid://shop/Transaction/' || o_orderkey AS transaction_id,
  'SALE' AS kind, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') || 'T21:00:00Z' AS processed_at FROM orders {_KNOWN}"""
)
def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return children.transactions(nodes(spark, folder)).drop("position", "legacy_order_id", "gateway")


@query(
    f"""SELECT 'gid://shop/Order/' || o_orderkey AS shopify_gid, 'crm' AS namespace, 'segment' AS key, c_mktsegment AS value
FROM orders {_KNOWN}"""
)
def order_metafields(spark: SparkSession, folder: str) -> DataFrame:
    return children.metafields(nodes(spark, folder)).drop("position", "legacy_order_id")


# ---- catalogue and customer pages ------------------------------------------


def product_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return pages.product_nodes(adapters.product_pages(spark, folder))


_PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"


@query(
    f"""SELECT 'gid://shop/Product/' || p_partkey AS product_id, p_name AS title, replace(p_name, ' ', '-') AS handle,
  p_brand AS vendor, p_type AS product_type, p_type || ',' || p_brand AS tags, CAST({_PRICE} AS DOUBLE) AS min_price,
  CAST({_PRICE} + 5 AS DOUBLE) AS max_price, 'EUR' AS currency_code FROM part"""
)
def catalogue_products(spark: SparkSession, folder: str) -> DataFrame:
    shown = ["product_id", "title", "handle", "vendor", "product_type", "tags", "min_price", "max_price", "currency_code"]
    return as_doubles(products.products(product_nodes(spark, folder)).select(*shown).orderBy("title", "product_id"))


@query(
    f"""SELECT 'gid://shop/Product/' || p_partkey AS product_id, p_name AS title, CAST(v AS BIGINT) AS position,
  'gid://shop/Variant/' || kind || '-' || p_partkey AS variant_id, kind AS variant_title, p_brand || '-' || kind AS sku,
  p_size > 25 AS available, CAST({_PRICE} + 5 * v AS DOUBLE) AS price,
  CASE WHEN v = 1 THEN CAST({_PRICE} + 10 AS DOUBLE) END AS compare_at_price, 'EUR' AS currency_code
FROM part CROSS JOIN (VALUES (0, 'base'), (1, 'gift')) AS d(v, kind)"""
)
def product_variants(spark: SparkSession, folder: str) -> DataFrame:
    rows = products.product_variants(product_nodes(spark, folder))
    return as_doubles(rows.withColumn("position", F.col("position").cast("bigint")))


@query(
    """SELECT 'gid://shop/Product/' || p_partkey AS product_id, p_name AS title,
  CASE WHEN p_size > 10 THEN 'img/' || p_partkey END AS url, CASE WHEN p_size > 10 THEN p_size END AS width FROM part"""
)
def product_images(spark: SparkSession, folder: str) -> DataFrame:
    return products.product_images(product_nodes(spark, folder)).select("product_id", "title", "url", "width")


@query("SELECT count(*) AS page_count, 2 * count(*) AS node_count FROM part")
def catalogue_probe(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_probe(adapters.product_pages(spark, folder))


_LEVEL = """CASE WHEN c_acctbal > 9000 THEN 'vip' WHEN c_acctbal > 7000 THEN 'gold' WHEN c_acctbal > 5000 THEN 'silver'
    WHEN c_acctbal > 3000 THEN 'bronze' WHEN c_acctbal > 1000 THEN 'key_account' ELSE 'standard' END"""


@query(
    f"""WITH {sql.PLACES} SELECT c_custkey AS customer_id,
  coalesce(nullif(trim(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE '' END || ' '
    || CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END), ''), 'guest') AS customer_name,
  CASE WHEN n_name <> 'NATION_0' THEN n_name ELSE 'unknown' END AS city, {_LEVEL} AS customer_level FROM places"""
)
def customer_page_levels(spark: SparkSession, folder: str) -> DataFrame:
    return pages.customers_from_pages(adapters.customer_pages(spark, folder))


@query(f"SELECT c_custkey AS customer_id, {_LEVEL} AS customer_level FROM customer")
def customer_level_from_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Tags as one text."""
    tags = F.array_join(adapters.tag_list(F.col("c_acctbal")), ",")
    return adapters.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), level_from_tags(tags).alias("customer_level")
    )


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) ELSE 0 END AS order_amount,
  CAST(o_orderdate AS DATE) AS order_date, CASE WHEN o_orderstatus <> 'F' THEN 'EUR' ELSE 'UNKNOWN' END AS currency_code,
  'UNKNOWN' AS ship_country, 0.0::DOUBLE AS refund_amount FROM orders"""
)
def compact_order_pages(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(pages.orders_from_pages(adapters.compact_order_pages(spark, folder)))


@query(
    """SELECT c_custkey AS customer_id, CASE WHEN c_acctbal > 0 THEN 'shop-' || c_nationkey ELSE 'shopify_store' END AS shop,
  CASE WHEN c_acctbal > 0 THEN 'shop-' || c_nationkey || '.myshopify.com' END AS domain FROM customer"""
)
def shop_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Shop label and checked domain, out of a web address."""
    given = F.concat(F.lit("https://Shop-"), F.col("c_nationkey"), F.lit(".MyShopify.com/"))
    address = F.when(F.col("c_acctbal") > 0, given).otherwise("")
    domain = store_domain(address)
    return adapters.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), shop_label(domain).alias("shop"), domain.alias("domain")
    )


# ---- inbox -----------------------------------------------------------------


@query(
    f"""WITH {sql.PLACES} SELECT c_custkey AS customer_id,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN c_name ELSE 'customer_' || c_custkey END AS customer_name,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN n_name ELSE 'unknown' END AS city,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'gold' WHEN 'HOUSEHOLD' THEN 'silver' ELSE 'standard' END AS customer_level
FROM places"""
)
def inbox_customers(spark: SparkSession, folder: str) -> DataFrame:
    documents = adapters.inbox_customer_documents(spark, folder)
    return inbox.inbox_customers(inbox.json_records(documents, "customers"))


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS order_amount,
  CASE WHEN o_orderpriority = '5-LOW' THEN DATE '2026-04-30' ELSE CAST(o_orderdate AS DATE) END AS order_date FROM orders"""
)
def inbox_orders(spark: SparkSession, folder: str) -> DataFrame:
    documents = adapters.inbox_order_documents(spark, folder)
    records = inbox.json_records(documents, "orders")
    return as_doubles(inbox.inbox_orders(records, today=F.lit("2026-04-30").cast("date")))


# ---- day-by-day sync -------------------------------------------------------


@query(
    "SELECT CAST(ts AS DATE) AS day, count(*) AS orders_merged, count(DISTINCT user_id) AS distinct_orders"
    " FROM events GROUP BY 1"
)
def multi_day_sync_summary(spark: SparkSession, folder: str) -> DataFrame:
    updates = map_orders(pages.order_nodes(adapters.event_pages(spark, folder)), "demo", keep=("day",))
    return day_summary(updates)
