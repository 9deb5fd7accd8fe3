"""Layers, marts, incremental loads, checks and migrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook import adapters
from querybook import sql_parts as sql
from querybook.registry import query
from salesloom.functions.money import as_doubles
from salesloom.operators import evolve, incremental, layers, marts, quality
from salesloom.plans.warehouse import build_warehouse


def _dim(spark: SparkSession, folder: str) -> DataFrame:
    return layers.dim_customers(layers.clean_customers(adapters.raw_customers(spark, folder)))


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return layers.fact_orders(layers.stg_orders(adapters.raw_orders(spark, folder)))


@query(f"WITH {sql.RAW_CUSTOMERS}, {sql.STG_CUSTOMERS} SELECT * FROM stg_customers")
def stg_customers(spark: SparkSession, folder: str) -> DataFrame:
    return layers.stg_customers(adapters.raw_customers(spark, folder))


@query(f"WITH {sql.PLACES}, {sql.ORDERS} SELECT {sql.ORDER_OUT} FROM stg_orders")
def stg_orders(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(layers.stg_orders(adapters.raw_orders(spark, folder)))


@query(f"WITH {sql.CUSTOMERS} SELECT * FROM dim_customers")
def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _dim(spark, folder)


@query(f"WITH {sql.PLACES}, {sql.ORDERS} SELECT {sql.ORDER_OUT} FROM fact_orders")
def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(fact(spark, folder))


@query(f"WITH {sql.WAREHOUSE}, {sql.SUMMARY} SELECT {sql.SUMMARY_OUT} FROM mart_sales_summary")
def mart_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder)))


@query(f"WITH {sql.PLACES}, {sql.ORDERS}, {sql.DAILY} SELECT order_date, {sql.SALES_OUT} FROM mart_daily_sales")
def mart_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(marts.mart_daily_sales(fact(spark, folder)))


@query(f"WITH {sql.WAREHOUSE}, {sql.CITY} SELECT city, {sql.SALES_OUT} FROM mart_city_sales")
def mart_city_sales(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(marts.mart_city_sales(fact(spark, folder), _dim(spark, folder)))


@query(f"WITH {sql.WAREHOUSE}, {sql.LEVEL} SELECT customer_level, {sql.SALES_OUT} FROM mart_customer_level_sales")
def mart_customer_level_sales(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(marts.mart_customer_level_sales(fact(spark, folder), _dim(spark, folder)))


# ---- incremental -----------------------------------------------------------
# The stored table holds the orders before 2000, the batch those from the middle of 1999 on.

_SPLIT = """existing AS (SELECT * FROM raw_orders WHERE order_date < DATE '2000-01-01'),
incoming AS (SELECT * FROM raw_orders WHERE order_date >= DATE '1999-07-01'),
unseen AS (SELECT i.* FROM incoming i LEFT JOIN (SELECT DISTINCT order_id FROM existing) e ON i.order_id = e.order_id
  WHERE e.order_id IS NULL)"""


def split_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = adapters.raw_orders(spark, folder)
    return raw.filter(F.col("order_date") < "2000-01-01"), raw.filter(F.col("order_date") >= "1999-07-01")


@query(
    f"WITH {sql.PLACES}, {sql.RAW_ORDERS}, {_SPLIT} SELECT {sql.RAW_OUT} FROM existing"
    f" UNION ALL SELECT {sql.RAW_OUT} FROM unseen"
)
def incremental_append(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(incremental.append_unseen(*split_orders(spark, folder)))


@query(f"WITH {sql.PLACES}, {sql.RAW_ORDERS}, {_SPLIT} SELECT count(*) AS inserted_rows FROM unseen")
def incremental_new_count(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.unseen(*split_orders(spark, folder)).agg(F.count("*").alias("inserted_rows"))


@query(
    "SELECT user_id, event_id, ts, event_type, value FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The table as of 15 January, then a batch that starts on the 10th."""
    events = adapters.table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    stored = incremental.latest(events.filter(F.col("ts") < "2024-01-16"), ["user_id"], ["ts", "event_id"])
    batch = events.filter(F.col("ts") >= "2024-01-10")
    return incremental.upsert_latest(stored, batch, ["user_id"], ["ts", "event_id"])


_BOUNDS = "bounds AS (SELECT CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day FROM events)"


def event_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.table(spark, folder, "events").agg(
        F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day")
    )


@query(
    f"WITH {_BOUNDS} SELECT CAST(unnest(generate_series(last_day - 13, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds"
)
def day_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The last fortnight up to the newest event."""
    return incremental.look_back(event_bounds(spark, folder), incremental.look_back_days())


@query(
    f"""WITH {_BOUNDS}, days AS (
  SELECT CAST(unnest(generate_series(first_day - 2, last_day + 2, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds)
SELECT day, count(event_id) AS row_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM days LEFT JOIN events ON ts >= day AND ts < day + 1 GROUP BY day"""
)
def day_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day, with two empty days on each side."""
    bounds = event_bounds(spark, folder).select(
        F.date_sub("first_day", 2).alias("first_day"), F.date_add("last_day", 2).alias("last_day")
    )
    events = adapters.table(spark, folder, "events")
    total = F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")
    return as_doubles(incremental.day_counts(incremental.calendar(bounds), events, "ts", total))


@query(
    "SELECT event_type, count(*) AS row_count, count(DISTINCT user_id) AS user_count FROM events"
    " WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY event_type"
)
def day_window_filter(spark: SparkSession, folder: str) -> DataFrame:
    events = adapters.table(spark, folder, "events")
    week = incremental.in_days(events, "ts", F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))
    return week.groupBy("event_type").agg(F.count("*").alias("row_count"), F.count_distinct("user_id").alias("user_count"))


# ---- quality ---------------------------------------------------------------

_MESSAGES = {
    "raw_customers_not_empty": "raw_customers must not be empty",
    "raw_orders_not_empty": "raw_orders must not be empty",
    "stg_orders_positive_amount": "stg_orders must hold positive amounts and a customer",
    "dim_customers_unique_customer_id": "customer_id must be unique in dim_customers",
    "fact_orders_customer_reference_valid": "customer_id of fact_orders must be in dim_customers",
    "mart_sales_summary_not_empty": "mart_sales_summary must not be empty",
    "mart_daily_sales_not_empty": "mart_daily_sales must not be empty",
}


def _check_sql(name: str, passed: str, failed: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {passed} AS passed, '{_MESSAGES[name]}' AS message,"
        f" CAST({failed} AS BIGINT) AS failed_rows"
    )


def _report_sql(daily: str | None) -> str:
    bad = "(SELECT count(*) FROM stg_orders WHERE order_amount <= 0 OR customer_id IS NULL)"
    twice = "(SELECT count(*) FILTER (copies > 1) FROM (SELECT count(*) AS copies FROM dim_customers GROUP BY customer_id))"
    lost = "(SELECT count(*) FROM fact_orders AS f WHERE NOT EXISTS (FROM dim_customers AS d WHERE d.customer_id = f.customer_id))"
    summary = "(SELECT count(*) FROM mart_sales_summary)"
    parts = [
        _check_sql("raw_customers_not_empty", "(SELECT count(*) FROM raw_customers) > 0", "0"),
        _check_sql("raw_orders_not_empty", "(SELECT count(*) FROM raw_orders) > 0", "0"),
        _check_sql("stg_orders_positive_amount", f"{bad} = 0", bad),
        _check_sql("dim_customers_unique_customer_id", f"{twice} = 0", twice),
        _check_sql("fact_orders_customer_reference_valid", f"{lost} = 0", lost),
        _check_sql("mart_sales_summary_not_empty", f"{summary} > 0", f"CASE WHEN {summary} > 0 THEN 0 ELSE 1 END"),
        _check_sql("mart_daily_sales_not_empty", f"{daily} > 0", f"CASE WHEN {daily} > 0 THEN 0 ELSE 1 END")
        if daily
        else _check_sql("mart_daily_sales_not_empty", "false", "1"),
    ]
    return " UNION ALL ".join(parts)


def clean_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    raw_customers, raw_orders = adapters.raw_customers(spark, folder), adapters.raw_orders(spark, folder)
    return {"raw_customers": raw_customers, "raw_orders": raw_orders, **build_warehouse(raw_customers, raw_orders)}


@query(
    f"WITH {sql.WAREHOUSE}, {sql.SUMMARY}, {sql.DAILY} " + _report_sql("(SELECT count(*) FROM mart_daily_sales)")
)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_checks(spark, clean_tables(spark, folder))


# Dirty tables: cancelled amounts, orders without a customer, customers who left, customers twice.
_DIRTY = f"""stg_orders AS (
  SELECT order_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN o_orderstatus = 'F' THEN -order_amount ELSE order_amount END AS order_amount, order_date,
    strftime(order_date, '%Y-%m') AS order_month, 'EUR' AS currency_code, refund_amount, order_amount AS net_amount
  FROM base_orders),
fact_orders AS (SELECT * FROM stg_orders),
raw_orders AS (SELECT * FROM base_orders), raw_customers AS (SELECT * FROM customer),
dim_customers AS (
  SELECT c_custkey AS customer_id, n_name AS city, c_mktsegment AS customer_level
  FROM places CROSS JOIN (VALUES (1), (2)) AS d(v) WHERE c_acctbal >= 0 AND (v = 1 OR c_mktsegment = 'BUILDING')),
mart_sales_summary AS (SELECT 1 AS n FROM fact_orders SEMI JOIN dim_customers USING (customer_id))"""


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Staged orders with negated amounts for finished orders and no customer for low priority."""
    base = adapters.base_orders(spark, folder)
    amount = F.col("o_totalprice").cast("decimal(18,4)")
    return base.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", -amount).otherwise(amount).alias("order_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
        F.lit("EUR").alias("currency_code"),
        F.col("refund").cast("decimal(18,4)").alias("refund_amount"),
        amount.alias("net_amount"),
    )


def dirty_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without the overdrawn ones; one segment comes twice."""
    twice = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        adapters.places(spark, folder).filter(F.col("c_acctbal") >= 0)
        .select(
            F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("customer_level"), F.explode(twice).alias("copy"),
        )
        .drop("copy")
    )


@query(f"WITH {sql.PLACES}, {sql.BASE_ORDERS}, {_DIRTY} " + _report_sql(None))
def quality_dirty_report(spark: SparkSession, folder: str) -> DataFrame:
    """The daily mart is absent, too."""
    orders, dim = dirty_orders(spark, folder), dirty_customers(spark, folder)
    tables = {
        "raw_customers": adapters.table(spark, folder, "customer"),
        "raw_orders": adapters.table(spark, folder, "orders"),
        "stg_orders": orders,
        "fact_orders": orders,
        "dim_customers": dim,
        "mart_sales_summary": marts.mart_sales_summary(orders, dim),
    }
    return quality.quality_checks(spark, tables)


@query(
    f"WITH {sql.PLACES}, {sql.BASE_ORDERS}, {_DIRTY}, report AS (" + _report_sql(None)
    + ") SELECT count(*) AS total_checks, count(*) FILTER (passed) AS passed_checks,"
    " count(*) FILTER (NOT passed) AS failed_checks, bool_and(passed) AS is_successful FROM report"
)
def quality_totals(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_totals(quality_dirty_report(spark, folder))


def _key_sql(table: str, key: str) -> str:
    names = key.replace(",", ", ")
    return (
        f"SELECT '{table}_key_unique' AS check_name, n = 0 AS passed, '{names} must be unique in {table}' AS message,"
        f" n AS failed_rows FROM (SELECT count(*) AS n FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1))"
    )


_KEYS = {
    "raw_customers": "customer_id",
    "raw_orders": "order_id",
    "stg_customers": "customer_id",
    "stg_orders": "order_id",
    "dim_customers": "customer_id",
    "fact_orders": "order_id",
    "mart_sales_summary": "summary_key",
    "mart_daily_sales": "order_date,currency_code",
    "mart_city_sales": "city,order_month,currency_code",
    "mart_customer_level_sales": "customer_level,order_month,currency_code",
}
_ALL_TABLES = f"{sql.WAREHOUSE}, {sql.SUMMARY}, {sql.DAILY}, {sql.CITY}, {sql.LEVEL}"


@query(f"WITH {_ALL_TABLES} " + " UNION ALL ".join(_key_sql(t, k) for t, k in _KEYS.items()))
def key_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.published_key_checks(clean_tables(spark, folder))


def _null_sql() -> str:
    from salesloom.schemas import PUBLISHED

    return " UNION ALL ".join(
        f"SELECT '{p.source}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM {p.source}"
        for p in PUBLISHED
        for c in p.not_null
    )


@query(f"WITH {_ALL_TABLES} " + _null_sql())
def null_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.published_null_counts(clean_tables(spark, folder))


# ---- schema evolution ------------------------------------------------------


@query(
    f"""WITH {sql.PLACES}, {sql.BASE_ORDERS}
SELECT order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount, order_date, 'CNY' AS currency_code,
  COALESCE(NULLIF(trim(ship_country), ''), 'UNKNOWN') AS ship_country, CAST(COALESCE(refund_amount, 0) AS DOUBLE) AS refund_amount,
  CAST(order_amount - COALESCE(refund_amount, 0) AS DOUBLE) AS net_amount FROM base_orders"""
)
def migrate_additive(spark: SparkSession, folder: str) -> DataFrame:
    """Staged orders without currency and net amount."""
    old = adapters.as_raw_orders(adapters.base_orders(spark, folder)).drop("currency_code")
    return as_doubles(evolve.migrate_additive("stg_orders", old))


@query(
    f"""WITH {sql.PLACES}, {sql.BASE_ORDERS}
SELECT order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount, order_date, 'CNY' AS currency_code,
  'UNKNOWN' AS ship_country, CAST(0 AS DOUBLE) AS refund_amount FROM base_orders"""
)
def migrate_raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    old = adapters.as_raw_orders(adapters.base_orders(spark, folder))
    return as_doubles(evolve.migrate_additive("raw_orders", old.select("order_id", "customer_id", "order_amount", "order_date")))


@query(
    f"""WITH {sql.WAREHOUSE}, {sql.SUMMARY}
SELECT summary_key, city, customer_level, order_month, CASE WHEN currency_code = 'UNKNOWN' THEN 'CNY' ELSE currency_code END
    AS currency_code, order_count, avg_order_amount, CAST(gross_sales AS DOUBLE) AS total_sales,
  CAST(gross_sales AS DOUBLE) AS gross_sales,
  CASE WHEN currency_code = 'USD' THEN CAST(total_refunds AS DOUBLE) ELSE 0.0::DOUBLE END AS total_refunds,
  CAST(gross_sales - CASE WHEN currency_code = 'USD' THEN total_refunds ELSE 0 END AS DOUBLE) AS net_sales
FROM mart_sales_summary"""
)
def migrate_legacy_sales(spark: SparkSession, folder: str) -> DataFrame:
    """A summary with the former total, refunds known in one currency only, and blank currencies."""
    now = marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder))
    old = now.select(
        "summary_key", "city", "customer_level", "order_month",
        F.when(F.col("currency_code") == "UNKNOWN", F.lit(" ")).otherwise(F.col("currency_code")).alias("currency_code"),
        "order_count", "avg_order_amount", F.col("gross_sales").alias("total_sales"),
        F.when(F.col("currency_code") == "USD", F.col("total_refunds")).alias("total_refunds"),
    )
    return as_doubles(evolve.migrate_additive("mart_sales_summary", old))


@query(
    f"""WITH {sql.PLACES}, {sql.ORDERS}, {sql.DAILY}
SELECT order_date, order_month, order_count, customer_count, average_order_value,
  CAST(gross_merchandise_value AS DOUBLE) AS gross_merchandise_value, 'CNY' AS currency_code,
  CAST(total_refunds AS DOUBLE) AS total_refunds, CAST(gross_merchandise_value - total_refunds AS DOUBLE) AS net_sales
FROM mart_daily_sales"""
)
def migrate_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    old = marts.mart_daily_sales(fact(spark, folder)).drop("currency_code", "net_sales")
    return as_doubles(evolve.migrate_additive("mart_daily_sales", old))
