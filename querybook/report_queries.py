"""Key figures, charts, rankings, shares, pivots and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook import adapters
from querybook import sql_parts as sql
from querybook.registry import query
from querybook.warehouse_queries import _dim, fact
from salesloom.functions.money import as_doubles
from salesloom.operators import customer_bitmaps, layers, marts, reports
from salesloom.session import shared_dir
from salesloom.sources.tables import CATALOG_BY_TABLE, row_limit


def _declared(table: str) -> str:
    items = [("rows", "count(*)", "rows of the table")]
    for kpi in CATALOG_BY_TABLE[table].kpis:
        if kpi.agg == "avg":
            value = sql.cents_mean(f"sum(CAST({kpi.column} AS DECIMAL(18,2)))", f"count({kpi.column})")
            items.append((kpi.label, value, f"average of {kpi.column}"))
        else:
            items.append((kpi.label, f"sum({kpi.column})", f"sum of {kpi.column}"))
    return f"SELECT {sql.PRESENTED} FROM (" + sql.cards(table, items) + ")"


@query(f"WITH {sql.PLACES}, {sql.ORDERS}, {sql.DAILY} " + _declared("mart_daily_sales"))
def kpi_declared(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpi_cards(marts.mart_daily_sales(fact(spark, folder)), CATALOG_BY_TABLE["mart_daily_sales"])


@query(f"WITH {sql.WAREHOUSE}, {sql.SUMMARY} " + _declared("mart_sales_summary"))
def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder))
    return reports.kpi_cards(rows, CATALOG_BY_TABLE["mart_sales_summary"])


@query(f"WITH {sql.WAREHOUSE}, {sql.CITY} " + _declared("mart_city_sales"))
def kpi_city(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.mart_city_sales(fact(spark, folder), _dim(spark, folder))
    return reports.kpi_cards(rows, CATALOG_BY_TABLE["mart_city_sales"])


@query(f"WITH {sql.WAREHOUSE}, {sql.LEVEL} " + _declared("mart_customer_level_sales"))
def kpi_customer_level(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.mart_customer_level_sales(fact(spark, folder), _dim(spark, folder))
    return reports.kpi_cards(rows, CATALOG_BY_TABLE["mart_customer_level_sales"])


_FIGURES = ["order_amount", "refund_amount", "net_amount"]


@query(
    f"""WITH {sql.PLACES}, {sql.ORDERS}, figures AS (
  SELECT 2 AS position, '∑ order_amount' AS label, sum(order_amount) AS v, 'sum of order_amount' AS hint FROM fact_orders
  UNION ALL SELECT 7, '∑ refund_amount', sum(refund_amount), 'sum of refund_amount' FROM fact_orders
  UNION ALL SELECT 8, '∑ net_amount', sum(net_amount), 'sum of net_amount' FROM fact_orders)
SELECT label, CAST(v AS DOUBLE) AS value, {sql.number_text('v')} AS text, hint FROM figures
UNION ALL SELECT 'rows', CAST(count(*) AS DOUBLE), {sql.number_text('count(*)')}, 'rows of the table' FROM fact_orders"""
)
def kpi_heuristic(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table declares no figures."""
    return reports.kpi_cards(fact(spark, folder), CATALOG_BY_TABLE["fact_orders"]).drop("position")


@query(
    f"""WITH raw AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) AS amount FROM orders),
shown AS (SELECT o_orderkey AS order_id, amount, amount * 100 AS large, -amount / 1000 AS small FROM raw)
SELECT order_id, {sql.number_text('amount')} AS amount_text, {sql.number_text('amount * 100')} AS large_text,
  {sql.number_text('-amount * CAST(0.001 AS DECIMAL(4,3))')} AS small_text,
  {sql.number_text('order_id')} AS id_text FROM shown"""
)
def kpi_formatted(spark: SparkSession, folder: str) -> DataFrame:
    """The short text of numbers of every size."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from salesloom.functions.money import number_text

    amount = F.col("o_totalprice").cast("decimal(18,4)")
    return adapters.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        number_text(amount).alias("amount_text"),
        number_text(amount * 100).alias("large_text"),
        number_text((-amount * F.lit(Decimal("0.001"))).cast("decimal(28,4)")).alias("small_text"),
        number_text(F.col("o_orderkey")).alias("id_text"),
    )


@query(
    f"""WITH {sql.PLACES}, {sql.ORDERS}, {sql.DAILY}
SELECT strftime(order_date, '%Y-%m-%d') AS label, CAST(net_sales AS DOUBLE) AS value FROM mart_daily_sales"""
)
def chart_series(spark: SparkSession, folder: str) -> DataFrame:
    return reports.chart_series(marts.mart_daily_sales(fact(spark, folder)), CATALOG_BY_TABLE["mart_daily_sales"])


@query(
    f"""WITH {sql.PLACES}, {sql.ORDERS}, {sql.DAILY}
SELECT CAST(sum(gross_merchandise_value) AS DOUBLE) AS total_gmv, CAST(sum(order_count) AS BIGINT) AS total_orders,
  CAST(sum(customer_count) AS BIGINT) AS total_customers,
  {sql.cents_mean('sum(CAST(average_order_value AS DECIMAL(18,2)))', 'count(*)')} AS average_order_value FROM mart_daily_sales"""
)
def dashboard_totals(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(reports.dashboard_totals(marts.mart_daily_sales(fact(spark, folder))))


@query(f"WITH {sql.PLACES}, {sql.ORDERS} SELECT count(DISTINCT customer_id) AS customer_count FROM fact_orders")
def distinct_customers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.distinct_customers(fact(spark, folder))


_PERIODS = """SELECT 'week' AS kind, date_trunc('week', order_date)::DATE AS period, currency_code, count(DISTINCT customer_id) AS distinct_customers
FROM fact_orders GROUP BY 2, 3 UNION ALL
SELECT 'month', date_trunc('month', order_date)::DATE, currency_code, count(DISTINCT customer_id) FROM fact_orders GROUP BY 2, 3"""


@query(f"WITH {sql.PLACES}, {sql.ORDERS} {_PERIODS}")
def period_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct customers of weeks and months out of the stored daily bitmaps of two loads, the orders being read once."""
    orders = fact(spark, folder)
    path = f"{shared_dir(spark, 'customer-bitmaps')}/days"
    loads = [customer_bitmaps.daily_customers(orders.filter(F.col("order_id") % 2 == part)) for part in (0, 1)]
    customer_bitmaps.merged_days(*loads).write.parquet(path)
    daily = spark.read.parquet(path)
    kinds = [
        customer_bitmaps.distinct_customers(daily, F.trunc("order_date", kind), "currency_code").select(F.lit(kind).alias("kind"), "*")
        for kind in ("week", "month")
    ]
    return kinds[0].unionByName(kinds[1])


_CITIES = f"""WITH {sql.WAREHOUSE}, {sql.CITY}, cities AS (
  SELECT city, sum(gross_merchandise_value) AS gmv, CAST(sum(order_count) AS BIGINT) AS order_count
  FROM mart_city_sales GROUP BY city)"""


@query(
    f"""{_CITIES} SELECT city, CAST(gmv AS DOUBLE) AS gross_merchandise_value, order_count,
  CAST(rank() OVER (ORDER BY gmv DESC) AS INTEGER) AS sales_rank FROM cities ORDER BY gmv DESC, city LIMIT 10"""
)
def city_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The ten leading cities."""
    return as_doubles(reports.city_ranking(marts.mart_city_sales(fact(spark, folder), _dim(spark, folder)), top=10))


@query(f"{_CITIES} SELECT city, CAST(gmv AS DOUBLE) AS gross_merchandise_value, order_count FROM cities")
def city_contribution(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(reports.city_ranking(marts.mart_city_sales(fact(spark, folder), _dim(spark, folder))))


@query(
    f"""WITH {sql.WAREHOUSE}, {sql.LEVEL}, levels AS (
  SELECT customer_level, sum(gross_merchandise_value) AS gmv FROM mart_customer_level_sales GROUP BY customer_level)
SELECT customer_level, CAST(gmv AS DOUBLE) AS gross_merchandise_value,
  round(CAST(gmv AS DOUBLE) / CAST((SELECT sum(gmv) FROM levels) AS DOUBLE), 6) AS sales_share FROM levels"""
)
def level_share(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(reports.level_share(marts.mart_customer_level_sales(fact(spark, folder), _dim(spark, folder))))


# The levels that the customers of the given tables have.
LEVELS = ("automobile", "building", "furniture", "household", "machinery")


@query(
    f"WITH {sql.WAREHOUSE}, {sql.SUMMARY} SELECT city, "
    + ", ".join(
        f"CAST(sum(net_sales) FILTER (customer_level = '{v}') AS DOUBLE) AS {v}_net_sales,"
        f" CAST(sum(order_count) FILTER (customer_level = '{v}') AS BIGINT) AS {v}_order_count"
        for v in LEVELS[:4]
    )
    + f""", CAST(sum(net_sales) FILTER (customer_level NOT IN {LEVELS[:4]}) AS DOUBLE) AS other_net_sales,
  CAST(sum(order_count) FILTER (customer_level NOT IN {LEVELS[:4]}) AS BIGINT) AS other_order_count"""
    + " FROM mart_sales_summary GROUP BY city"
)
def city_level_pivot(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder))
    return as_doubles(reports.city_level_pivot(rows, LEVELS[:4]))


@query(
    f"""WITH {sql.WAREHOUSE}, {sql.SUMMARY}, months AS (
  SELECT currency_code, order_month, sum(net_sales) AS net_sales, CAST(sum(order_count) AS BIGINT) AS order_count
  FROM mart_sales_summary GROUP BY currency_code, order_month),
averages AS (SELECT *, CAST((2 * CAST(net_sales * 100 AS HUGEINT) + order_count) // (2 * order_count) AS BIGINT) AS cents FROM months)
SELECT currency_code, order_month, CAST(net_sales AS DOUBLE) AS net_sales, order_count, cents / 100 AS average_order_value,
  (cents - lag(cents) OVER (PARTITION BY currency_code ORDER BY order_month)) / 100 AS average_order_value_change FROM averages"""
)
def month_trend(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(reports.month_trend(marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder))))


@query(
    f"""WITH {sql.WAREHOUSE}, {sql.SUMMARY} SELECT {sql.SUMMARY_OUT} FROM mart_sales_summary
WHERE order_month IN ('1998-01', '1998-02') AND city IN ('NATION_1', 'NATION_2') AND customer_level = 'building'"""
)
def dashboard_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder))
    return as_doubles(
        reports.dashboard_filter(rows, ("1998-01", "1998-02"), ("NATION_1", "NATION_2"), ("building",))
    )


@query(
    f"WITH {sql.PLACES}, {sql.ORDERS} SELECT {sql.ORDER_OUT} FROM stg_orders"
    " ORDER BY order_id, order_amount LIMIT 500"
)
def preview_limit(spark: SparkSession, folder: str) -> DataFrame:
    """The default preview of 500 rows, in key order so that it is repeatable."""
    rows = layers.stg_orders(adapters.raw_orders(spark, folder))
    return as_doubles(rows.orderBy("order_id", "order_amount").limit(row_limit()))
