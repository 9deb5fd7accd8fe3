"""Exports, backups, snapshots and streams: written, read back and compared with the plain SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from querybook import adapters
from querybook import sql_parts as sql
from querybook.registry import query
from querybook.warehouse_queries import _SPLIT, _dim, dirty_customers, fact, split_orders
from salesloom import schemas
from salesloom.functions.money import MONEY, as_doubles
from salesloom.operators import layers, marts
from salesloom.operators.wide import wide_orders
from salesloom.plans.run import Paths, RunOptions, run
from salesloom.plans.warehouse import write_warehouse
from salesloom.session import shared_dir
from salesloom.sinks import files
from salesloom.sinks.versioned import VersionedTable
from salesloom.sources import csv_files, pages
from salesloom.sources.tables import Warehouse
from salesloom.streaming import event_days, jobs

_SUMMARY_TYPES = (
    "summary_key string, city string, customer_level string, order_month string, currency_code string, order_count bigint,"
    " gross_sales decimal(28,2), total_refunds decimal(28,2), net_sales decimal(28,2), avg_order_amount decimal(28,2)"
)


@query(f"WITH {sql.WAREHOUSE}, {sql.SUMMARY} SELECT {sql.SUMMARY_OUT} FROM mart_sales_summary")
def export_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The sorted CSV export of the summary."""
    path = f"{shared_dir(spark, 'export')}/sales_summary.csv"
    files.export_summary(marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder)), path)
    return as_doubles(spark.read.option("header", True).schema(_SUMMARY_TYPES).csv(path))


def _written(spark: SparkSession, folder: str) -> Warehouse:
    warehouse = Warehouse(spark, shared_dir(spark, "warehouse"))
    files.write_table(warehouse, "raw_customers", adapters.raw_customers(spark, folder))
    files.write_table(warehouse, "raw_orders", adapters.raw_orders(spark, folder))
    write_warehouse(warehouse)
    return warehouse


@query(
    f"WITH {sql.WAREHOUSE}, {sql.SUMMARY}, {sql.DAILY}, {sql.CITY}, {sql.LEVEL} "
    + " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS row_count FROM {table}"
        for layer, tables in schemas.LAYERS.items()
        for table in tables
        if table != "raw_shopify_orders"
    )
)
def backup_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The whole warehouse written, backed up as CSV, and counted from the backup."""
    warehouse = _written(spark, folder)
    backup = shared_dir(spark, "backup")
    counts = None
    for path in files.export_layer_backups(warehouse, backup):
        layer, table = path.split("/")[-2:]
        count = spark.read.option("header", True).csv(path).agg(F.count("*").alias("row_count"))
        row = count.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
        counts = row if counts is None else counts.unionByName(row)
    return counts


@query(
    "SELECT CAST(ts AS DATE) AS snapshot_day, 'gid://shop/Order/' || user_id AS shopify_gid, 'E' || event_id AS order_id,"
    " CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS total_price FROM events"
)
def snapshot_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to the day snapshot: up to the 15th, and the rest."""
    path = shared_dir(spark, "snapshot")
    updates = wide_orders(pages.order_nodes(adapters.event_pages(spark, folder)), "demo", keep=("day",))
    for run in (F.col("day") <= "2024-01-15", F.col("day") > "2024-01-15"):
        files.append_snapshot(updates.filter(run).withColumnRenamed("day", "snapshot_day"), path)
    stored = files.read_snapshot(spark, path)
    return as_doubles(stored.select("snapshot_day", "shopify_gid", "order_id", "total_price"))


_RUNS = "(VALUES (1, DATE '2024-01-15', DATE '1900-01-01'), (2, DATE '2999-01-01', DATE '2024-01-10'))"


@query(
    f"""WITH runs AS (SELECT r.n AS run_number, count(*) AS rows_added, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day
  FROM events JOIN {_RUNS} r(n, until, since) ON CAST(ts AS DATE) BETWEEN r.since AND r.until GROUP BY r.n)
SELECT run_number::INTEGER AS run_number, 'demo' AS shop_name, first_day, last_day, rows_added,
  CAST(sum(rows_added) OVER (ORDER BY run_number) AS BIGINT) AS snapshot_total_orders FROM runs"""
)
def snapshot_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The commit log of two snapshot runs whose days overlap: range, rows and running total of each run."""
    path, log = shared_dir(spark, "snapshot"), shared_dir(spark, "snapshot-log")
    updates = wide_orders(pages.order_nodes(adapters.event_pages(spark, folder)), "demo", keep=("day",))
    for run in (F.col("day") <= "2024-01-15", F.col("day") >= "2024-01-10"):
        files.append_snapshot(updates.filter(run).withColumnRenamed("day", "snapshot_day"), path, log=log, shop_name="demo")
    number = F.row_number().over(Window.partitionBy("shop_name").orderBy("saved_at"))
    return files.snapshot_runs(spark, log).select(
        number.alias("run_number"), "shop_name", "first_day", "last_day", "rows_added", "snapshot_total_orders"
    )


@query(
    "SELECT 'gid://shop/Order/' || user_id AS shopify_gid, max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS updated_at,"
    " 1::BIGINT AS row_count FROM events GROUP BY user_id"
)
def wide_table_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two sync runs into the wide table, the second overlapping the first; updates come with three offsets, some without a
    creation time, and the latest point in time wins."""
    warehouse = Warehouse(spark, shared_dir(spark, "warehouse"))
    documents = adapters.event_pages(spark, folder)
    for run in (F.col("day") <= "2024-01-20", F.col("day") >= "2024-01-15"):
        nodes = pages.order_nodes(documents.filter(run), position="edge")
        files.upsert_wide(warehouse, wide_orders(nodes, "demo", keep=("edge",), versioned=True))
    files.compact_wide(warehouse)
    stored = warehouse.read("raw_shopify_orders")
    moment = F.date_format(F.max("version_at"), "yyyy-MM-dd HH:mm:ss")
    return stored.groupBy("shopify_gid").agg(moment.alias("updated_at"), F.count("*").alias("row_count"))


# ---- streams ---------------------------------------------------------------


def _stored(spark: SparkSession, rows: DataFrame, name: str) -> tuple[str, DataFrame]:
    """Rows written to the shared folder, as the files that a stream picks up."""
    path = f"{shared_dir(spark, name)}/rows"
    rows.write.parquet(path)
    return path, spark.read.parquet(path)


def _event_pattern(folder: str) -> str:
    """The events table as a pattern, which streams accept for a file as well as for a folder."""
    return f"{folder}/events.parque[t]"


@query(f"WITH {sql.PLACES}, {sql.RAW_ORDERS}, {_SPLIT} SELECT {sql.RAW_OUT} FROM unseen")
def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Unseen orders out of a file stream in several micro-batches: copies of an order come in one batch, as in the batch job."""
    existing, incoming = split_orders(spark, folder)
    path, stored = _stored(spark, incoming.repartition(4, "order_id"), "incoming")
    out, checkpoint = shared_dir(spark, "stream-append"), shared_dir(spark, "stream-append-state")
    jobs.land_unseen(jobs.file_stream(spark, path, stored.schema, max_files=1), existing, out, checkpoint).awaitTermination()
    return as_doubles(jobs.landed(spark, out).drop("batch_id"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_without_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    events = adapters.table(spark, folder, "events")
    stream = jobs.file_stream(spark, _event_pattern(folder), events.schema)
    twice = stream.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    kept = jobs.without_repeats(twice.withColumn("ts", F.col("ts").cast("timestamp")), ["event_id"], "ts", "40 days")
    out, checkpoint = shared_dir(spark, "stream-once"), shared_dir(spark, "stream-once-state")
    jobs.land(kept, out, checkpoint).awaitTermination()
    return jobs.landed(spark, out).select("event_id", "user_id", "event_type", "value")


@query(
    "SELECT user_id, event_id, ts, event_type, value FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Four micro-batches of events merged by user, the folders compacted on the way."""
    events = adapters.table(spark, folder, "events")
    path, events = _stored(spark, events.repartition(4, F.xxhash64("event_id")), "events")
    stream = jobs.file_stream(spark, path, events.schema, max_files=1).select("user_id", "event_id", "ts", "event_type", "value")
    table = VersionedTable(spark, shared_dir(spark, "stream-upsert"), ("user_id",), ("ts", "event_id"))
    jobs.merge_latest(stream, table, shared_dir(spark, "stream-upsert-state"), "events", compact_every=2).awaitTermination()
    return table.read()


@query(
    f"""SELECT CAST(ts AS DATE) AS order_date, strftime(ts, '%Y-%m') AS order_month, event_type AS currency_code,
  count(*) AS order_count, count(DISTINCT user_id) AS customer_count,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS gross_merchandise_value, 0.0::DOUBLE AS total_refunds,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS net_sales,
  {sql.cents_mean('sum(CAST(value AS DECIMAL(18,2)))', 'count(*)')} AS average_order_value
FROM events GROUP BY 1, 2, 3"""
)
def stream_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The daily mart over a stream of events in several micro-batches, days out of order, with exact customer counts."""
    parts = adapters.table(spark, folder, "events").repartition(4, F.xxhash64("event_id"))
    path, events = _stored(spark, parts, "events")
    amount = F.col("value").cast(MONEY)
    orders = jobs.file_stream(spark, path, events.schema, max_files=1).select(
        F.col("ts").cast("timestamp").alias("order_time"), F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("currency_code"), amount.alias("order_amount"),
        F.lit(0).cast(MONEY).alias("refund_amount"), amount.alias("net_amount"),
    )
    out, checkpoint = shared_dir(spark, "stream-daily"), shared_dir(spark, "stream-daily-state")
    jobs.land_customer_days(orders, out, checkpoint).awaitTermination()
    return as_doubles(jobs.daily_sales_of_stream(spark, out))


_DELIVERIES = ("2024-01-12", "2024-01-22")


@query(
    f"""WITH dealt AS (SELECT *, CAST(ts AS DATE) AS day, least(3, 1 + (ts >= DATE '{_DELIVERIES[0]}')::INT + (ts >= DATE '{_DELIVERIES[1]}')::INT
    + (event_id % 10 = 0)::INT) AS delivery FROM events),
numbers AS (SELECT unnest([1, 2, 3]) AS number),
marks AS (SELECT number, CAST(max(ts) - INTERVAL 2 DAY AS DATE) AS open_from FROM numbers LEFT JOIN dealt ON delivery < number GROUP BY number),
judged AS (SELECT d.*, CASE WHEN day < open_from THEN 'late' WHEN day < (SELECT CAST(max(ts) - INTERVAL 2 DAY AS DATE) FROM events) THEN 'closed' ELSE 'open' END AS state
  FROM dealt d JOIN marks ON number = delivery)
SELECT state, day AS order_date, event_type AS currency_code, count(*) AS order_count, count(DISTINCT user_id) AS customer_count,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS gross_merchandise_value FROM judged GROUP BY 1, 2, 3"""
)
def stream_event_days(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries of events, one in ten a delivery late: days closed behind the watermark, open days, and what came too late."""
    events = adapters.table(spark, folder, "events")
    behind = [(F.col("ts") >= F.lit(day).cast("date")).cast("int") for day in _DELIVERIES]
    delivery = F.least(F.lit(3), 1 + behind[0] + behind[1] + (F.col("event_id") % 10 == 0).cast("int"))
    path, out, state = f"{shared_dir(spark, 'deliveries')}/rows", shared_dir(spark, "stream-days-out"), shared_dir(spark, "stream-days-clock")
    for number in (1, 2, 3):
        events.filter(delivery == number).write.mode("append").parquet(path)
        amount = F.col("value").cast(MONEY)
        orders = jobs.file_stream(spark, path, events.schema).select(
            F.col("ts").cast("timestamp").alias("order_time"), F.col("user_id").alias("customer_id"),
            F.col("event_type").alias("currency_code"), amount.alias("order_amount"),
            F.lit(0).cast(MONEY).alias("refund_amount"), amount.alias("net_amount"),
        )
        event_days.land_event_days(orders, out, state).awaitTermination()
    late = event_days.late_rows(spark, out).groupBy(F.col("order_time").cast("date").alias("order_date"), "currency_code").agg(
        F.count("*").alias("order_count"), F.countDistinct("customer_id").alias("customer_count"), F.sum("order_amount").alias("gross_merchandise_value"))
    shown = ["order_date", "currency_code", "order_count", "customer_count", "gross_merchandise_value"]
    parts = {"closed": event_days.closed_days(spark, out), "open": event_days.open_days(spark, out), "late": late}
    rows = [found.select(F.lit(name).alias("state"), *shown) for name, found in parts.items() if found is not None]
    return as_doubles(reduce(DataFrame.unionByName, rows))


@query(
    f"""WITH {sql.PLACES}, {sql.BASE_ORDERS}, staged AS (
  SELECT order_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN o_orderstatus = 'F' THEN -order_amount ELSE order_amount END AS order_amount FROM base_orders)
SELECT order_id, s.customer_id, CAST(order_amount AS DOUBLE) AS order_amount,
  CASE WHEN s.customer_id IS NULL THEN 'no customer' WHEN order_amount <= 0 THEN 'amount not positive'
    WHEN c_custkey IS NULL THEN 'unknown customer' END AS reject_reason
FROM staged s LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON s.customer_id = c_custkey"""
)
def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    from querybook.warehouse_queries import dirty_orders

    path, stored = _stored(spark, dirty_orders(spark, folder).select("order_id", "customer_id", "order_amount"), "dirty")
    out, checkpoint = shared_dir(spark, "stream-rejects"), shared_dir(spark, "stream-rejects-state")
    stream = jobs.file_stream(spark, path, stored.schema)
    jobs.land_checked(stream, dirty_customers(spark, folder), out, checkpoint).awaitTermination()
    return as_doubles(jobs.landed(spark, out).drop("batch_id"))


@query(
    "SELECT 'gid://shop/Order/' || user_id AS shopify_gid, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS updated_at,"
    " max(CAST(ts AS DATE)) AS day FROM events GROUP BY user_id"
)
def stream_day_sync(spark: SparkSession, folder: str) -> DataFrame:
    """Order pages in day folders, streamed into the latest wide rows."""
    root = f"{shared_dir(spark, 'pages')}/orders"
    documents = adapters.event_pages(spark, folder).withColumnRenamed("document", "value")
    documents.hint("rebalance", "day").write.partitionBy("day").text(root)
    table = VersionedTable(spark, shared_dir(spark, "stream-days"), ("shopify_gid",), ("version_at", "edge"))
    stream = jobs.page_stream(spark, root, max_files=20)
    jobs.merge_wide_orders(stream, "demo", table, shared_dir(spark, "stream-days-state")).awaitTermination()
    return table.read().select("shopify_gid", F.date_format("version_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"), "day")


# ---- CSV and the run --------------------------------------------------------

_AWKWARD = "'\"' || n_name || '\", ' || chr(10) || ' '"


@query(
    f"""WITH {sql.PLACES} SELECT c_custkey AS customer_id, c_name || {_AWKWARD} AS customer_name, ' ' || n_name || ' ' AS city,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS customer_level, c_acctbal::VARCHAR AS note FROM places"""
)
def csv_customers_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with quotes, commas, line breaks and outer blanks, written as CSV and loaded from it."""
    awkward = F.concat("c_name", F.lit('"'), "n_name", F.lit('", '), F.lit("\n"), F.lit(" "))
    rows = adapters.places(spark, folder).select(
        F.col("c_custkey").alias("customer_id"), awkward.alias("customer_name"),
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("city"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("customer_level"),
        F.col("c_acctbal").cast("string").alias("note"),
    )
    path = files.write_csv(rows, f"{shared_dir(spark, 'csv')}/customers")
    return csv_files.customers_csv(spark, path, multiline=True)


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DOUBLE) AS order_amount,
  CAST(o_orderdate AS DATE) AS order_date, 'CNY' AS currency_code, 'UNKNOWN' AS ship_country, 0.0::DOUBLE AS refund_amount FROM orders"""
)
def csv_orders_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as CSV, dates with slashes for some, loaded with the constants of file orders."""
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "yyyy/M/d")).otherwise(day.cast("string"))
    rows = adapters.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"), text.alias("order_date"),
    )
    path = files.write_csv(rows, f"{shared_dir(spark, 'csv')}/orders")
    return as_doubles(csv_files.orders_csv(spark, path))


@query(
    """WITH sums AS (SELECT o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice > 0)
SELECT CAST(o_orderdate AS DATE) AS order_date, strftime(o_orderdate, '%Y-%m') AS order_month, 'CNY' AS currency_code,
  count(*) AS order_count, count(DISTINCT o_custkey) AS customer_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_merchandise_value, 0.0::DOUBLE AS total_refunds,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS net_sales, """
    + sql.cents_mean("sum(CAST(o_totalprice AS DECIMAL(18,2)))", "count(*)")
    + " AS average_order_value FROM sums GROUP BY 1, 2, 3"
)
def full_then_incremental_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two whole runs from CSV: the first half of the orders, then all of them incrementally; the stored daily mart."""
    return as_doubles(Warehouse(spark, _two_runs(spark, folder).warehouse).read("mart_daily_sales"))


def _two_runs(spark: SparkSession, folder: str) -> Paths:
    paths = Paths(shared_dir(spark, "run"))
    customers = adapters.places(spark, folder).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("customer_level"),
    )
    orders = adapters.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"), F.col("o_orderdate").cast("date").alias("order_date"),
    )
    files.write_csv(customers, paths.customers)
    for rows, incremental in ((orders.filter(F.col("order_id") % 2 == 0), False), (orders, True)):
        files.write_csv(rows, paths.orders)
        run(spark, paths, RunOptions(incremental_load=incremental, export_layer_backups=False))
    return paths


@query(
    """WITH runs AS (SELECT 1 AS run_number, 2 AS step UNION ALL SELECT 2, 1),
loaded AS (SELECT run_number, o.* FROM runs JOIN orders o ON o.o_orderkey % step = 0),
counts AS (SELECT run_number, 'raw_customers' AS table_name, (SELECT count(*) FROM customer) AS row_count FROM runs
  UNION ALL SELECT run_number, 'dim_customers', (SELECT count(*) FROM customer) FROM runs
  UNION ALL SELECT run_number, 'raw_orders', count(*) FILTER (WHERE run_number = 1 OR o_orderkey % 2 <> 0) FROM loaded GROUP BY run_number
  UNION ALL SELECT run_number, 'fact_orders', count(*) FILTER (WHERE o_totalprice > 0) FROM loaded GROUP BY run_number
  UNION ALL SELECT run_number, 'mart_daily_sales', count(DISTINCT CAST(o_orderdate AS DATE)) FILTER (WHERE o_totalprice > 0) FROM loaded GROUP BY run_number)
SELECT run_number::INTEGER AS run_number, 'csv' AS data_source, table_name, row_count, true AS succeeded FROM counts"""
)
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """What two whole runs logged: rows written to each table, counted by the writes."""
    log = files.read_run_log(spark, _two_runs(spark, folder).run_log)
    shown = log.filter(F.col("table_name").isin("raw_customers", "dim_customers", "raw_orders", "fact_orders", "mart_daily_sales"))
    return shown.select("run_number", "data_source", "table_name", "row_count", F.col("problem").isNull().alias("succeeded"))


@query(
    """WITH hours AS (SELECT DISTINCT CAST(ts AS DATE) AS day, hour(ts) AS h FROM events),
kept AS (SELECT * FROM hours WHERE NOT (day(day) % 5 = 0 AND h = 7) AND NOT (day(day) % 7 = 0 AND h = 23)),
chained AS (SELECT k.day, k.h > 0 AND p.h IS NULL AS gap, k.h < 23 AND n.h IS NULL AS open_end
  FROM kept k LEFT JOIN kept p ON p.day = k.day AND p.h = k.h - 1 LEFT JOIN kept n ON n.day = k.day AND n.h = k.h + 1)
SELECT day, count(*) AS page_count, count(*) FILTER (WHERE gap) AS gaps, count(*) FILTER (WHERE open_end) AS open_ends,
  NOT bool_or(gap OR open_end) AS complete FROM chained GROUP BY day"""
)
def page_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly pages of each day, some twice, some missing: which days are whole."""
    hour, day = F.hour("ts"), F.dayofmonth("ts")
    kept = ~((day % 5 == 0) & (hour == 7)) & ~((day % 7 == 0) & (hour == 23))
    events = adapters.table(spark, folder, "events").filter(kept)
    info = F.struct((hour < 23).alias("hasNextPage"), F.concat(F.lit("h"), hour).alias("endCursor"))
    answer = F.struct(F.struct(F.struct(F.array().cast("array<string>").alias("edges"), info.alias("pageInfo")).alias("orders")).alias("data"))
    page = F.struct(F.when(hour > 0, F.concat(F.lit("h"), hour - 1)).alias("after"), answer["data"].alias("data"))
    # Every event of an hour delivers that hour's page once more.
    documents = events.select(F.to_json(page).alias("document"), F.col("ts").cast("date").alias("day"))
    return pages.page_chains(documents, "orders")


@query(
    """SELECT 'E' || event_id AS order_id, CASE event_id % 10 WHEN 0 THEN 'no readable list of orders' WHEN 1 THEN 'error answer'
  END AS reject_reason FROM events"""
)
def page_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Good, cut off and error pages: the nodes of the good ones, and each other page with its reason."""
    recorded = adapters.event_pages(spark, folder).withColumn("number", F.regexp_extract("document", '"name":"E([0-9]+)"', 1))
    kind = F.col("number").cast("bigint") % 10
    broken = F.expr("left(document, length(document) - 4)")
    error = F.lit('{"errors":[{"message":"throttled"}],"data":null}')
    recorded = recorded.withColumn("document", F.when(kind == 0, broken).when(kind == 1, error).otherwise(F.col("document")))
    good = pages.order_nodes(recorded, on_fault="skip").select(F.col("node.name").alias("order_id"), F.lit(None).cast("string").alias("reject_reason"))
    rejected = pages.rejected_pages(recorded, "orders").select(
        F.concat(F.lit("E"), "number").alias("order_id"), F.regexp_extract("reject_reason", "^[^:]+", 0).alias("reject_reason")
    )
    return good.unionByName(rejected)
