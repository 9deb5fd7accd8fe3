"""File sinks: warehouse tables, CSV exports, JSON reports and snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators.incremental import unseen
from salesloom.session import shared_dir
from salesloom.sources.tables import Warehouse


def counted_write(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write rows and return their number, counted on the way and not by reading them again."""
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_table(warehouse: Warehouse, table: str, rows: DataFrame) -> DataFrame:
    """Create or replace a table and read it back, so later steps start from files."""
    path = warehouse.path(table)
    warehouse.counts[table] = counted_write(rows, lambda seen: seen.write.mode("overwrite").parquet(path))
    return warehouse.read(table)


def write_partitioned(warehouse: Warehouse, table: str, rows: DataFrame, column: str) -> DataFrame:
    """Create or replace a table in folders of one column.

    Rebalancing gives each folder few, evenly sized files and splits a folder that
    holds most of the rows over several tasks.
    """
    order = rows.columns
    path = warehouse.path(table)
    warehouse.counts[table] = counted_write(
        rows, lambda seen: seen.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
    )
    return warehouse.read(table).select(*order)


def append_unseen_orders(warehouse: Warehouse, incoming: DataFrame) -> int:
    """Append orders with new ids to raw_orders; returns how many. A repeated run appends nothing."""
    existing = warehouse.read("raw_orders")
    # Held as files: the batch is read for its bounds and for its rows, and its source is parsed once.
    arrived = f"{shared_dir(warehouse.spark, 'orders-batch')}/rows"
    incoming.write.parquet(arrived)
    fresh = unseen(existing, warehouse.spark.read.parquet(arrived)).select(*existing.columns)
    return counted_write(fresh, lambda seen: seen.write.mode("append").parquet(warehouse.path("raw_orders")))


def write_csv(rows: DataFrame, path: str) -> str:
    """CSV in the form that read_csv_text reads back: quotes doubled, line breaks and outer blanks kept."""
    csv = rows.write.mode("overwrite").option("header", True).option("escape", '"')
    csv.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def export_summary(summary: DataFrame, path: str) -> str:
    """The summary mart as CSV, sorted by month, city, level and currency.

    A range sort: a small mart is one file, a large one several files in order.
    """
    keys = ("order_month", "city", "customer_level", "currency_code")
    return write_csv(summary.orderBy(*[F.col(k).asc_nulls_last() for k in keys]), path)


def export_layer_backups(warehouse: Warehouse, backup: str) -> list[str]:
    """Every existing table as CSV under `<backup>/<layer>/<table>`; returns the paths."""
    return [
        write_csv(warehouse.read(table), f"{backup.rstrip('/')}/{layer}/{table}")
        for layer, tables in schemas.LAYERS.items()
        for table in tables
        if warehouse.exists(table)
    ]


def quality_document(checks: DataFrame) -> DataFrame:
    """Totals and the list of checks as one row. The list is as long as the rule set."""
    check = F.struct("check_name", "passed", "message", "failed_rows")
    return checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.bool_and("passed").alias("is_successful"),
        F.sort_array(F.collect_list(check)).alias("checks"),
    )


def write_quality_report(checks: DataFrame, path: str) -> DataFrame:
    """Write the report and return its checks as read back, so no check runs twice."""
    quality_document(checks).write.mode("overwrite").json(path)
    shape = (
        "total_checks bigint, passed_checks bigint, failed_checks bigint, is_successful boolean,"
        " checks array<struct<check_name: string, passed: boolean, message: string, failed_rows: bigint>>"
    )
    return checks.sparkSession.read.schema(shape).json(path).select(F.inline("checks"))


def append_snapshot(
    wide: DataFrame, path: str, day: str = "snapshot_day", log: str | None = None, shop_name: str = "", days: tuple[Column, Column] | None = None
) -> None:
    """Append the rows of a run to the JSON snapshot, in folders by day; nothing is rewritten.

    `log` names the folder of the commit log: one record a run, written behind the rows. Rows of a run without record (a job
    that died) are not part of the snapshot; see `read_snapshot`.
    """
    run_id = uuid.uuid4().hex
    added, spark = Observation(), wide.sparkSession
    stamped = wide.withColumn("snapshot_saved_at", F.current_timestamp()).withColumn("snapshot_run", F.lit(run_id))
    stamped = stamped.observe(added, F.count(F.lit(1)).alias("rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    stamped.hint("rebalance", day).write.mode("append").partitionBy(day).json(path)
    if log is None:
        return
    found = added.get
    first, last = days or (F.lit(found["first_day"]).cast("date"), F.lit(found["last_day"]).cast("date"))
    record = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(shop_name).alias("shop_name"), first.alias("first_day"), last.alias("last_day"),
        F.lit(found["rows"]).cast("bigint").alias("rows_added"), F.current_timestamp().alias("saved_at"),
    )
    record.coalesce(1).write.mode("append").json(log)


def snapshot_runs(spark: SparkSession, log: str) -> DataFrame:
    """The commit log of the snapshot: each run with shop, day range, rows added and the rows of the snapshot after it."""
    shape = "run_id string, shop_name string, first_day date, last_day date, rows_added bigint, saved_at timestamp"
    # One row a run: the log is as long as the snapshot has runs.
    until = Window.partitionBy("shop_name").orderBy("saved_at", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    return spark.read.schema(shape).json(log).withColumn("snapshot_total_orders", F.sum("rows_added").over(until))


def read_snapshot(spark: SparkSession, path: str, log: str | None = None) -> DataFrame:
    """The rows of the snapshot; with its log, those of committed runs only."""
    kinds = ", ".join(f"{name} {kind}" for name, kind in schemas.WIDE_ORDER_TYPES.items())
    rows = spark.read.schema(f"{kinds}, snapshot_saved_at timestamp, snapshot_run string, snapshot_day date").json(path)
    if log is None:
        return rows
    runs = snapshot_runs(spark, log).select(F.col("run_id").alias("snapshot_run"))
    return rows.join(runs, "snapshot_run", "left_semi").select(*rows.columns)


def append_run_log(warehouse: Warehouse, path: str, source: str, started: datetime, problem: str | None = None) -> None:
    """Append one row for each table that a run wrote (one without table, if none) to the run log."""
    run_id, spark = uuid.uuid4().hex, warehouse.spark
    rows = [(run_id, source, started, problem, name, n) for name, n in (warehouse.counts.items() or [(None, None)])]
    shape = "run_id string, data_source string, started_at timestamp, problem string, table_name string, row_count bigint"
    log = spark.createDataFrame(rows, shape).withColumn("finished_at", F.current_timestamp())
    log.coalesce(1).write.mode("append").json(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The run log with the number of each run, in the order of their starts."""
    shape = (
        "run_id string, data_source string, started_at timestamp, finished_at timestamp, problem string, table_name string, row_count bigint"
    )
    log = spark.read.schema(shape).json(path)
    # One row a run.
    numbered = log.select("run_id", "started_at", "data_source").distinct().withColumn(
        "run_number", F.row_number().over(Window.partitionBy("data_source").orderBy("started_at", "run_id"))
    )
    return log.join(numbered.select("run_id", "run_number"), "run_id")


def snapshot_summary(snapshot: DataFrame, shop_label: Column | str) -> DataFrame:
    """What the snapshot holds per day."""
    label = F.lit(shop_label) if isinstance(shop_label, str) else shop_label
    return snapshot.groupBy("snapshot_day").agg(
        F.count("*").alias("snapshot_day_order_count"), F.max(label).alias("shop_label")
    )


def export_products(nodes: DataFrame, path: str, store_domain: str) -> DataFrame:
    """Product nodes as JSON lines in `products`, one meta row in `meta`; returns the meta row."""
    nodes.select("node.*").write.mode("overwrite").json(f"{path}/products")
    written = nodes.sparkSession.read.text(f"{path}/products")
    meta = written.agg(F.count("*").alias("product_count")).select(
        F.current_timestamp().alias("exported_at"), F.lit(store_domain).alias("store_domain"), "product_count"
    )
    meta.write.mode("overwrite").json(f"{path}/meta")
    return nodes.sparkSession.read.json(f"{path}/meta")


def _versioned(rows: DataFrame) -> DataFrame:
    """The wide columns with version and place in the page; rows without a version take their update text as UTC."""
    version = F.col("version_at") if "version_at" in rows.columns else F.to_timestamp("updated_at", "yyyy-MM-dd HH:mm:ss")
    edge = F.col("edge") if "edge" in rows.columns else F.lit(0)
    return rows.select(*schemas.WIDE_ORDER_COLUMNS, version.alias("version_at"), edge.cast("int").alias("edge"))


def upsert_wide(warehouse: Warehouse, incoming: DataFrame) -> int:
    """Add the incoming orders to raw_shopify_orders; returns the orders written.

    Only the batch is written; readers take the latest point in time of every order. Of equal ones the later batch
    wins, and within a batch the later place in its page. Upserts are idempotent: a run that dies is run again.
    """
    return warehouse.versioned("raw_shopify_orders").upsert(_versioned(incoming))


def compact_wide(warehouse: Warehouse, everything: bool = False) -> int:
    """Merge the youngest batches of the wide table (or all) into one folder: a job of its own, beside running syncs."""
    return warehouse.versioned("raw_shopify_orders").compact(everything)


def read_wide(warehouse: Warehouse) -> DataFrame:
    return warehouse.read("raw_shopify_orders").select(*schemas.WIDE_ORDER_COLUMNS)
