"""The end-to-end run: source, layers, checks, exports, publishing."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import incremental, narrow, quality
from salesloom.operators.wide import wide_orders
from salesloom.plans.warehouse import write_warehouse
from salesloom.session import configure
from salesloom.sinks import database, files
from salesloom.sources import csv_files, inbox, pages
from salesloom.sources.tables import Warehouse


@dataclass(frozen=True)
class Paths:
    """Where a run reads and writes; all folders live on storage that the cluster shares."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def customers(self) -> str:
        return self.at("raw", "customers.csv")

    @property
    def orders(self) -> str:
        return self.at("raw", "orders.csv")

    @property
    def inbox(self) -> str:
        return self.at("inbox")

    @property
    def order_pages(self) -> str:
        return self.at("pages", "orders")

    @property
    def product_pages(self) -> str:
        return self.at("pages", "products")

    @property
    def products(self) -> str:
        return self.at("products", "storefront_products.json")

    @property
    def snapshot(self) -> str:
        return self.at("orders", "shopify_orders_snapshot.json")

    @property
    def snapshot_log(self) -> str:
        return self.at("orders", "shopify_orders_runs")

    @property
    def run_log(self) -> str:
        return self.at("output", "run_log")

    @property
    def warehouse(self) -> str:
        return self.at("warehouse")

    @property
    def backup(self) -> str:
        return self.at("backup")

    @property
    def summary_export(self) -> str:
        return self.at("output", "sales_summary.csv")

    @property
    def quality_report(self) -> str:
        return self.at("output", "quality_report.json")


@dataclass(frozen=True)
class RunOptions:
    target: str = "files"
    data_source: str = "csv"
    export_summary: bool = True
    export_layer_backups: bool = True
    fail_on_quality_error: bool = True
    incremental_load: bool = False
    shopify_sync_days: int | None = None
    end_day: date | None = None
    shop_name: str = "shopify_store"
    page_per_line: bool = True
    write_snapshot: bool = True
    table_prefix: str = ""


@dataclass(frozen=True)
class RunResult:
    target: str
    data_source: str
    loaded_sources: list[str]
    incremental_load: bool
    inserted_order_rows: int
    quality_passed: bool
    quality_report_path: str
    export_path: str
    published_tables: list[str] = field(default_factory=list)
    layer_backup_paths: list[str] = field(default_factory=list)
    inbox_customer_rows: int | None = None
    inbox_order_rows: int | None = None
    shopify_customer_rows: int | None = None
    shopify_order_rows: int | None = None
    shopify_wide_orders_merged: int | None = None


class IncompletePages(ValueError):
    """The pages of a day break off or leave out others."""


def materialize_inbox(spark: SparkSession, paths: Paths) -> tuple[int, int]:
    """Normalised inbox rows as raw CSV; returns the customer and order counts."""
    customers, orders = inbox.read_inbox(spark, paths.inbox)
    files.write_csv(customers, paths.customers)
    files.write_csv(orders, paths.orders)
    return (
        csv_files.read_csv_text(spark, paths.customers, multiline=True).count(),
        csv_files.read_csv_text(spark, paths.orders, multiline=True).count(),
    )


def load_raw(warehouse: Warehouse, paths: Paths, incremental_load: bool, multiline: bool = False) -> int:
    """CSV files to the raw tables; returns the order rows added.

    Customers are always replaced. Orders are replaced too, unless the load is
    incremental and the table exists.
    """
    spark = warehouse.spark
    files.write_table(warehouse, "raw_customers", csv_files.customers_csv(spark, paths.customers, multiline=multiline))
    incoming = csv_files.orders_csv(spark, paths.orders, multiline=multiline)
    if incremental_load and warehouse.exists("raw_orders"):
        warehouse.counts["raw_orders"] = files.append_unseen_orders(warehouse, incoming)
    else:
        files.write_table(warehouse, "raw_orders", incoming)
    return warehouse.counts["raw_orders"]


def sync_orders(warehouse: Warehouse, paths: Paths, options: RunOptions) -> DataFrame:
    """Order pages of the last days into the wide table and the two raw tables; returns the new wide rows.

    All days are read in one job; the day folders outside the range are not listed as input.
    """
    spark = warehouse.spark
    days = incremental.look_back_days(options.shopify_sync_days)
    last = F.lit(options.end_day) if options.end_day else F.current_date()
    recorded = pages.read_pages(spark, paths.order_pages, options.page_per_line)
    wanted = recorded.filter(F.col("day").between(F.date_sub(last, days - 1), last))
    # One row a day of the look-back at most.
    broken = pages.page_chains(wanted, "orders").filter(~F.col("complete")).orderBy("day").collect()
    if broken:
        found = ", ".join(f"{r.day}: {r.page_count} pages, {r.gaps} gaps, {r.open_ends} open ends" for r in broken)
        raise IncompletePages(f"recorded pages are incomplete ({found})")
    nodes = pages.order_nodes(wanted, position="edge")
    wide = wide_orders(nodes, options.shop_name, keep=("day", "edge"), versioned=True)
    arrived = f"{files.shared_dir(spark, 'order-sync')}/rows"
    warehouse.counts["synced_orders"] = files.counted_write(wide, lambda seen: seen.write.parquet(arrived))
    rows = spark.read.parquet(arrived)
    warehouse.counts["raw_shopify_orders"] = files.upsert_wide(warehouse, rows)
    if options.write_snapshot:
        stamped = rows.drop("edge", "version_at").withColumnRenamed("day", "snapshot_day")
        files.append_snapshot(
            stamped, paths.snapshot, log=paths.snapshot_log, shop_name=options.shop_name, days=(F.date_sub(last, days - 1), last)
        )
    table = files.read_wide(warehouse)
    files.write_table(warehouse, "raw_orders", narrow.narrow_orders(table))
    files.write_table(warehouse, "raw_customers", narrow.narrow_customers(table))
    return rows


def day_summary(synced: DataFrame) -> DataFrame:
    """Orders and distinct orders per synced day."""
    return synced.groupBy("day").agg(
        F.count("*").alias("orders_merged"), F.count_distinct("shopify_gid").alias("distinct_orders")
    )


def run(
    spark: SparkSession,
    paths: Paths,
    options: RunOptions = RunOptions(),
    write_database: database.TableWriter | None = None,
    run_in_transaction: database.StatementRunner | None = None,
) -> RunResult:
    """One full run. A failed check stops it after the report is written, before exports and publishing.

    Each run appends to the run log what it wrote, table by table, counted by the writes themselves; a failed run is logged as such.
    """
    configure(spark)
    warehouse = Warehouse(spark, paths.warehouse)
    started = datetime.now(timezone.utc)
    try:
        result = _run(warehouse, paths, options, write_database, run_in_transaction)
    except Exception as error:
        files.append_run_log(warehouse, paths.run_log, options.data_source, started, f"{type(error).__name__}: {error}"[:500])
        raise
    files.append_run_log(warehouse, paths.run_log, options.data_source, started)
    return result


def _run(
    warehouse: Warehouse,
    paths: Paths,
    options: RunOptions,
    write_database: database.TableWriter | None,
    run_in_transaction: database.StatementRunner | None,
) -> RunResult:
    spark = warehouse.spark
    if options.target == "postgres" and (write_database is None or run_in_transaction is None):
        raise ValueError("target postgres needs a table writer and a statement runner")
    counts: dict[str, int] = {}

    if options.data_source == "shopify":
        synced = sync_orders(warehouse, paths, options)
        loaded = ["shopify_orders_wide"]
        inserted = warehouse.counts["raw_orders"]
        counts = {
            "shopify_wide_orders_merged": warehouse.counts["synced_orders"],
            "shopify_customer_rows": warehouse.counts["raw_customers"],
            "shopify_order_rows": inserted,
        }
    else:
        if options.data_source == "inbox":
            customers, orders = materialize_inbox(spark, paths)
            counts = {"inbox_customer_rows": customers, "inbox_order_rows": orders}
        loaded = csv_files.validate_sources(spark, {"customers": paths.customers, "orders": paths.orders})
        # What the inbox wrote lies in many files, so reading them whole costs no parallel work.
        inserted = load_raw(warehouse, paths, options.incremental_load, multiline=options.data_source == "inbox")

    tables = write_warehouse(warehouse)
    checks = files.write_quality_report(quality.quality_checks(spark, tables), paths.quality_report)
    if options.fail_on_quality_error:
        quality.raise_for_failed(checks)

    if options.export_summary:
        files.export_summary(tables["mart_sales_summary"], paths.summary_export)
    backups = files.export_layer_backups(warehouse, paths.backup) if options.export_layer_backups else []
    published: list[str] = []
    if options.target == "postgres":
        if options.data_source == "shopify":
            wide = files.read_wide(warehouse).join(synced.select(*schemas.WIDE_KEY).distinct(), list(schemas.WIDE_KEY), "left_semi")
            database.publish_wide(wide, write_database, run_in_transaction, options.table_prefix)
        published = database.publish(tables, write_database, run_in_transaction, options.table_prefix)

    return RunResult(
        target=options.target,
        data_source=options.data_source,
        loaded_sources=loaded,
        incremental_load=options.incremental_load,
        inserted_order_rows=inserted,
        quality_passed=checks.filter(~F.col("passed")).isEmpty(),
        quality_report_path=paths.quality_report,
        export_path=paths.summary_export,
        published_tables=published,
        layer_backup_paths=backups,
        **counts,
    )


def run_inbox_to_files(spark: SparkSession, paths: Paths, **options: object) -> RunResult:
    return run(spark, paths, RunOptions(target="files", data_source="inbox", **options))


def run_inbox_to_database(
    spark: SparkSession,
    paths: Paths,
    write_database: database.TableWriter,
    run_in_transaction: database.StatementRunner,
    **options: object,
) -> RunResult:
    chosen = RunOptions(target="postgres", data_source="inbox", **options)
    return run(spark, paths, chosen, write_database, run_in_transaction)


def run_csv_to_database(
    spark: SparkSession,
    paths: Paths,
    write_database: database.TableWriter,
    run_in_transaction: database.StatementRunner,
    **options: object,
) -> RunResult:
    chosen = RunOptions(target="postgres", data_source="csv", **options)
    return run(spark, paths, chosen, write_database, run_in_transaction)


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    """Flags of the spark-submit entry."""
    parser = argparse.ArgumentParser(description="Run the sales warehouse")
    parser.add_argument("--root", required=True, help="folder of the sources and results")
    parser.add_argument("--target", choices=("files", "postgres"), default="files")
    parser.add_argument("--source", choices=("csv", "inbox", "shopify"), default="csv")
    parser.add_argument("--skip-export", action="store_true", help="no summary CSV")
    parser.add_argument("--skip-layer-backup", action="store_true", help="no CSV backup of the layers")
    parser.add_argument("--postgres-dsn", default="", help="postgresql://user:password@host:port/name")
    parser.add_argument("--table-prefix", default="", help="prefix of the published table names")
    parser.add_argument("--incremental", action="store_true", help="append orders with new ids only")
    parser.add_argument("--shopify-days", type=int, default=None, help="days to look back, 14 by default")
    parser.add_argument("--end-day", type=date.fromisoformat, default=None, help="last day to sync, today by default")
    parser.add_argument("--probe-products", action="store_true", help="count the recorded product pages and stop")
    parser.add_argument("--compact-wide", action="store_true", help="merge the batches of the wide order table and stop")
    parser.add_argument("--export-products", action="store_true", help="export the recorded products and stop")
    return parser.parse_args(arguments)


def options_of(given: argparse.Namespace) -> RunOptions:
    return RunOptions(
        target=given.target,
        data_source=given.source,
        export_summary=not given.skip_export,
        export_layer_backups=not given.skip_layer_backup,
        incremental_load=given.incremental,
        shopify_sync_days=given.shopify_days,
        end_day=given.end_day,
        table_prefix=given.table_prefix,
    )


def main(arguments: list[str] | None = None) -> None:
    given = parse_arguments(arguments)
    paths = Paths(given.root)
    spark = configure(SparkSession.builder.appName("salesloom").getOrCreate())
    if given.probe_products:
        print(pages.page_probe(pages.read_pages(spark, paths.product_pages)).first().asDict())
        return
    if given.compact_wide:
        print(files.compact_wide(Warehouse(spark, paths.warehouse)))
        return
    if given.export_products:
        nodes = pages.product_nodes(pages.read_pages(spark, paths.product_pages))
        print(files.export_products(nodes, paths.products, RunOptions.shop_name).first().asDict())
        return
    write, transact = None, None
    if given.target == "postgres":
        if not given.postgres_dsn:
            raise SystemExit("--target postgres needs --postgres-dsn")
        write = database.jdbc_writer(*database.jdbc_of_dsn(given.postgres_dsn))
        transact = database.psycopg_runner(given.postgres_dsn)
    print(run(spark, paths, options_of(given), write, transact))
