"""Publishing, product export and the wide-table upsert."""

from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import quality
from salesloom.operators.quality import DataQualityError
from salesloom.operators.wide import wide_orders
from salesloom.plans import run as jobs
from salesloom.plans.warehouse import build_warehouse
from salesloom.sinks import database, files
from salesloom.sources import csv_files, pages
from salesloom.sources.tables import CATALOG, Warehouse, catalog_rows, json_rows
from tests.test_golden import page, paths  # noqa: F401
from tests.test_operators import RAW_CUSTOMERS, RAW_ORDERS


class Database:
    """Takes the place of the database: remembers stage tables and statements."""

    def __init__(self):
        self.stages, self.batches = {}, []

    def write(self, rows, table):
        self.stages[table] = rows

    def run(self, statements):
        self.batches.append(statements)


def tables(spark, orders):
    raw_customers = spark.createDataFrame([(1, "A", "b", "gold")], RAW_CUSTOMERS)
    raw_orders = spark.createDataFrame(orders, RAW_ORDERS)
    return {"raw_customers": raw_customers, "raw_orders": raw_orders, **build_warehouse(raw_customers, raw_orders)}


def test_publish_order_and_columns(spark):
    target = Database()
    filled = database.publish(tables(spark, [(1, 1, Decimal("2.345"), date(2026, 1, 1), "eur", "de", Decimal("0"))]), target.write, target.run, "shop_")
    assert filled == [p.target("shop_") for p in schemas.PUBLISHED] and len(filled) == 10
    swap, cleanup = target.batches
    deletes = [s.removeprefix("DELETE FROM ") for s in swap[:10]]
    assert deletes == filled[::-1] and deletes.index("dw.shop_fact_orders") < deletes.index("dw.shop_dim_customers")
    inserts = [s.split()[2] for s in swap[10:]]
    assert inserts == filled and inserts.index("dw.shop_dim_customers") < inserts.index("dw.shop_fact_orders")
    assert "(order_id, customer_id, order_amount, order_date, currency_code, ship_country, refund_amount) SELECT order_id" in swap[11]
    assert cleanup == [f"DROP TABLE {name}_stage" for name in filled]
    fact = target.stages["dw.shop_fact_orders_stage"]
    assert fact.columns == list(schemas.ORDER_COLUMNS) and fact.first().order_amount == Decimal("2.35")


def test_empty_tables_are_emptied_but_not_listed(spark):
    target = Database()
    filled = database.publish(tables(spark, []), target.write, target.run)
    assert filled == ["raw.customers_raw", "stg.customers_clean", "dw.dim_customers"]
    assert len([s for s in target.batches[0] if s.startswith("DELETE")]) == 10


def test_orphans_stop_the_publish(spark):
    target = Database()
    with pytest.raises(DataQualityError, match="1 orders of unknown customers"):
        database.publish(tables(spark, [(1, 9, Decimal("2"), date(2026, 1, 1), "eur", "de", None)]), target.write, target.run)
    assert target.stages == {} and target.batches == []


def test_database_address():
    url, properties = database.jdbc_of_dsn("postgresql://me:p%40ss@db.example:5433/shop?sslmode=require")
    assert url == "jdbc:postgresql://db.example:5433/shop?sslmode=require"
    assert (properties["user"], properties["password"]) == ("me", "p@ss")
    with pytest.raises(ValueError):
        database.jdbc_of_dsn("host=db.example dbname=shop")


def test_wide_table_constraints(spark):
    wide = updates(spark, (1, None, None, "a"), (1, None, None, "b"), (2, None, None, "c"))
    row = quality.published_key_checks({"raw_shopify_orders": wide}).first()
    assert (row.check_name, row.passed, row.failed_rows) == ("raw_shopify_orders_key_unique", False, 1)
    counts = quality.published_null_counts({"raw_shopify_orders": wide}).collect()
    assert {r.column_name: r.null_rows for r in counts} == {"shopify_gid": 0, "shop_name": 0, "etl_synced_at": 0}


def test_audit_columns(spark):
    plan = schemas.PUBLISHED[0]
    row = database.audited(spark.createDataFrame([(1, "A", "b", "gold")], RAW_CUSTOMERS), plan).first()
    assert row.source_system == "csv_demo" and row.etl_loaded_at is not None


def test_run_publishes(spark, paths):  # noqa: F811
    target = Database()
    result = jobs.run_csv_to_database(spark, paths, target.write, target.run, export_layer_backups=False)
    assert len(result.published_tables) == 10 and result.target == "postgres"
    with pytest.raises(ValueError):
        jobs.run(spark, paths, jobs.RunOptions(target="postgres"))


def documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "document string")


def updates(spark, *rows):
    nodes = [{"id": f"g/{n}", "createdAt": created, "updatedAt": updated, "name": name} for n, created, updated, name in rows]
    return wide_orders(pages.order_nodes(documents(spark, page(*nodes))), "demo")


def test_wide_upsert_writes_its_batch_only(spark, folder):
    warehouse = Warehouse(spark, folder)
    assert not warehouse.exists("raw_shopify_orders")
    files.upsert_wide(warehouse, updates(spark, (1, "2026-01-05T00:00:00Z", "2026-01-05T00:00:00Z", "a"),
                                         (3, "2026-02-05T00:00:00Z", "2026-02-05T00:00:00Z", "a"), (4, None, None, "a")))
    held = warehouse.versioned("raw_shopify_orders").manifest().folders
    touched = files.upsert_wide(warehouse, updates(spark, (3, "2026-02-05T00:00:00Z", "2026-03-01T00:00:00Z", "b"),
                                                   (3, "2026-02-05T00:00:00Z", "2026-02-01T00:00:00Z", "stale"), (4, None, None, "c")))
    assert touched == 2
    now = warehouse.versioned("raw_shopify_orders").manifest().folders
    assert now[:1] == held and [f.rows for f in now] == [3, 2]
    want = {"g/1": "a", "g/3": "b", "g/4": "c"}
    assert {r.shopify_gid: r.order_id for r in files.read_wide(warehouse).collect()} == want
    assert files.compact_wide(warehouse) == 2 and files.compact_wide(warehouse) == 0
    assert {r.shopify_gid: r.order_id for r in files.read_wide(warehouse).collect()} == want


def versions(spark, *rows):
    nodes = [{"id": "g/1", "createdAt": created, "updatedAt": updated, "name": name} for created, updated, name in rows]
    return wide_orders(pages.order_nodes(documents(spark, page(*nodes)), position="edge"), "demo", keep=("edge",), versioned=True)


@pytest.mark.parametrize(
    ("first", "second", "kept"),
    [
        # One order, whatever offset its creation time is written with, or without one.
        (("2026-04-01T01:00:00+08:00", "2026-04-02T00:00:00Z", "a"), ("2026-03-31T17:00:00Z", "2026-04-03T00:00:00Z", "b"), "b"),
        ((None, "2026-04-02T00:00:00Z", "a"), ("2026-03-31T17:00:00Z", "2026-04-03T00:00:00Z", "b"), "b"),
        # 09:00 in the east is earlier than 02:00 UTC.
        (("2026-04-01T00:00:00Z", "2026-04-02T02:00:00Z", "late"), ("2026-04-01T00:00:00Z", "2026-04-02T09:00:00+08:00", "early"), "late"),
        (("2026-04-01T00:00:00Z", "2026-04-02T02:00:00.250Z", "late"), ("2026-04-01T00:00:00Z", "2026-04-02T02:00:00.125Z", "early"), "late"),
        (("2026-04-01T00:00:00Z", "2026-04-02T02:00:00Z", "old"), ("2026-04-01T00:00:00Z", "2026-04-02T02:00:00Z", "new"), "new"),
    ],
)
def test_one_row_per_order_and_the_latest_moment(spark, folder, first, second, kept):
    warehouse = Warehouse(spark, folder)
    files.upsert_wide(warehouse, versions(spark, first))
    files.upsert_wide(warehouse, versions(spark, second))
    assert [r.order_id for r in files.read_wide(warehouse).collect()] == [kept]


def test_equal_moments_in_a_batch_go_by_place(spark, folder):
    same = ("2026-04-01T00:00:00Z", "2026-04-02T02:00:00Z")
    warehouse = Warehouse(spark, folder)
    files.upsert_wide(warehouse, versions(spark, (*same, "x"), (*same, "a"), (*same, "m")))
    assert files.read_wide(warehouse).first().order_id == "m"


def test_csv_round_trip_of_awkward_text(spark, folder):
    rows = [(1, 'A "B", c', " x ", "l\nm"), (2, "", None, '"'), (3, "a\\", ",", "\t")]
    frame = spark.createDataFrame(rows, "customer_id bigint, customer_name string, city string, customer_level string")
    back = csv_files.customers_csv(spark, files.write_csv(frame, f"{folder}/c"), multiline=True)
    # Empty text and NULL are both an empty cell.
    assert [tuple(r) for r in back.orderBy("customer_id").collect()] == [tuple(v or None for v in r) for r in rows]


def test_no_stage_write_on_a_duplicate_order(spark):
    target = Database()
    tables = {plan.source: spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in plan.types.items())) for plan in schemas.PUBLISHED}
    order = spark.range(1).select(*[F.lit("1").cast(t).alias(c) if t != "date" else F.lit("2026-01-01").cast("date").alias(c)
                                    for c, t in next(p for p in schemas.PUBLISHED if p.source == "fact_orders").types.items()])
    person = spark.range(1).select(*[F.lit("1").cast(t).alias(c) for c, t in next(p for p in schemas.PUBLISHED if p.source == "dim_customers").types.items()])
    tables |= {"fact_orders": order.union(order), "dim_customers": person}
    with pytest.raises(DataQualityError, match="fact_orders"):
        database.publish(tables, target.write, target.run)
    assert not target.stages and not target.batches
