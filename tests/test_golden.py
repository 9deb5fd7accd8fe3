"""The golden run, the incremental run, the inbox run and the order sync, end to end."""

from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesloom.operators.quality import DataQualityError
from salesloom.plans import run as jobs
from salesloom.sinks import files
from salesloom.sources.inbox import InboxError
from salesloom.sources.tables import Warehouse, preview, preview_info, row_limit

CUSTOMERS = """customer_id,customer_name,city,customer_level,note
1, Alice ,shanghai ,Gold,a
2,Bob,hangzhou,silver,b
3,Carol, nanjing,GOLD,c
4,Dan,shenzhen,bronze,d
"""
ORDERS = """order_id,customer_id,order_amount,order_date
1001,1,500.00,2026-04-01
1002,2,260.00,2026-04-01
1003,3,699.40,2026-04-02
1004,1,320.00,2026/04/02
1005,4,429.00,2026-04-03
1006,2,450.00,2026-04-03
"""


def put(root: str, name: str, text: str) -> None:
    path = Path(root) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture()
def paths(folder):
    put(folder, "raw/customers.csv", CUSTOMERS)
    put(folder, "raw/orders.csv", ORDERS)
    return jobs.Paths(folder)


def test_golden_run(spark, paths):
    result = jobs.run(spark, paths)
    warehouse = Warehouse(spark, paths.warehouse)
    assert result.loaded_sources == ["customers", "orders"]
    assert result.quality_passed and result.published_tables == [] and result.inserted_order_rows == 6
    assert warehouse.read("raw_customers").columns[-1] == "note"
    assert warehouse.read("stg_orders").count() == 6
    summary = warehouse.read("mart_sales_summary")
    assert summary.count() == 4
    assert summary.agg(F.min("summary_key")).first()[0] == "HANGZHOU|silver|2026-04|CNY"
    assert float(summary.agg(F.sum("net_sales")).first()[0]) == 2658.4
    assert warehouse.read("mart_daily_sales").count() == 3
    city = warehouse.read("mart_city_sales").filter("city = 'HANGZHOU' and order_month = '2026-04' and currency_code = 'CNY'")
    assert float(city.first().gross_merchandise_value) == 710.0
    gold = warehouse.read("mart_customer_level_sales").filter("customer_level = 'gold'")
    assert gold.first().customer_count == 2
    # exports and the report
    exported = [r.order_month + r.city for r in spark.read.option("header", True).csv(result.export_path).collect()]
    assert exported == sorted(exported) and len(exported) == 4
    assert [p.split("/")[-1] for p in result.layer_backup_paths] == [
        "raw_customers", "raw_orders", "stg_customers", "stg_orders", "dim_customers", "fact_orders",
        "mart_sales_summary", "mart_daily_sales", "mart_city_sales", "mart_customer_level_sales",
    ]
    part = next(Path(result.quality_report_path).glob("part-*.json"))
    report = json.loads(part.read_text())
    assert (report["total_checks"], report["failed_checks"], report["is_successful"]) == (7, 0, True)


def test_switches(spark, paths):
    result = jobs.run(spark, paths, jobs.RunOptions(export_summary=False, export_layer_backups=False))
    assert result.layer_backup_paths == [] and not Path(result.export_path).exists()


def test_incremental_run(spark, paths, folder):
    jobs.run(spark, paths, jobs.RunOptions(export_layer_backups=False))
    put(folder, "raw/orders.csv", ORDERS.split("\n")[0] + "\n1006,2,450.00,2026-04-03\n1007,3,300.00,2026-04-04\n")
    options = jobs.RunOptions(incremental_load=True, export_layer_backups=False)
    result = jobs.run(spark, paths, options)
    warehouse = Warehouse(spark, paths.warehouse)
    assert result.inserted_order_rows == 1
    assert warehouse.read("raw_orders").count() == 7 and warehouse.read("fact_orders").count() == 7
    assert jobs.run(spark, paths, options).inserted_order_rows == 0


def test_incremental_without_table_loads_all(spark, paths):
    assert jobs.load_raw(Warehouse(spark, paths.warehouse), paths, True) == 6


def test_missing_sources(spark, folder):
    with pytest.raises(FileNotFoundError, match="customers.csv.*orders.csv"):
        jobs.run(spark, jobs.Paths(folder))


def test_failed_check_stops_after_the_report(spark, paths, folder):
    put(folder, "raw/customers.csv", CUSTOMERS.replace("4,Dan,shenzhen,bronze,d\n", ""))
    with pytest.raises(DataQualityError, match="fact_orders_customer_reference_valid"):
        jobs.run(spark, paths)
    assert Path(paths.quality_report).exists() and not Path(paths.summary_export).exists()
    lenient = jobs.run(spark, paths, jobs.RunOptions(fail_on_quality_error=False))
    assert not lenient.quality_passed and Path(paths.summary_export).exists()
    # the orphan order counts by day, and in no joined mart
    warehouse = Warehouse(spark, paths.warehouse)
    assert warehouse.read("mart_daily_sales").agg(F.sum("order_count")).first()[0] == 6
    assert warehouse.read("mart_city_sales").agg(F.sum("order_count")).first()[0] == 5


def test_inbox_run(spark, folder):
    put(folder, "inbox/customers.json", json.dumps([
        {"customer_id": 1, "customer_name": "A", "city": "X", "customer_level": "gold"},
        {"customer_id": 2, "customer_name": "B", "city": "Y", "customer_level": "silver"},
    ], indent=2))
    put(folder, "inbox/customers.csv", "customer_id\n9\n")
    put(folder, "inbox/orders.csv", "id,customerId,total,createdAt\n10,1,100.0,2026-04-01T23:00:00Z\n11,2,50.0,2026-04-02\n")
    result = jobs.run_inbox_to_files(spark, jobs.Paths(folder), export_layer_backups=False)
    assert (result.inbox_customer_rows, result.inbox_order_rows, result.quality_passed) == (2, 2, True)
    raw = Warehouse(spark, jobs.Paths(folder).warehouse).read("raw_orders")
    days = {r.order_id: r.order_date for r in raw.collect()}
    assert days == {10: date(2026, 4, 1), 11: date(2026, 4, 2)}


def test_inbox_errors(spark, folder):
    with pytest.raises(InboxError):
        jobs.run_inbox_to_files(spark, jobs.Paths(folder))
    put(folder, "inbox/customers.json", "[]")
    with pytest.raises(InboxError, match="orders"):
        jobs.run_inbox_to_files(spark, jobs.Paths(folder))


def page(*orders: dict) -> str:
    edges = [{"cursor": str(i), "node": o} for i, o in enumerate(orders)]
    return json.dumps({"data": {"orders": {"edges": edges, "pageInfo": {"hasNextPage": False}}}})


def order(number: int, customer: int | None, price: str, created: str, updated: str, city: str = "Berlin") -> dict:
    return {
        "id": f"gid://shopify/Order/{number}", "legacyResourceId": str(number), "name": f"#{number}", "createdAt": created,
        "updatedAt": updated, "currencyCode": "EUR", "totalPriceSet": {"shopMoney": {"amount": price, "currencyCode": "EUR"}},
        "totalRefundedSet": {"shopMoney": {"amount": "1.00"}},
        "customer": {"legacyResourceId": str(customer), "displayName": f"C{customer}"} if customer else None,
        "shippingAddress": {"city": city, "country": "Germany"}, "lineItems": {"nodes": []}, "refunds": [],
    }


def test_order_sync(spark, folder):
    paths = jobs.Paths(folder)
    first = order(1, 7, "10.00", "2026-03-31T23:30:00+08:00", "2026-04-01T00:00:00Z")
    put(folder, "pages/orders/day=2026-03-01/p.json", page(order(99, 7, "1.00", "2026-03-01T10:00:00Z", "2026-03-01T10:00:00Z")))
    put(folder, "pages/orders/day=2026-04-01/p.json", page(first, order(2, None, "20.00", "2026-04-01T10:00:00Z", "2026-04-01T10:00:00Z")))
    put(folder, "pages/orders/day=2026-04-02/p.json",
        page(order(1, 7, "12.50", "2026-03-31T23:30:00+08:00", "2026-04-02T00:00:00Z", "Paris")) + "\n" + page())
    options = jobs.RunOptions(data_source="shopify", shopify_sync_days=14, end_day=date(2026, 4, 5), export_layer_backups=False)
    result = jobs.run(spark, paths, options)
    assert (result.shopify_wide_orders_merged, result.shopify_order_rows, result.shopify_customer_rows) == (3, 2, 2)
    warehouse = Warehouse(spark, paths.warehouse)
    orders = {r.order_id: r for r in warehouse.read("raw_orders").collect()}
    assert float(orders[1].order_amount) == 12.5 and orders[1].order_date == date(2026, 3, 31)
    assert orders[2].customer_id == 5_000_000_000_002
    people = {r.customer_id: r for r in warehouse.read("raw_customers").collect()}
    assert people[7].city == "PARIS" and people[5_000_000_000_002].customer_name == "guest"
    # a second run changes nothing in the tables and appends to the snapshot
    jobs.run(spark, paths, options)
    assert files.read_wide(warehouse).count() == 2
    snapshot = files.read_snapshot(spark, paths.snapshot)
    days = {r.snapshot_day: r.snapshot_day_order_count for r in files.snapshot_summary(snapshot, "demo").collect()}
    assert days == {date(2026, 4, 1): 4, date(2026, 4, 2): 2}
    # an older version that comes late does not replace a newer one
    put(folder, "pages/orders/day=2026-04-03/p.json", page(first))
    jobs.run(spark, paths, options)
    assert float(files.read_wide(warehouse).filter("legacy_order_id = 1").first().total_price) == 12.5


def test_preview(spark, paths):
    jobs.run(spark, paths, jobs.RunOptions(export_layer_backups=False))
    warehouse = Warehouse(spark, paths.warehouse)
    info = preview_info(warehouse, "mart", "mart_sales_summary", "3")
    assert (info["limit"], info["row_count"]) == (3, 3) and "summary_key" in info["columns"]
    with pytest.raises(PermissionError):
        preview(warehouse, "mart", "raw_orders")
    assert [row_limit(v) for v in (None, "", "x", "0", "-5", "7", "99999")] == [500, 500, 500, 1, 1, 7, 2000]


def test_arguments():
    given = jobs.parse_arguments(["--root", "/data", "--source", "shopify", "--shopify-days", "3", "--skip-export", "--incremental"])
    options = jobs.options_of(given)
    assert jobs.Paths(given.root).customers == "/data/raw/customers.csv"
    assert (options.data_source, options.shopify_sync_days, options.export_summary, options.incremental_load) == ("shopify", 3, False, True)
    assert (options.target, options.export_layer_backups) == ("files", True)
