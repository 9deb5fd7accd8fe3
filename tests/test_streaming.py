"""Streams: many micro-batches end where one batch job would, also after a replay."""

from __future__ import annotations

import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.operators import marts
from salesloom.sinks.versioned import VersionedTable
from salesloom.streaming import event_days, jobs
from tests.conftest import values

ORDERS = "order_id bigint, customer_id bigint, order_amount decimal(18,4), order_time timestamp, currency_code string"


def drop_file(spark, folder, number, rows, schema):
    """One more file for the stream."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/stage-{number}")
    import glob
    import os

    os.makedirs(f"{folder}/in", exist_ok=True)
    for path in glob.glob(f"{folder}/stage-{number}/part-*.parquet"):
        shutil.copy(path, f"{folder}/in/{number}.parquet")


def stream_of(spark, folder):
    return jobs.file_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, max_files=1)


def test_unseen_over_batches(spark, folder):
    schema = "order_id bigint, v string"
    existing = spark.createDataFrame([(1, "old")], schema)
    drop_file(spark, folder, 1, [(1, "a"), (2, "a"), (2, "b")], schema)
    drop_file(spark, folder, 2, [(2, "c"), (3, "c")], schema)
    out, state = f"{folder}/out", f"{folder}/state"
    jobs.land_unseen(stream_of(spark, folder), existing, out, state).awaitTermination()
    assert values(jobs.landed(spark, out), "order_id", "v") == [(2, "a"), (2, "b"), (3, "c")]
    # the next start continues where the last one ended
    drop_file(spark, folder, 3, [(3, "d"), (4, "d")], schema)
    jobs.land_unseen(stream_of(spark, folder), existing, out, state).awaitTermination()
    assert values(jobs.landed(spark, out), "order_id") == [(2,), (2,), (3,), (4,)]
    # a lost commit makes the last batch run again: same result
    shutil.rmtree(f"{state}/commits")
    jobs.land_unseen(stream_of(spark, folder), existing, out, state).awaitTermination()
    assert values(jobs.landed(spark, out), "order_id") == [(2,), (2,), (3,), (4,)]


def test_latest_over_batches(spark, folder):
    schema = "id bigint, version bigint, v string"
    drop_file(spark, folder, 1, [(1, 5, "five"), (1, 4, "four"), (2, 1, "one")], schema)
    drop_file(spark, folder, 2, [(1, 3, "late"), (2, 2, "two"), (3, None, "none")], schema)
    table = VersionedTable(spark, f"{folder}/table", ("id",), ("version",))
    jobs.merge_latest(stream_of(spark, folder), table, f"{folder}/state", "test").awaitTermination()
    want = [(1, "five"), (2, "two"), (3, "none")]
    assert values(table.read(), "id", "v") == want and len(table.manifest().folders) == 2
    # a lost commit makes the last batch run again: nothing is written twice
    shutil.rmtree(f"{folder}/state/commits")
    jobs.merge_latest(stream_of(spark, folder), table, f"{folder}/state", "test").awaitTermination()
    assert values(table.read(), "id", "v") == want and len(table.manifest().folders) == 2
    drop_file(spark, folder, 3, [(1, 6, "six")], schema)
    jobs.merge_latest(stream_of(spark, folder), table, f"{folder}/state", "test", compact_every=1).awaitTermination()
    assert values(table.read(), "id", "v") == [(1, "six"), *want[1:]] and len(table.manifest().folders) == 1


def test_daily_over_batches_equals_batch(spark, folder):
    first = [(1, 7, Decimal("1.5"), datetime(2026, 1, 1, 23), "EUR"), (2, 7, Decimal("2"), datetime(2026, 1, 1, 5), "EUR")]
    second = [(3, 8, Decimal("4"), datetime(2026, 1, 1, 6), "EUR"), (4, 7, Decimal("8"), datetime(2026, 1, 2, 0), "EUR"),
              (5, 7, Decimal("1"), datetime(2026, 1, 1, 7), "USD")]
    drop_file(spark, folder, 1, first, ORDERS)
    drop_file(spark, folder, 2, second, ORDERS)

    def measured(orders):
        return orders.select("*", F.lit(0).cast("decimal(18,4)").alias("refund_amount"), F.col("order_amount").alias("net_amount"))

    out = f"{folder}/out"
    jobs.land_customer_days(measured(stream_of(spark, folder)), out, f"{folder}/state").awaitTermination()
    batch = measured(spark.createDataFrame(first + second, ORDERS)).select(
        "*", F.col("order_time").cast("date").alias("order_date"), F.date_format("order_time", "yyyy-MM").alias("order_month"))
    assert values(jobs.daily_sales_of_stream(spark, out)) == values(marts.mart_daily_sales(batch))


def test_late_orders_count(spark, folder):
    drop_file(spark, folder, 1, [(1, 7, Decimal("1"), datetime(2026, 3, 1), "EUR")], ORDERS)
    drop_file(spark, folder, 2, [(2, 7, Decimal("1"), datetime(2026, 3, 2), "EUR")], ORDERS)
    drop_file(spark, folder, 3, [(3, 7, Decimal("1"), datetime(2026, 1, 1), "EUR"), (4, 7, Decimal("1"), datetime(2026, 3, 1), "EUR")], ORDERS)
    stream = stream_of(spark, folder).select("*", F.lit(0).cast("decimal(18,4)").alias("refund_amount"), F.col("order_amount").alias("net_amount"))
    jobs.land_customer_days(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    daily = jobs.daily_sales_of_stream(spark, f"{folder}/out").collect()
    assert {r.order_date.isoformat(): (r.order_count, r.customer_count) for r in daily} == {
        "2026-03-01": (2, 1), "2026-03-02": (1, 1), "2026-01-01": (1, 1)}


def test_days_close_and_late_rows_are_kept(spark, folder):
    def day(d, h=0):
        return datetime(2026, 3, d, h)

    def one(i, customer, amount, when, currency="EUR"):
        return (i, customer, Decimal(amount), when, currency)

    batches = [
        [one(1, 7, "1", day(1)), one(2, 7, "2", day(1, 23)), one(3, 8, "4", day(3)), one(4, 9, "1", None)],
        [one(5, 7, "8", day(1, 5)), one(6, 7, "1", day(8)), one(7, None, "3", day(3), "USD")],
        [one(8, 7, "5", day(1)), one(9, 7, "6", day(5)), one(10, 9, "7", day(6)), one(11, 9, "7", day(8, 1))],
    ]
    out, state = f"{folder}/out", f"{folder}/state"
    assert event_days.closed_days(spark, out) is None and event_days.open_days(spark, out) is None

    def run():
        stream = stream_of(spark, folder).select("*", F.lit(0).cast("decimal(18,4)").alias("refund_amount"), F.col("order_amount").alias("net_amount"))
        event_days.land_event_days(stream, out, state).awaitTermination()

    def seen():
        closed = {(r.order_date.day, r.currency_code): (r.order_count, r.customer_count) for r in event_days.closed_days(spark, out).collect()}
        opened = {(r.order_date.day, r.currency_code): (r.order_count, r.customer_count) for r in event_days.open_days(spark, out).collect()}
        late = {r.order_id: r.open_from.day if r.open_from else None for r in event_days.late_rows(spark, out).collect()}
        return closed, opened, late

    for number, rows in enumerate(batches, 1):
        drop_file(spark, folder, number, rows, ORDERS)
        run()
    # Watermarks: none, the 1st, the 6th; the last batch ends with the 6th too.
    want = (
        {(1, "EUR"): (3, 1), (3, "EUR"): (1, 1), (3, "USD"): (1, 0)},
        {(6, "EUR"): (1, 1), (8, "EUR"): (2, 2)},
        {4: None, 8: 6, 9: 6},
    )
    assert seen() == want
    accepted = sum(n for part in want[:2] for n, _ in part.values())
    assert accepted + len(want[2]) == sum(len(rows) for rows in batches)
    # A lost commit makes the last batch run again: same result.
    shutil.rmtree(f"{state}/commits")
    run()
    assert seen() == want


def test_repeats_within_the_delay(spark, folder):
    drop_file(spark, folder, 1, [(1, 7, Decimal("1"), datetime(2026, 3, 1), "EUR")] * 3, ORDERS)
    drop_file(spark, folder, 2, [(1, 7, Decimal("1"), datetime(2026, 3, 1), "EUR"), (2, 7, Decimal("1"), datetime(2026, 3, 1), "EUR")], ORDERS)
    kept = jobs.without_repeats(stream_of(spark, folder), ["order_id"], "order_time", "2 days")
    jobs.land(kept, f"{folder}/out", f"{folder}/state").awaitTermination()
    assert values(jobs.landed(spark, f"{folder}/out"), "order_id") == [(1,), (2,)]


def test_reject_reasons(spark):
    orders = spark.createDataFrame([(1, 7, 5), (2, None, 5), (3, 7, 0), (4, 9, 5), (5, 7, None)], "order_id int, customer_id int, order_amount int")
    dim = spark.createDataFrame([(7,), (7,)], "customer_id int")
    got = {r.order_id: r.reject_reason for r in jobs.with_reject_reason(orders, dim).collect()}
    assert got == {1: None, 2: "no customer", 3: "amount not positive", 4: "unknown customer", 5: None}


def test_nothing_landed_yet(spark, folder):
    assert jobs.landed(spark, f"{folder}/none") is None


@pytest.mark.parametrize("name", ["stream_append", "stream_daily"])
def test_checkpoint_folder_is_the_clusters(spark, name):
    from salesloom.session import shared_dir

    assert shared_dir(spark, name).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/" + name)
