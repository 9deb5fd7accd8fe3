"""Distinct customers of any range of days from daily bitmaps.

Customer numbers are cut into buckets of 32,768; a bucket of a day and currency is one bitmap of 4 kB. Bitmaps of days add up by OR, so
the customers of a week, a month or any other range are counted exactly from the daily table, without going back to orders and
without a distinct aggregation. A day's bitmaps never change when other days are loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_customers(orders: DataFrame) -> DataFrame:
    """order_date, currency_code, bucket, customers (bitmap) over orders; orders without customer count nowhere."""
    known = orders.filter(F.col("customer_id").isNotNull())
    return known.groupBy("order_date", "currency_code", F.bitmap_bucket_number("customer_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("customers")
    )


def merged_days(*tables: DataFrame) -> DataFrame:
    """One table out of several loads of the same form: bitmaps of one day and bucket are joined."""
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("order_date", "currency_code", "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))


def distinct_customers(daily: DataFrame, period: Column, *by: str) -> DataFrame:
    """period, the columns `by`, distinct_customers: each customer once, however many days of the period it ordered on."""
    buckets = daily.groupBy(period.alias("period"), *by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("here"))
    return buckets.groupBy("period", *by).agg(F.sum("here").alias("distinct_customers"))
