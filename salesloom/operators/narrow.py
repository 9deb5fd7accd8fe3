"""Wide order table to the two narrow raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.clock import clock_date
from salesloom.functions.money import money_or_zero, to_money
from salesloom.functions.text import empty_to, trim_u
from salesloom.operators.incremental import latest


# What the narrow tables read of the wide one.
ORDER_READS = ("legacy_order_id", "customer_legacy_id", "created_at", "total_price", "currency_code", "shipping_country", "totalrefunded")
CUSTOMER_READS = ("customer_legacy_id", "customer_display_name", "shipping_city", "legacy_order_id", "shopify_gid")


def narrow_orders(wide: DataFrame) -> DataFrame:
    """raw_orders out of the wide table; rows without id, customer, time or price drop out."""
    complete = wide.dropna(subset=["legacy_order_id", "customer_legacy_id", "created_at", "total_price"])
    return complete.select(
        F.col("legacy_order_id").cast("bigint").alias("order_id"),
        F.col("customer_legacy_id").cast("bigint").alias("customer_id"),
        to_money(F.col("total_price")).alias("order_amount"),
        clock_date(F.col("created_at")).alias("order_date"),
        trim_u(empty_to(F.col("currency_code"), "UNKNOWN")).alias("currency_code"),
        trim_u(F.coalesce(F.col("shipping_country"), F.lit(""))).alias("ship_country"),
        money_or_zero(F.col("totalrefunded")).alias("refund_amount"),
    ).distinct()


def narrow_customers(wide: DataFrame, level: str = "standard") -> DataFrame:
    """raw_customers out of the wide table: name and city of each customer's latest order."""
    orders = wide.filter(F.col("customer_legacy_id").isNotNull()).select(
        F.col("customer_legacy_id").cast("bigint").alias("customer_id"),
        F.coalesce(F.nullif(trim_u(F.col("customer_display_name")), F.lit("")), F.lit("guest")).alias("customer_name"),
        F.upper(trim_u(empty_to(F.col("shipping_city"), "unknown"))).alias("city"),
        "legacy_order_id",
        "shopify_gid",
    )
    newest = latest(orders, ["customer_id"], ["legacy_order_id", "shopify_gid"])
    return newest.select("customer_id", "customer_name", "city", F.lit(level).alias("customer_level"))
