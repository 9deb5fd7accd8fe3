"""Staging, dimension and fact layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.clock import month_text
from salesloom.functions.money import money_or_zero, to_money
from salesloom.functions.text import bigint_of, clean_code, trim_u


def clean_customers(raw_customers: DataFrame) -> DataFrame:
    """Typed, trimmed customers with upper-case city and lower-case level; copies stay."""
    return raw_customers.select(
        bigint_of(raw_customers, "customer_id").alias("customer_id"),
        trim_u(F.col("customer_name")).alias("customer_name"),
        F.upper(trim_u(F.col("city"))).alias("city"),
        F.lower(trim_u(F.col("customer_level"))).alias("customer_level"),
    )


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return clean_customers(raw_customers).distinct()


def _given(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        bigint_of(raw_orders, "order_id").alias("order_id"),
        bigint_of(raw_orders, "customer_id").alias("customer_id"),
        to_money(F.col("order_amount")).alias("order_amount"),
        F.col("order_date").cast("date").alias("order_date"),
        clean_code(F.col("currency_code")).alias("currency_code"),
        clean_code(F.col("ship_country")).alias("ship_country"),
        money_or_zero(F.col("refund_amount")).alias("refund_amount"),
    ).filter(F.col("order_amount") > 0)


def _derived(orders: DataFrame) -> DataFrame:
    net = F.greatest(F.col("order_amount") - F.col("refund_amount"), F.lit(0))
    return (
        orders.withColumn("order_month", month_text(F.col("order_date")))
        .withColumn("net_amount", to_money(net))
        .select(*schemas.ORDER_COLUMNS)
    )


def clean_orders(raw_orders: DataFrame) -> DataFrame:
    """Typed orders with month, currency and country codes and the net amount; only positive amounts."""
    return _derived(_given(raw_orders))


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Cleaned orders without whole-row copies; two different versions of one order both stay.

    Month and net amount follow from the other columns, so they are added after the
    copies are gone and the shuffle does not carry them.
    """
    return _derived(_given(raw_orders).distinct())


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per customer: the first by name, city and level, NULL last.

    A minimum over a struct needs no window: each task keeps one candidate per
    customer before the shuffle, so a customer with very many rows stays cheap.
    Copies do not change a minimum, so cleaned rows serve as well as staged ones.
    """
    attributes = schemas.CUSTOMER_COLUMNS[1:]
    ranked = F.struct(
        *[
            part
            for name in attributes
            for part in (F.col(name).isNull().alias(f"{name}_missing"), F.col(name).alias(name))
        ]
    )
    first = customers.groupBy("customer_id").agg(F.min(ranked).alias("first"))
    return first.select("customer_id", *[F.col(f"first.{name}").alias(name) for name in attributes])


def fact_orders(staged: DataFrame) -> DataFrame:
    return staged.select(*schemas.ORDER_COLUMNS)
