"""Sales marts.

Orders are first summed per customer (and month or day). That table has one row
per customer and group, so

* the dimension joins to sums instead of to orders, and a customer holding a large
  part of all orders is reduced by every task before anything is shuffled;
* counting a group's rows counts its distinct customers, so no mart needs a
  distinct aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.money import mean, rounded


def _sums(n: Column) -> list[Column]:
    return [
        n.alias("order_count"),
        F.sum("order_amount").alias("order_amount"),
        F.sum("refund_amount").alias("refund_amount"),
        F.sum("net_amount").alias("net_amount"),
    ]


def customer_days(fact: DataFrame) -> DataFrame:
    """Order sums per customer, day and currency."""
    return fact.groupBy("customer_id", "order_date", "order_month", "currency_code").agg(*_sums(F.count("*")))


def customer_months(fact: DataFrame) -> DataFrame:
    """Order sums per customer, month and currency."""
    return fact.groupBy("customer_id", "order_month", "currency_code").agg(*_sums(F.count("*")))


def months_of_days(days: DataFrame) -> DataFrame:
    """Month sums out of day sums, when both are wanted."""
    return days.groupBy("customer_id", "order_month", "currency_code").agg(*_sums(F.sum("order_count")))


def with_customers(sums: DataFrame, dim: DataFrame) -> DataFrame:
    """Sums of known customers with city and level. Orders of unknown customers drop out."""
    return sums.join(dim.select("customer_id", "city", "customer_level"), "customer_id", "inner")


def _grouped(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return sums.groupBy(*keys).agg(*_sums(F.sum("order_count")), F.count("customer_id").alias("customer_count"))


def _sales(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return _grouped(sums, keys).select(
        *keys,
        "order_count",
        "customer_count",
        rounded(F.col("order_amount")).alias("gross_merchandise_value"),
        rounded(F.col("refund_amount")).alias("total_refunds"),
        rounded(F.col("net_amount")).alias("net_sales"),
        mean(F.col("net_amount"), F.col("order_count")).alias("average_order_value"),
    )


def sales_summary(customer_sums: DataFrame) -> DataFrame:
    """City, level, month and currency; takes month sums joined to customers."""
    keys = ("city", "customer_level", "order_month", "currency_code")
    bar = F.lit("|")
    key = F.concat("city", bar, "customer_level", bar, "order_month", bar, "currency_code")
    return _grouped(customer_sums, keys).select(
        key.alias("summary_key"),
        *keys,
        "order_count",
        rounded(F.col("order_amount")).alias("gross_sales"),
        rounded(F.col("refund_amount")).alias("total_refunds"),
        rounded(F.col("net_amount")).alias("net_sales"),
        mean(F.col("net_amount"), F.col("order_count")).alias("avg_order_amount"),
    )


def daily_sales(days: DataFrame) -> DataFrame:
    """Day and currency; takes day sums and keeps orders of unknown customers."""
    return _sales(days, ("order_date", "order_month", "currency_code"))


def city_sales(customer_sums: DataFrame) -> DataFrame:
    return _sales(customer_sums, ("city", "order_month", "currency_code"))


def customer_level_sales(customer_sums: DataFrame) -> DataFrame:
    return _sales(customer_sums, ("customer_level", "order_month", "currency_code"))


def mart_sales_summary(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return sales_summary(with_customers(customer_months(fact), dim)).select(*schemas.SUMMARY_COLUMNS)


def mart_daily_sales(fact: DataFrame) -> DataFrame:
    return daily_sales(customer_days(fact)).select(*schemas.DAILY_COLUMNS)


def mart_city_sales(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return city_sales(with_customers(customer_months(fact), dim)).select(*schemas.CITY_COLUMNS)


def mart_customer_level_sales(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return customer_level_sales(with_customers(customer_months(fact), dim)).select(*schemas.LEVEL_COLUMNS)
