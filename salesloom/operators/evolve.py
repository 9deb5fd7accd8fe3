"""Additive schema changes for tables written before columns were added."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.money import MONEY


def _ensure(df: DataFrame, **types: object) -> DataFrame:
    for name, kind in types.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def _zero() -> Column:
    return F.lit(Decimal(0)).cast(MONEY)


def assert_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; a NULL in one of the columns raises when it is read."""
    checked = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} must not be NULL"))).otherwise(F.col(c)) for c in columns
    }
    return df.select(*[checked[c].alias(c) if c in checked else F.col(c) for c in df.columns])


def migrate_raw_orders(df: DataFrame) -> DataFrame:
    """Missing columns appear with their defaults; existing values stay."""
    for name, kind, default in (
        ("currency_code", "string", F.lit("CNY")),
        ("ship_country", "string", F.lit("UNKNOWN")),
        ("refund_amount", MONEY, _zero()),
    ):
        if name not in df.columns:
            df = df.withColumn(name, default.cast(kind))
    return df


def migrate_orders(df: DataFrame) -> DataFrame:
    """Staged or fact orders: defaults for the added columns; the added net amount is not clamped."""
    df = _ensure(df, currency_code="string", ship_country="string", refund_amount=MONEY, net_amount=MONEY)
    df = df.withColumns(
        {
            "currency_code": F.coalesce("currency_code", F.lit("CNY")),
            "ship_country": F.coalesce(F.nullif(F.trim("ship_country"), F.lit("")), F.lit("UNKNOWN")),
            "refund_amount": F.coalesce("refund_amount", _zero()),
        }
    )
    net = F.col("order_amount") - F.col("refund_amount")
    df = df.withColumn("net_amount", F.coalesce("net_amount", net.cast(MONEY)))
    return assert_filled(df, ("currency_code", "ship_country", "refund_amount", "net_amount"))


def _back_filled(df: DataFrame, due: Column, values: dict[str, Column]) -> DataFrame:
    """New values on the rows that are due, the old ones elsewhere."""
    return df.withColumn("due", due).withColumns(
        {name: F.when(F.col("due"), value).otherwise(F.col(name)) for name, value in values.items()}
    ).drop("due")


def migrate_sales_summary(df: DataFrame) -> DataFrame:
    """Summary mart: gross and net sales out of the former total, where that column exists."""
    df = _ensure(df, currency_code="string", gross_sales=MONEY, total_refunds=MONEY, net_sales=MONEY)
    currency = F.coalesce(F.nullif(F.trim("currency_code"), F.lit("")), F.lit("CNY"))
    refunds = F.coalesce("total_refunds", _zero())
    if "total_sales" in df.columns:
        total = F.col("total_sales").cast(MONEY)
        due = F.col("gross_sales").isNull() | F.col("net_sales").isNull() | F.col("currency_code").isNull()
        values = {
            "currency_code": currency,
            "gross_sales": F.coalesce("gross_sales", total),
            "total_refunds": refunds,
            "net_sales": F.coalesce("net_sales", (total - refunds).cast(MONEY)),
        }
    else:
        due = F.col("currency_code").isNull() | F.col("total_refunds").isNull()
        values = {"currency_code": currency, "total_refunds": refunds}
    return assert_filled(
        _back_filled(df, due, values), ("currency_code", "gross_sales", "total_refunds", "net_sales")
    )


def migrate_sales_mart(df: DataFrame) -> DataFrame:
    """Daily, city and level marts: currency, refunds and net sales filled in."""
    df = _ensure(df, currency_code="string", total_refunds=MONEY, net_sales=MONEY)
    refunds = F.coalesce("total_refunds", _zero())
    due = F.col("currency_code").isNull() | F.col("total_refunds").isNull() | F.col("net_sales").isNull()
    values = {
        "currency_code": F.coalesce(F.nullif(F.trim("currency_code"), F.lit("")), F.lit("CNY")),
        "total_refunds": refunds,
        "net_sales": F.coalesce("net_sales", (F.col("gross_merchandise_value") - refunds).cast(MONEY)),
    }
    return assert_filled(_back_filled(df, due, values), ("currency_code", "total_refunds", "net_sales"))


MIGRATIONS = {
    "raw_orders": migrate_raw_orders,
    "stg_orders": migrate_orders,
    "fact_orders": migrate_orders,
    "mart_sales_summary": migrate_sales_summary,
    "mart_daily_sales": migrate_sales_mart,
    "mart_city_sales": migrate_sales_mart,
    "mart_customer_level_sales": migrate_sales_mart,
}


def migrate_additive(table: str, df: DataFrame) -> DataFrame:
    return MIGRATIONS[table](df) if table in MIGRATIONS else df
