"""Exact money arithmetic.

Amounts are decimals with four places, so every currency's minor unit fits and
the sum of a group does not depend on the order of its rows. Reports round half
up to two places and publish doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
REPORTED = T.DecimalType(28, 2)


def to_money(value: Column) -> Column:
    return value.cast(MONEY)


def money_or_zero(value: Column) -> Column:
    return F.coalesce(value.cast(MONEY), F.lit(Decimal(0)).cast(MONEY))


def rounded(total: Column) -> Column:
    """Two places, half up."""
    return F.round(total, 2).cast(REPORTED)


def mean(total: Column, count: Column) -> Column:
    """Exact half-up mean with two places, by whole-number division.

    A decimal quotient would be rounded once by the division and a second time to
    two places; whole numbers round once.
    """
    whole = T.DecimalType(37, 0)
    units = F.abs(total).cast(T.DecimalType(32, 4)) * F.lit(Decimal(10000))
    doubled = (units * F.lit(Decimal(2))).cast(whole) + (count * F.lit(100)).cast(whole)
    cents = F.call_function("div", doubled.cast(whole), (count * F.lit(200)).cast(whole))
    value = cents.cast(T.DecimalType(20, 0)) * F.lit(Decimal("0.01"))
    return F.when(count > 0, F.when(total < 0, -value).otherwise(value)).cast(REPORTED)


def as_doubles(df: DataFrame) -> DataFrame:
    """Publish every decimal column as double."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def number_text(value: Column) -> Column:
    """Short text of a decimal number: 1.23M, 45.6k, whole numbers plain, else two places."""
    exact = value.cast(T.DecimalType(32, 6))
    size = F.abs(exact)

    def scaled(factor: str, places: int) -> Column:
        shifted = (exact * F.lit(Decimal(factor))).cast(T.DecimalType(38, 12))
        return F.round(shifted, places).cast(T.DecimalType(30, places)).cast("string")

    return (
        F.when(exact.isNull(), F.lit("—"))
        .when(size >= 1_000_000, F.concat(scaled("0.000001", 2), F.lit("M")))
        .when(size >= 10_000, F.concat(scaled("0.001", 1), F.lit("k")))
        .when(exact == F.round(exact, 0), F.round(exact, 0).cast(T.DecimalType(30, 0)).cast("string"))
        .otherwise(scaled("1", 2))
    )
