"""CSV sources of customers and orders."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.clock import any_date
from salesloom.functions.money import MONEY, to_money
from salesloom.functions.text import to_bigint


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list the path, on any file system it knows; folders in it need not be partitions of one table."""
    try:
        spark.read.option("recursiveFileLookup", True).text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def validate_sources(spark: SparkSession, sources: dict[str, str]) -> list[str]:
    """Names of the sources; raises with every missing path."""
    missing = [path for path in sources.values() if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError("missing source files: " + ", ".join(missing))
    return list(sources)


def read_csv_text(spark: SparkSession, path: str, required: Sequence[str] = (), multiline: bool = False) -> DataFrame:
    """All columns of a CSV file with a header, as text.

    Files split across tasks. Set `multiline` only for quoted line breaks; such files
    are read by one task each.
    """
    rows = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').csv(path)
    missing = [name for name in required if name not in rows.columns]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    return rows


def customers_csv(spark: SparkSession, path: str, extra_columns: bool = True, multiline: bool = False) -> DataFrame:
    """raw_customers as delivered, with the file's further columns unless switched off."""
    rows = read_csv_text(spark, path, schemas.CUSTOMER_COLUMNS, multiline)
    extra = [c for c in rows.columns if c not in schemas.CUSTOMER_COLUMNS] if extra_columns else []
    return rows.select(
        to_bigint(F.col("customer_id")).alias("customer_id"), "customer_name", "city", "customer_level", *extra
    )


def orders_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """raw_orders of a CSV file; currency, country and refund are constants, whatever the file holds."""
    rows = read_csv_text(spark, path, ("order_id", "customer_id", "order_amount", "order_date"), multiline)
    return with_order_defaults(
        rows.select(
            to_bigint(F.col("order_id")).alias("order_id"),
            to_bigint(F.col("customer_id")).alias("customer_id"),
            to_money(F.col("order_amount")).alias("order_amount"),
            any_date(F.col("order_date")).alias("order_date"),
        )
    )


def with_order_defaults(orders: DataFrame) -> DataFrame:
    """The constant columns of file orders."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_amount",
        "order_date",
        F.lit("CNY").alias("currency_code"),
        F.lit("UNKNOWN").alias("ship_country"),
        F.lit(Decimal(0)).cast(MONEY).alias("refund_amount"),
    )
