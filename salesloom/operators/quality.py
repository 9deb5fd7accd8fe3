"""Data quality: checks as one-row aggregates, the report, the gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas

CHECK_COLUMNS = ("check_name", "passed", "message", "failed_rows")


class DataQualityError(RuntimeError):
    """A check failed."""


def _check(name: str, counted: DataFrame, passed: Column, message: str, failed_rows: Column) -> DataFrame:
    return counted.select(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        F.lit(message).alias("message"),
        failed_rows.cast("bigint").alias("failed_rows"),
    )


def not_empty(name: str, table: DataFrame | None, spark: SparkSession, failed_when_empty: int = 0) -> DataFrame:
    """Passes when the table has a row. One row settles it, so the scan stops there."""
    message = f"{name.removesuffix('_not_empty')} must not be empty"
    if table is None:
        found = spark.range(1).select(F.lit(0).alias("n"))
    else:
        found = table.select(F.lit(1).alias("one")).limit(1).agg(F.count("*").alias("n"))
    passed = F.col("n") > 0
    return _check(name, found, passed, message, F.when(passed, 0).otherwise(failed_when_empty))


def positive_amounts(staged: DataFrame) -> DataFrame:
    bad = staged.agg(F.count_if((F.col("order_amount") <= 0) | F.col("customer_id").isNull()).alias("n"))
    return _check(
        "stg_orders_positive_amount", bad, F.col("n") == 0,
        "stg_orders must hold positive amounts and a customer", F.col("n"),
    )


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    return table.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1).agg(F.count("*").alias("n"))


def unique_customers(dim: DataFrame) -> DataFrame:
    return _check(
        "dim_customers_unique_customer_id", duplicate_keys(dim, ["customer_id"]), F.col("n") == 0,
        "customer_id must be unique in dim_customers", F.col("n"),
    )


def orphan_orders(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders whose customer the dimension does not hold, as one count.

    Orders are counted per customer first: the anti join then sees one row per
    customer, on the partitioning the count already made.
    """
    per_customer = fact.groupBy("customer_id").agg(F.count("*").alias("orders"))
    lost = per_customer.join(dim.select("customer_id").distinct(), "customer_id", "left_anti")
    return lost.agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("n"))


def valid_customers(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return _check(
        "fact_orders_customer_reference_valid", orphan_orders(fact, dim), F.col("n") == 0,
        "customer_id of fact_orders must be in dim_customers", F.col("n"),
    )


def quality_checks(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """The seven checks. Marts may be absent, the other tables may not."""
    return reduce(
        DataFrame.unionByName,
        [
            not_empty("raw_customers_not_empty", tables["raw_customers"], spark),
            not_empty("raw_orders_not_empty", tables["raw_orders"], spark),
            positive_amounts(tables["stg_orders"]),
            unique_customers(tables["dim_customers"]),
            valid_customers(tables["fact_orders"], tables["dim_customers"]),
            not_empty("mart_sales_summary_not_empty", tables.get("mart_sales_summary"), spark, 1),
            not_empty("mart_daily_sales_not_empty", tables.get("mart_daily_sales"), spark, 1),
        ],
    )


def quality_totals(checks: DataFrame) -> DataFrame:
    """Checks in all, passed, failed, and whether all passed."""
    return checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.bool_and("passed").alias("is_successful"),
    )


def raise_for_failed(checks: DataFrame) -> None:
    """Raise with every failed check; takes the small checks table."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise DataQualityError(
            "; ".join(f"{r.check_name}: {r.message} (failed_rows={r.failed_rows})" for r in failed)
        )


def key_checks(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Duplicate keys of every given table, as (check_name, passed, message, failed_rows)."""
    checks = [
        _check(
            f"{name}_key_unique", duplicate_keys(table, key), F.col("n") == 0,
            f"{', '.join(key)} must be unique in {name}", F.col("n"),
        )
        for name, (table, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def null_counts(table: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column that must be filled, in one pass over the table."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows").select(
        F.lit(name).alias("table_name"), "column_name", "null_rows"
    )


def published_key_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The primary keys of the published tables and the wide table, checked on their source tables."""
    keys = {p.source: p.key for p in schemas.PUBLISHED} | {"raw_shopify_orders": schemas.WIDE_KEY}
    return key_checks({name: (tables[name], key) for name, key in keys.items() if name in tables})


def published_null_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The NOT NULL columns of the published tables and the wide table, checked on their source tables."""
    filled = {p.source: p.not_null for p in schemas.PUBLISHED} | {"raw_shopify_orders": schemas.WIDE_NOT_NULL}
    counts = [null_counts(tables[name], name, columns) for name, columns in filled.items() if name in tables]
    return reduce(DataFrame.unionByName, counts)
