"""The whole warehouse, lazily or table by table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesloom import schemas
from salesloom.operators import layers, marts
from salesloom.session import shared_dir
from salesloom.sinks.files import write_partitioned, write_table
from salesloom.sources.tables import Warehouse


def build_warehouse(raw_customers: DataFrame, raw_orders: DataFrame) -> dict[str, DataFrame]:
    """Every derived table as a lazy plan over the two raw tables."""
    staged_customers = layers.stg_customers(raw_customers)
    staged_orders = layers.stg_orders(raw_orders)
    dim = layers.dim_customers(layers.clean_customers(raw_customers))
    fact = layers.fact_orders(staged_orders)
    return {
        "stg_customers": staged_customers,
        "stg_orders": staged_orders,
        "dim_customers": dim,
        "fact_orders": fact,
        "mart_sales_summary": marts.mart_sales_summary(fact, dim),
        "mart_daily_sales": marts.mart_daily_sales(fact),
        "mart_city_sales": marts.mart_city_sales(fact, dim),
        "mart_customer_level_sales": marts.mart_customer_level_sales(fact, dim),
    }


def write_warehouse(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Write every derived table from the raw tables of the warehouse.

    Each step reads the files of the step before, so nothing is computed twice and a
    lost executor costs one step at most. The three joined marts share the customer
    sums, which are written once to the shared folder.
    """
    raw_customers, raw_orders = warehouse.read("raw_customers"), warehouse.read("raw_orders")
    staged_customers = write_table(warehouse, "stg_customers", layers.stg_customers(raw_customers))
    staged_orders = write_table(warehouse, "stg_orders", layers.stg_orders(raw_orders))
    dim = write_table(warehouse, "dim_customers", layers.dim_customers(staged_customers))
    fact = write_partitioned(warehouse, "fact_orders", layers.fact_orders(staged_orders), "order_month")

    sums_path = f"{shared_dir(warehouse.spark, 'customer-months')}/rows"
    marts.with_customers(marts.customer_months(fact), dim).write.parquet(sums_path)
    sums = warehouse.spark.read.parquet(sums_path)
    tables = {
        "raw_customers": raw_customers,
        "raw_orders": raw_orders,
        "stg_customers": staged_customers,
        "stg_orders": staged_orders,
        "dim_customers": dim,
        "fact_orders": fact,
    }
    for table, rows, columns in (
        ("mart_sales_summary", marts.sales_summary(sums), schemas.SUMMARY_COLUMNS),
        ("mart_daily_sales", marts.mart_daily_sales(fact), schemas.DAILY_COLUMNS),
        ("mart_city_sales", marts.city_sales(sums), schemas.CITY_COLUMNS),
        ("mart_customer_level_sales", marts.customer_level_sales(sums), schemas.LEVEL_COLUMNS),
    ):
        tables[table] = write_table(warehouse, table, rows.select(*columns))
    return tables
