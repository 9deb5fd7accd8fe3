"""Warehouse tables as Parquet folders `<root>/<layer>/<table>`, and the report catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.sinks.versioned import VersionedTable

# Rows shown by default and at most.
DEFAULT_ROWS = 500
MAX_ROWS = 2000


@dataclass(frozen=True)
class Warehouse:
    """The folder of the layers and the session that reads it."""

    spark: SparkSession
    root: str
    # Rows that were written to each table through this object.
    counts: dict[str, int] = field(default_factory=dict, compare=False)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{schemas.LAYER_OF[table]}/{table}"

    def versioned(self, table: str) -> VersionedTable:
        """A table that is kept as versions and merged when read."""
        return VersionedTable(self.spark, self.path(table), *schemas.VERSIONED[table])

    def read(self, table: str) -> DataFrame:
        if table in schemas.VERSIONED:
            return self.versioned(table).read()
        return self.spark.read.parquet(self.path(table))

    def exists(self, table: str) -> bool:
        if table in schemas.VERSIONED:
            return self.versioned(table).exists()
        try:
            self.read(table)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def read_if_exists(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None


@dataclass(frozen=True)
class Kpi:
    column: str
    label: str
    agg: str = "sum"


@dataclass(frozen=True)
class CatalogEntry:
    """What the report shows of a published table."""

    layer: str
    table: str
    label: str
    chart: str = "none"
    label_column: str | None = None
    value_column: str | None = None
    kpis: tuple[Kpi, ...] = ()


_ORDERS = Kpi("order_count", "orders")
_CUSTOMERS = Kpi("customer_count", "customer visits")
_NET = Kpi("net_sales", "net sales")
_MEAN = Kpi("average_order_value", "average order value", "avg")

# Tables, charts and key figures of the report, by layer.
CATALOG: tuple[CatalogEntry, ...] = (
    CatalogEntry("raw", "raw_customers", "customers as delivered"),
    CatalogEntry("raw", "raw_orders", "orders as delivered"),
    CatalogEntry("stg", "stg_customers", "clean customers"),
    CatalogEntry("stg", "stg_orders", "clean orders"),
    CatalogEntry("dw", "dim_customers", "customer dimension"),
    CatalogEntry("dw", "fact_orders", "order facts"),
    CatalogEntry(
        "mart", "mart_sales_summary", "sales summary", "bar", "summary_key", "net_sales",
        (_ORDERS, Kpi("gross_sales", "gross sales"), _NET, Kpi("avg_order_amount", "average order amount", "avg")),
    ),
    CatalogEntry(
        "mart", "mart_daily_sales", "sales by day", "line", "order_date", "net_sales",
        (_ORDERS, _CUSTOMERS, Kpi("gross_merchandise_value", "gross merchandise value"), _NET, _MEAN),
    ),
    CatalogEntry(
        "mart", "mart_city_sales", "sales by city", "bar", "city", "net_sales", (_ORDERS, _CUSTOMERS, _NET, _MEAN)
    ),
    CatalogEntry(
        "mart", "mart_customer_level_sales", "sales by customer level", "bar", "customer_level", "net_sales",
        (_ORDERS, _CUSTOMERS, _NET, _MEAN),
    ),
)

CATALOG_BY_TABLE = {entry.table: entry for entry in CATALOG}


def catalog_rows(spark: SparkSession) -> DataFrame:
    """The catalogue as a table."""
    return spark.createDataFrame(
        [(e.layer, e.table, e.label, e.chart, e.label_column, e.value_column, len(e.kpis)) for e in CATALOG],
        "layer string, table string, label string, chart string, label_column string, value_column string,"
        " kpi_count int",
    )


def row_limit(raw: object = None) -> int:
    """Rows to show: 500 when absent or unreadable, between 1 and 2000 otherwise."""
    if raw is None or raw == "":
        return DEFAULT_ROWS
    try:
        return max(1, min(int(str(raw)), MAX_ROWS))
    except ValueError:
        return DEFAULT_ROWS


def preview(warehouse: Warehouse, layer: str, table: str, limit: object = None) -> DataFrame:
    """The first rows of a catalogue table; other tables are refused."""
    if not any(e.layer == layer and e.table == table for e in CATALOG):
        raise PermissionError(f"{layer}.{table} is not in the report catalogue")
    return warehouse.read(table).limit(row_limit(limit))


def preview_info(warehouse: Warehouse, layer: str, table: str, limit: object = None) -> dict[str, object]:
    """Schema, table, limit, row count and columns of a preview."""
    rows = preview(warehouse, layer, table, limit)
    return {
        "schema": layer,
        "table": table,
        "limit": row_limit(limit),
        "row_count": rows.count(),
        "columns": rows.columns,
    }


def json_rows(rows: DataFrame) -> DataFrame:
    """Rows as JSON text: dates in ISO form, decimals as numbers, NULL kept."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def read_database_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], parts: Sequence[str] | None = None
) -> DataFrame:
    """A whole published database table over JDBC; `parts` are conditions that cut it into one task each."""
    if parts:
        return spark.read.jdbc(url, table, predicates=list(parts), properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def preview_database_table(spark: SparkSession, url: str, table: str, properties: dict[str, str], limit: object = None) -> DataFrame:
    """The first rows of a published database table; the limit runs in the database."""
    return read_database_table(spark, url, table, properties).limit(row_limit(limit))
