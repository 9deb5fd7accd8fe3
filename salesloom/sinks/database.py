"""Publishing to a relational database.

Spark moves the rows into stage tables over JDBC, many tasks at a time. The swap into
the public tables is a handful of statements, which the caller runs in one
transaction on its own connection (`run_in_transaction`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators.quality import (
    DataQualityError,
    orphan_orders,
    published_key_checks,
    published_null_counts,
    raise_for_failed,
)
from salesloom.schemas import PublishedTable

TableWriter = Callable[[DataFrame, str], None]
StatementRunner = Callable[[list[str]], None]


def jdbc_writer(url: str, properties: dict[str, str], connections: int = 16, batch_size: int = 10_000) -> TableWriter:
    """Writes a table over JDBC with a bounded number of connections."""

    def write(rows: DataFrame, table: str) -> None:
        writer = rows.write.option("numPartitions", connections).option("batchsize", batch_size)
        writer.mode("overwrite").jdbc(url, table, properties=properties)

    return write


def jdbc_of_dsn(dsn: str) -> tuple[str, dict[str, str]]:
    """JDBC address and properties of a `postgresql://user:password@host:port/name` address."""
    parts = urlsplit(dsn)
    if parts.scheme not in ("postgresql", "postgres") or not parts.hostname:
        raise ValueError("the database address must look like postgresql://user:password@host:port/name")
    port = f":{parts.port}" if parts.port else ""
    query = f"?{parts.query}" if parts.query else ""
    properties = {"driver": "org.postgresql.Driver"}
    if parts.username:
        properties["user"] = unquote(parts.username)
    if parts.password:
        properties["password"] = unquote(parts.password)
    return f"jdbc:postgresql://{parts.hostname}{port}{parts.path}{query}", properties


def psycopg_runner(dsn: str) -> StatementRunner:
    """Runs statements in one transaction; needs the psycopg package."""
    try:
        import psycopg
    except ImportError as error:
        raise RuntimeError("publishing needs the psycopg package") from error

    def run(statements: list[str]) -> None:
        with psycopg.connect(dsn) as connection:
            for statement in statements:
                connection.execute(statement)

    return run


def published_rows(rows: DataFrame, plan: PublishedTable) -> DataFrame:
    """The published columns in their order and types."""
    return rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in plan.types.items()])


def audited(rows: DataFrame, plan: PublishedTable, source_system: str = "csv_demo") -> DataFrame:
    """Published rows with the audit columns that the database would fill by default."""
    values = {
        "source_system": F.lit(source_system),
        "etl_loaded_at": F.current_timestamp(),
        "etl_processed_at": F.current_timestamp(),
    }
    return published_rows(rows, plan).withColumns({name: values[name] for name in plan.audit})


def publish(
    tables: Mapping[str, DataFrame],
    write: TableWriter,
    run_in_transaction: StatementRunner,
    prefix: str = "",
) -> list[str]:
    """Replace the ten published tables at once; returns the tables that got rows.

    Children are emptied before their parents and filled after them. Empty tables are
    emptied too, but not listed. Orders of unknown customers would break the foreign key,
    so they stop the publish before anything is written.
    """
    plans = list(schemas.PUBLISHED)
    orphans = orphan_orders(tables["fact_orders"], tables["dim_customers"]).first().n
    if orphans:
        raise DataQualityError(f"fact_orders holds {orphans} orders of unknown customers")
    # Primary keys and NOT NULL columns: what the database would refuse must not reach a stage table.
    raise_for_failed(published_key_checks(tables))
    empty = published_null_counts(tables).filter("null_rows > 0").collect()
    if empty:
        raise DataQualityError("; ".join(f"{r.table_name}.{r.column_name} holds {r.null_rows} NULLs" for r in empty))
    filled = []
    for plan in plans:
        rows = published_rows(tables[plan.source], plan)
        if not rows.isEmpty():
            write(rows, f"{plan.target(prefix)}_stage")
            filled.append(plan)
    deletes = [f"DELETE FROM {plan.target(prefix)}" for plan in reversed(plans)]
    inserts = []
    for plan in filled:
        columns = ", ".join(plan.columns)
        target = plan.target(prefix)
        inserts.append(f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {target}_stage")
    run_in_transaction(deletes + inserts)
    run_in_transaction([f"DROP TABLE {plan.target(prefix)}_stage" for plan in filled])
    return [plan.target(prefix) for plan in filled]


def wide_target(prefix: str = "") -> str:
    return f"raw.{prefix}{schemas.WIDE_TABLE_NAME}"


def publish_wide(wide: DataFrame, write: TableWriter, run_in_transaction: StatementRunner, prefix: str = "") -> None:
    """Upsert the wide order table by its key; the incoming row replaces the whole row."""
    target = wide_target(prefix)
    columns = ", ".join(schemas.WIDE_ORDER_COLUMNS)
    changes = ", ".join(f"{c} = EXCLUDED.{c}" for c in schemas.WIDE_ORDER_COLUMNS if c not in schemas.WIDE_KEY)
    write(wide.select(*schemas.WIDE_ORDER_COLUMNS), f"{target}_stage")
    run_in_transaction(
        [
            f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {target}_stage"
            f" ON CONFLICT ({', '.join(schemas.WIDE_KEY)}) DO UPDATE SET {changes}",
            f"DROP TABLE {target}_stage",
        ]
    )
