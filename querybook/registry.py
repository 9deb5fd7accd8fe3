"""The collection that queries register themselves in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree with it."""

    def register(build: Query) -> Query:
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[build.__name__] = call
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register
