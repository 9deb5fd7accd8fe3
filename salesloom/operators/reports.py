"""Report figures: key figures, chart series, rankings, shares, pivots, trends."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.money import mean, number_text
from salesloom.sources.tables import CatalogEntry

_FIGURE = T.DecimalType(38, 6)

# Columns that are never summed as a key figure, besides all that end in _id.
NO_FIGURE = (
    "customer_id",
    "order_id",
    "legacy_order_id",
    "summary_key",
    "shopify_gid",
    "marketing_intention",
    "product_quantity",
)


def lenient_number(rows: DataFrame, column: str, null_as_zero: bool = False) -> Column:
    """A column as exact number; unreadable text is NULL. Empty cells are skipped, or count as 0."""
    value = F.col(column)
    kind = rows.schema[column].dataType
    if isinstance(kind, T.StringType):
        number = F.btrim(value).try_cast(_FIGURE)
        blank = value.isNull() | (F.btrim(value) == "")
    elif isinstance(kind, T.BooleanType):
        number, blank = value.cast("int").cast(_FIGURE), value.isNull()
    elif isinstance(kind, T.NumericType):
        number, blank = value.try_cast(_FIGURE), value.isNull()
    else:
        number, blank = F.lit(None).cast(_FIGURE), value.isNull() & F.lit(not isinstance(kind, T.DateType))
    if null_as_zero:
        return F.when(blank, F.lit(Decimal(0)).cast(_FIGURE)).otherwise(number)
    return number


def _total(number: Column) -> Column:
    return F.sum(number).cast(T.DecimalType(32, 4))


def _cards(totals: DataFrame, cards: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """One row per card out of the one row of totals."""
    items = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(label).alias("label"),
            value.cast(T.DecimalType(32, 4)).alias("value"),
            F.lit(hint).alias("hint"),
        )
        for i, (label, value, hint) in enumerate(cards)
    ]
    return totals.select(F.inline(F.array(*items)))


def _presented(cards: DataFrame) -> DataFrame:
    return cards.select(
        "position", "label", F.col("value").cast("double").alias("value"), number_text(F.col("value")).alias("text"), "hint"
    )


def declared_cards(rows: DataFrame, entry: CatalogEntry, null_as_zero: bool = False) -> DataFrame:
    """Row count and the declared sums and averages of a table, over all its rows in one pass."""
    kpis = [k for k in entry.kpis if k.column in rows.columns]
    measures = [F.count("*").alias("row_count")]
    for i, kpi in enumerate(kpis):
        number = lenient_number(rows, kpi.column, null_as_zero)
        measures += [_total(number).alias(f"total_{i}"), F.count(number).alias(f"count_{i}")]
    totals = rows.agg(*measures)
    cards = [("rows", F.col("row_count"), "rows of the table")]
    for i, kpi in enumerate(kpis):
        total, count = F.col(f"total_{i}"), F.col(f"count_{i}")
        if kpi.agg == "avg":
            cards.append((kpi.label, mean(total, count), f"average of {kpi.column}"))
        else:
            cards.append((kpi.label, total, f"sum of {kpi.column}"))
    kept = _cards(totals, cards)
    sums = [kpi.label for kpi in kpis if kpi.agg != "avg"]
    return _presented(kept.filter(F.col("value").isNotNull() | ~F.col("label").isin(*sums)))


def figure_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in NO_FIGURE and not c.lower().endswith("_id")]


def heuristic_cards(rows: DataFrame, top: int = 4, null_as_zero: bool = False) -> DataFrame:
    """The columns with the largest absolute sums, for tables without declared figures."""
    columns = figure_columns(rows)
    measures = []
    for i, column in enumerate(columns):
        number = lenient_number(rows, column, null_as_zero)
        measures += [_total(number).alias(f"total_{i}"), F.count(number).alias(f"count_{i}")]
    totals = rows.agg(*measures)
    cards = [
        (f"∑ {column}", F.when(F.col(f"count_{i}") > 0, F.col(f"total_{i}")), f"sum of {column}")
        for i, column in enumerate(columns)
    ]
    picked = _cards(totals, cards).filter(F.col("value").isNotNull())
    return _presented(picked.orderBy(F.abs("value").desc(), "position").limit(top))


def kpi_cards(rows: DataFrame, entry: CatalogEntry, null_as_zero: bool = False) -> DataFrame:
    """Declared figures if the table has any, else the row count and the heuristic ones."""
    declared = declared_cards(rows, entry, null_as_zero)
    if entry.kpis:
        return declared
    found = heuristic_cards(rows, null_as_zero=null_as_zero)
    return declared.unionByName(found.withColumn("position", F.col("position") + 1))


def chart_series(rows: DataFrame, entry: CatalogEntry) -> DataFrame:
    """Label and value pairs of a table's chart, ordered by label; rows without a number drop out."""
    value = lenient_number(rows, entry.value_column).cast("double")
    return (
        rows.select(F.coalesce(F.col(entry.label_column).cast("string"), F.lit("")).alias("label"), value.alias("value"))
        .filter(F.col("value").isNotNull())
        .orderBy("label", "value")
    )


def dashboard_filter(
    mart: DataFrame,
    months: Sequence[str] | None = None,
    cities: Sequence[str] | None = None,
    levels: Sequence[str] | None = None,
) -> DataFrame:
    """A mart narrowed to months, cities and levels, as far as it has such columns."""
    for column, wanted in (("order_month", months), ("city", cities), ("customer_level", levels)):
        if wanted is not None and column in mart.columns:
            mart = mart.filter(F.col(column).isin(*wanted))
    return mart


def dashboard_totals(daily: DataFrame) -> DataFrame:
    """Total sales, orders, customers per day added up, and the mean of the daily averages."""
    average = F.col("average_order_value")
    return daily.agg(
        F.sum("gross_merchandise_value").alias("total_gmv"),
        F.sum("order_count").alias("total_orders"),
        F.sum("customer_count").alias("total_customers"),
        mean(F.sum(average), F.count(average)).alias("average_order_value"),
    )


def distinct_customers(fact: DataFrame) -> DataFrame:
    """Customers with at least one order, each counted once over all days."""
    return fact.select("customer_id").distinct().agg(F.count("customer_id").alias("customer_count"))


def city_ranking(city_mart: DataFrame, top: int | None = None) -> DataFrame:
    """Cities by sales, largest first; with `top`, the leading cities with their rank."""
    cities = city_mart.groupBy("city").agg(
        F.sum("gross_merchandise_value").alias("gross_merchandise_value"),
        F.sum("order_count").alias("order_count"),
    )
    ordered = cities.orderBy(F.col("gross_merchandise_value").desc(), F.col("city").asc_nulls_last())
    if top is None:
        return ordered
    place = F.rank().over(Window.orderBy(F.col("gross_merchandise_value").desc()))
    return ordered.limit(top).withColumn("sales_rank", place)


def level_share(level_mart: DataFrame) -> DataFrame:
    """Each level's sales and its share of all sales."""
    levels = level_mart.groupBy("customer_level").agg(
        F.sum("gross_merchandise_value").alias("gross_merchandise_value")
    )
    everything = level_mart.agg(F.sum("gross_merchandise_value")).scalar()
    share = F.col("gross_merchandise_value").cast("double") / everything.cast("double")
    return levels.withColumn("sales_share", F.round(share, 6))


def city_level_pivot(summary: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """Net sales and orders per city, one pair of columns per level; levels that are not listed go to `other`."""
    if levels:
        listed = F.when(F.col("customer_level").isin(*levels), F.col("customer_level")).otherwise("other")
        summary = summary.withColumn("customer_level", listed)
    pivot = summary.groupBy("city").pivot("customer_level", [*levels, "other"] if levels else None)
    return pivot.agg(F.sum("net_sales").alias("net_sales"), F.sum("order_count").alias("order_count"))


def month_trend(summary: DataFrame, by: Sequence[str] = ("currency_code",)) -> DataFrame:
    """Sales and order value per month, with the change of the order value to the month before.

    Months follow each other within a currency, because amounts of different
    currencies cannot be compared.
    """
    months = summary.groupBy(*by, "order_month").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("order_count").alias("order_count")
    )
    average = mean(F.col("net_sales"), F.col("order_count"))
    before = F.lag("average_order_value").over(Window.partitionBy(*by).orderBy("order_month"))
    return months.withColumn("average_order_value", average).withColumn(
        "average_order_value_change", F.col("average_order_value") - before
    )
