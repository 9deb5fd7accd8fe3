"""Inbox source: customers and orders as JSON documents or CSV, with alias names.

A small JSON file is read whole, by one task. An array in a file of more than SPLIT_FROM bytes is read by many tasks (see
`json_arrays`); an object that holds its array is always read whole. CSV files split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.clock import lenient_date
from salesloom.functions.money import to_money
from salesloom.functions.text import blank_to, strip_all
from salesloom.session import shared_dir
from salesloom.sources.csv_files import path_exists, read_csv_text
from salesloom.sources.json_arrays import items_of_arrays


SPLIT_FROM = 32 << 20


class InboxError(FileNotFoundError):
    """An inbox file is missing."""


def pick_inbox_file(spark: SparkSession, inbox: str, base: str) -> str:
    """`base.json` if it is there, else `base.csv`."""
    for kind in ("json", "csv"):
        path = f"{inbox.rstrip('/')}/{base}.{kind}"
        if path_exists(spark, path):
            return path
    raise InboxError(f"neither {base}.json nor {base}.csv in {inbox}")


def _is_list(text: Column) -> Column:
    return F.ltrim(text).startswith("[")


def json_records(documents: DataFrame, base: str) -> DataFrame:
    """Rows of text maps out of JSON documents in a `document` column.

    A document is an array, or an object whose array is named like the file, or
    `data`, or is the only array in it. Items that are no objects drop out.
    """
    text = F.btrim(F.col("document"), F.lit(" \t\r\n﻿"))
    root = F.from_json(text, "map<string,string>")
    lists = F.map_values(F.map_filter(root, lambda _, value: F.coalesce(_is_list(value), F.lit(False))))
    named, data = F.try_element_at(root, F.lit(base)), F.try_element_at(root, F.lit("data"))
    inner = (
        F.when(_is_list(text), text)
        .when(_is_list(named), named)
        .when(_is_list(data), data)
        .when(F.size(lists) == 1, F.try_element_at(lists, F.lit(1)))
        .otherwise(F.raise_error(F.lit(f"{base}: the JSON must be an array or an object holding one")))
    )
    items = documents.select(F.from_json(inner, "array<string>").alias("items")).select(
        F.when(F.col("items").isNotNull(), F.col("items"))
        .otherwise(F.raise_error(F.lit(f"{base}: the JSON array cannot be read")))
        .alias("items")
    )
    return _objects(items)


def _objects(lists: DataFrame) -> DataFrame:
    """One row with a text map for every object in the `items`."""
    records = F.transform(
        F.filter("items", lambda item: item.startswith("{")), lambda item: F.from_json(item, "map<string,string>")
    )
    return lists.select(F.explode(records).alias("record"))


def csv_records(rows: DataFrame) -> DataFrame:
    """Rows of text maps out of CSV text columns; an empty cell is empty text, not NULL."""
    entries = [part for name in rows.columns for part in (F.lit(name), F.coalesce(F.col(name), F.lit("")))]
    return rows.select(F.create_map(*entries).alias("record"))


def _alias(*names: str) -> Column:
    """The first name that the record holds, even when its value is NULL."""
    record = F.col("record")
    value = F.try_element_at(record, F.lit(names[-1]))
    for name in reversed(names[:-1]):
        value = F.when(F.map_contains_key(record, F.lit(name)), F.try_element_at(record, F.lit(name))).otherwise(value)
    return value


def whole_id(text: Column, cut: bool) -> Column:
    """A whole-number id. JSON numbers with a fraction are cut, as text (CSV) they raise."""
    given = strip_all(text)
    exact = given.try_cast("bigint")
    if cut:
        number = given.cast("decimal(38,6)")
        other = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("bigint")
    else:
        other = F.raise_error(F.concat(F.lit("no whole number: "), given)).cast("bigint")
    # A plain whole number is read exactly; try_cast alone would cut fractions of text as well.
    return F.when(text.isNull(), F.lit(None).cast("bigint")).when(given.rlike(r"^[+-]?[0-9]+$"), exact).otherwise(other)


def _required(value: Column, what: str) -> Column:
    problem = F.raise_error(F.concat(F.lit(f"inbox row lacks {what}: "), F.to_json("record")))
    return F.when(value.isNull(), problem).otherwise(value)


def inbox_customers(records: DataFrame, cut_ids: bool = True) -> DataFrame:
    """Customers with their defaults. A row without an id raises; `cut_ids` is for JSON records."""
    fields = records.select(
        "record",
        _required(_alias("customer_id", "id"), "customer_id").alias("id"),
        _alias("customer_name", "name").alias("name"),
        _alias("city", "defaultCity").alias("city"),
        _alias("customer_level", "level").alias("level"),
    )
    return fields.select(
        whole_id(F.col("id"), cut_ids).alias("customer_id"),
        blank_to(F.col("name"), F.concat(F.lit("customer_"), F.col("id"))).alias("customer_name"),
        blank_to(F.col("city"), "unknown").alias("city"),
        F.lower(blank_to(F.col("level"), "standard")).alias("customer_level"),
    )


def inbox_orders(records: DataFrame, today: Column | None = None, cut_ids: bool = True) -> DataFrame:
    """Orders with lenient dates. A row without id, customer or amount raises."""
    fields = records.select(
        "record",
        _required(_alias("order_id", "id"), "order_id").alias("id"),
        _required(_alias("customer_id", "customerId"), "customer_id").alias("customer"),
        _required(_alias("order_amount", "amount", "total"), "order_amount").alias("amount"),
        _alias("order_date", "date", "createdAt").alias("day"),
    )
    return fields.select(
        whole_id(F.col("id"), cut_ids).alias("order_id"),
        whole_id(F.col("customer"), cut_ids).alias("customer_id"),
        to_money(strip_all(F.col("amount"))).alias("order_amount"),
        lenient_date(F.col("day"), today).alias("order_date"),
    )


def inbox_records(spark: SparkSession, inbox: str, base: str) -> DataFrame:
    path = pick_inbox_file(spark, inbox, base)
    if path.endswith(".json"):
        return json_file_records(spark, path, base)
    return csv_records(read_csv_text(spark, path, multiline=True))


def json_file_records(spark: SparkSession, path: str, base: str, split_from: int = SPLIT_FROM) -> DataFrame:
    """Records of a JSON file or a folder of them; large arrays are read by many tasks."""
    documents = spark.read.text(path, wholetext=True).withColumnRenamed("value", "document")
    size = F.col("_metadata.file_size")
    small = json_records(documents.filter(size <= split_from).select("document"), base)
    # Sizes from the listing: a text scan would load each large file whole.
    if spark.read.format("binaryFile").load(path).filter(F.col("length") > split_from).select("path").limit(1).isEmpty():
        return small
    lists = items_of_arrays(spark, path, split_from)
    held = f"{shared_dir(spark, 'inbox-items')}/rows"
    lists.write.parquet(held)
    lists = spark.read.parquet(held)
    found = small.unionByName(_objects(lists))
    objects = lists.filter("items IS NULL").select("file")
    if objects.isEmpty():
        return found
    named = documents.filter(size > split_from).withColumn("file", F.col("_metadata.file_path")).join(objects, "file", "left_semi")
    return found.unionByName(json_records(named.select("document"), base))


def read_inbox(spark: SparkSession, inbox: str, today: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Customers and orders of an inbox folder."""
    if not path_exists(spark, inbox):
        raise InboxError(f"no inbox folder {inbox}")
    is_json = {base: pick_inbox_file(spark, inbox, base).endswith(".json") for base in ("customers", "orders")}
    return (
        inbox_customers(inbox_records(spark, inbox, "customers"), is_json["customers"]),
        inbox_orders(inbox_records(spark, inbox, "orders"), today, is_json["orders"]),
    )
