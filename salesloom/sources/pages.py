"""Recorded API pages: orders, products and customers as nested JSON documents.

A page is one JSON document with edges and nodes, either the whole response or its
`data` part. Pages lie in folders, by default one page per line so that large files
split; `day=YYYY-MM-DD` folders become a `day` column and prune the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.clock import wall_clock
from salesloom.functions.money import money_or_zero
from salesloom.functions.text import blank_to, gid_number, level_from_tags, or_empty, strip_all


def read_pages(spark: SparkSession, path: str, page_per_line: bool = True) -> DataFrame:
    """Page documents in a `document` column, with the folder's partition columns."""
    text = spark.read.text(path, wholetext=not page_per_line)
    return text.withColumnRenamed("value", "document")


def objects(items: Column, shape: str) -> Column:
    """The JSON objects of a list of JSON texts, parsed; other items drop out."""
    return F.transform(F.filter(items, lambda item: item.startswith("{")), lambda item: F.from_json(item, shape))


def _answer(root: str, item: str) -> str:
    """The shape of a page: the whole response or its data part."""
    connection = f"{root}: STRUCT<edges: ARRAY<{item}>, pageInfo: STRUCT<hasNextPage: BOOLEAN>>"
    return f"STRUCT<data: STRUCT<{connection}>, {connection}, errors: STRING>"


def _edges(page: Column, root: str) -> Column:
    return F.coalesce(page["data"][root]["edges"], page[root]["edges"])


def _fault(errors: Column, edges: Column, root: str) -> Column:
    """Why a page cannot be used, NULL if it can."""
    failed = F.coalesce(errors, F.lit("[]")) != "[]"
    return F.when(failed, F.concat(F.lit("error answer: "), errors)).when(
        edges.isNull(), F.lit(f"no readable list of {root}")
    )


def nodes(
    pages: DataFrame, root: str, node_type: str, on_fault: str = "raise", position: str | None = None
) -> DataFrame:
    """One row per node of the pages, next to the other columns of the page.

    A page that cannot be read and an error answer stop the job; with on_fault="skip" they give no rows here and are
    found by `rejected_pages`. A page is parsed once. A list item that is no object voids its list in that pass;
    only such pages are parsed again, item by item, and the item drops out. All of it happens inside the exploded
    expression, so later filters do not repeat it. `position` names a column for the place of the node in its page.
    """
    others = [c for c in pages.columns if c != "document"]
    edge = f"cursor: STRING, node: {node_type}"
    whole = pages.select(*others, "document", F.from_json("document", _answer(root, f"STRUCT<{edge}>")).alias("page"))
    items = _edges(F.from_json("document", _answer(root, "STRING")), root)
    found = F.coalesce(_edges(F.col("page"), root), objects(items, f"STRUCT<{edge}>"))
    if on_fault == "raise":
        fault = _fault(F.col("page.errors"), found, root)
        excerpt = F.left(F.coalesce("document", F.lit("NULL")), F.lit(200))
        found = F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.lit(" in page: "), excerpt))).otherwise(found)
    elif on_fault != "skip":
        raise ValueError("on_fault is raise or skip")
    else:
        found = F.when(_fault(F.col("page.errors"), found, root).isNull(), found)
    kept = F.filter(found, lambda item: item["node"].isNotNull())
    if position:
        rows = whole.select(*others, F.posexplode(kept).alias(position, "edge__"))
        return rows.select(*others, position, F.col("edge__.node").alias("node"))
    return whole.select(*others, F.explode(kept).alias("edge__")).select(*others, F.col("edge__.node").alias("node"))


def rejected_pages(pages: DataFrame, root: str) -> DataFrame:
    """The pages that give no nodes because they cannot be read or carry errors, with the reason."""
    page = F.from_json("document", _answer(root, "STRING"))
    parsed = pages.withColumn("page__", page)
    reason = _fault(F.col("page__.errors"), _edges(F.col("page__"), root), root)
    return parsed.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull()).drop("page__")


def page_chains(pages: DataFrame, root: str, by: str = "day") -> DataFrame:
    """Whether the recorded pages of each folder are one unbroken chain: page_count, gaps, open_ends, complete.

    A page may record the cursor it was asked with (`after`) and where it ends (`pageInfo.endCursor`, else the cursor of its last edge). A gap is a page
    whose `after` is no other page's end; an open end is a page that announces a next one which is not there. Pages that were recorded
    twice count once. A folder whose pages record no `after` has an open end if all of its pages announce a next one.
    """
    info = "pageInfo: STRUCT<hasNextPage: BOOLEAN, endCursor: STRING>"
    connection = f"{root}: STRUCT<edges: ARRAY<STRUCT<cursor: STRING>>, {info}>"
    page = F.from_json("document", f"STRUCT<after: STRING, data: STRUCT<{connection}>, {connection}>")
    parsed = pages.select(by, page.alias("page"))
    part = F.coalesce(F.col("page.data")[root], F.col("page")[root])
    end = F.coalesce(part["pageInfo"]["endCursor"], F.try_element_at(part["edges"], F.lit(-1))["cursor"])
    more = F.coalesce(part["pageInfo"]["hasNextPage"], F.lit(False))
    links = parsed.select(by, F.col("page.after").alias("after"), end.alias("end"), more.alias("more")).distinct()
    ends = links.filter(F.col("end").isNotNull()).select(by, F.col("end").alias("after"), F.lit(True).alias("has_before")).distinct()
    starts = links.filter(F.col("after").isNotNull()).select(by, F.col("after").alias("end"), F.lit(True).alias("has_next")).distinct()
    joined = links.join(ends, [by, "after"], "left").join(starts, [by, "end"], "left")
    counted = joined.groupBy(by).agg(
        F.count("*").alias("page_count"),
        F.count_if(F.col("after").isNotNull() & F.col("has_before").isNull()).alias("gaps"),
        F.count_if(F.col("more") & F.col("has_next").isNull()).alias("open"),
        F.bool_or(F.col("after").isNotNull()).alias("linked"),
        F.bool_and("more").alias("all_more"),
    )
    open_ends = F.when(F.col("linked"), F.col("open")).otherwise(F.col("all_more").cast("bigint"))
    counted = counted.select(by, "page_count", "gaps", open_ends.alias("open_ends"))
    return counted.withColumn("complete", (F.col("gaps") == 0) & (F.col("open_ends") == 0))


def order_nodes(
    pages: DataFrame, on_fault: str = "raise", position: str | None = None, fields: Iterable[str] | None = None
) -> DataFrame:
    """Order nodes; `fields` are the dotted paths that are read of them, all by default."""
    shape = schemas.ORDER_NODE if fields is None else schemas.pruned(schemas.ORDER_NODE, fields)
    return nodes(pages, "orders", shape, on_fault, position)


def product_nodes(pages: DataFrame) -> DataFrame:
    return nodes(pages, "products", schemas.PRODUCT_NODE)


def customer_nodes(pages: DataFrame) -> DataFrame:
    return nodes(pages, "customers", schemas.CUSTOMER_NODE)


def compact_order_nodes(pages: DataFrame) -> DataFrame:
    return nodes(pages, "orders", schemas.COMPACT_ORDER_NODE)


def whole_number(text: Column) -> Column:
    return strip_all(text).try_cast("bigint")


def _full_name(first: Column, last: Column) -> Column:
    return strip_all(F.concat(strip_all(or_empty(first)), F.lit(" "), strip_all(or_empty(last))))


def customers_from_pages(pages: DataFrame) -> DataFrame:
    """raw_customers out of customer pages, the level out of the tags."""
    return customer_nodes(pages).select(
        whole_number(F.col("node.legacyResourceId")).alias("customer_id"),
        F.coalesce(
            F.nullif(_full_name(F.col("node.firstName"), F.col("node.lastName")), F.lit("")), F.lit("guest")
        ).alias("customer_name"),
        blank_to(F.col("node.defaultAddress.city"), "unknown").alias("city"),
        level_from_tags(F.col("node.tags"), is_array=True).alias("customer_level"),
    )


def orders_from_pages(pages: DataFrame) -> DataFrame:
    """raw_orders out of compact order pages."""
    money = F.col("node.currentTotalPriceSet.shopMoney")
    return compact_order_nodes(pages).select(
        whole_number(F.col("node.legacyResourceId")).alias("order_id"),
        whole_number(F.col("node.customer.legacyResourceId")).alias("customer_id"),
        money_or_zero(money["amount"]).alias("order_amount"),
        wall_clock(F.col("node.createdAt")).cast("date").alias("order_date"),
        blank_to(money["currencyCode"], "UNKNOWN").alias("currency_code"),
        F.lit("UNKNOWN").alias("ship_country"),
        money_or_zero(F.lit(None)).alias("refund_amount"),
    )


def page_probe(pages: DataFrame, root: str = "products") -> DataFrame:
    """Pages and nodes of the recorded catalogue."""
    connection = f"{root}: STRUCT<edges: ARRAY<STRING>>"
    parsed = F.from_json("document", f"STRUCT<data: STRUCT<{connection}>, {connection}>")
    edges = F.coalesce(parsed["data"][root]["edges"], parsed[root]["edges"])
    return pages.select(F.coalesce(F.size(edges), F.lit(0)).alias("edges")).agg(
        F.count("*").alias("page_count"), F.coalesce(F.sum("edges"), F.lit(0)).alias("node_count")
    )


def order_number(node: Column) -> Column:
    """Numeric order id: the legacy id, else the digits at the end of the global id."""
    return F.coalesce(whole_number(node["legacyResourceId"]), gid_number(node["id"]))
