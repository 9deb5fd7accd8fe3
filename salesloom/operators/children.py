"""Child tables of nested orders: lines, refund lines, fulfilments, transactions, metafields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.money import money_or_zero
from salesloom.operators.wide import line_discounts, with_lines
from salesloom.sources.pages import objects, order_number


def _amount(holder: Column, name: str) -> Column:
    return money_or_zero(holder[name]["shopMoney"]["amount"])


def _children(nodes: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per child object; orders without children keep one row of NULLs."""
    node = F.col("node")
    return nodes.select(
        node["id"].alias("shopify_gid"),
        order_number(node).alias("legacy_order_id"),
        F.posexplode_outer(items).alias("position", name),
    )


# What the child tables read of a node.
CHILD_KEYS = ("id", "legacyResourceId")
LINE_READS = (*CHILD_KEYS, "lineItems")


def order_lines(nodes: DataFrame) -> DataFrame:
    line = F.col("line")
    return _children(with_lines(nodes, schemas.ORDER_LINE), F.col("lines"), "line").select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        line["id"].alias("line_id"),
        line["name"].alias("line_name"),
        line["sku"].alias("sku"),
        line["vendor"].alias("vendor"),
        line["product"]["id"].alias("product_id"),
        line["product"]["title"].alias("product_title"),
        line["isGiftCard"].alias("is_gift_card"),
        line["quantity"].try_cast("int").alias("quantity"),
        line["currentQuantity"].try_cast("int").alias("current_quantity"),
        _amount(line, "originalUnitPriceSet").alias("unit_price"),
        _amount(line, "originalTotalSet").alias("original_total"),
        _amount(line, "discountedTotalSet").alias("discounted_total"),
        _amount(line, "totalDiscountSet").alias("total_discount"),
    )


def order_discounts(nodes: DataFrame) -> DataFrame:
    """One row per discount of a line."""
    node = F.col("node")
    info = with_lines(nodes).select(
        node["id"].alias("shopify_gid"),
        order_number(node).alias("legacy_order_id"),
        F.posexplode(line_discounts(F.col("lines"))).alias("position", "line"),
    )
    return info.select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        F.col("line.sku").alias("sku"),
        F.col("line.quantity").alias("quantity"),
        F.inline("line.discounts"),
    )


def refund_lines(nodes: DataFrame) -> DataFrame:
    """One row per refunded line; a refund without lines keeps one row."""
    refunds = objects(F.from_json(F.col("node.refunds"), "array<string>"), schemas.REFUND)
    refund, edge = F.col("refund"), F.col("edge")
    per_refund = _children(nodes, refunds, "refund").filter(F.col("refund").isNotNull())
    edges = objects(refund["refundLineItems"]["edges"], schemas.REFUND_LINE_EDGE)
    return per_refund.select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        refund["id"].alias("refund_id"),
        refund["createdAt"].alias("refunded_at"),
        refund["note"].alias("note"),
        _amount(refund, "totalRefundedSet").alias("refund_total"),
        F.posexplode_outer(edges).alias("line_position", "edge"),
    ).select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        "refund_id",
        "refunded_at",
        "note",
        "refund_total",
        "line_position",
        edge["node"]["lineItem"]["id"].alias("line_id"),
        edge["node"]["lineItem"]["name"].alias("line_name"),
        edge["node"]["lineItem"]["variant"]["sku"].alias("sku"),
        edge["node"]["quantity"].try_cast("int").alias("quantity"),
        _amount(edge["node"]["lineItem"], "originalUnitPriceSet").alias("unit_price"),
    )


def fulfillments(nodes: DataFrame) -> DataFrame:
    """One row per tracking entry; a fulfilment without tracking keeps one row."""
    item, tracking = F.col("item"), F.col("tracking")
    items = objects(F.col("node.fulfillments"), schemas.FULFILLMENT)
    per_item = _children(nodes, items, "item").filter(F.col("item").isNotNull())
    return per_item.select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        item["status"].alias("status"),
        F.explode_outer(objects(item["trackingInfo"], schemas.TRACKING)).alias("tracking"),
    ).select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        "status",
        tracking["number"].alias("tracking_number"),
        tracking["url"].alias("tracking_url"),
        tracking["company"].alias("company"),
    )


def transactions(nodes: DataFrame) -> DataFrame:
    item = F.col("item")
    items = objects(F.col("node.transactions"), schemas.TRANSACTION)
    return _children(nodes, items, "item").filter(F.col("item").isNotNull()).select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        item["id"].alias("transaction_id"),
        item["kind"].alias("kind"),
        item["status"].alias("status"),
        item["gateway"].alias("gateway"),
        item["createdAt"].alias("processed_at"),
    )


def metafields(nodes: DataFrame) -> DataFrame:
    item = F.col("item")
    items = objects(F.col("node.metafields.edges"), schemas.METAFIELD_EDGE)
    return _children(nodes, items, "item").filter(F.col("item").isNotNull()).select(
        "shopify_gid",
        "legacy_order_id",
        "position",
        item["node"]["namespace"].alias("namespace"),
        item["node"]["key"].alias("key"),
        item["node"]["value"].alias("value"),
    )
