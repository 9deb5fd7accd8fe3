"""Product catalogue tables out of product nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.money import to_money
from salesloom.sources.pages import objects


def _price(holder: Column) -> Column:
    return to_money(holder["amount"])


def products(nodes: DataFrame) -> DataFrame:
    """One row per product; order by title for a catalogue listing."""
    node = F.col("node")
    return nodes.select(
        node["id"].alias("product_id"),
        node["title"].alias("title"),
        node["handle"].alias("handle"),
        node["description"].alias("description"),
        node["vendor"].alias("vendor"),
        node["productType"].alias("product_type"),
        F.array_join(node["tags"], ",").alias("tags"),
        node["createdAt"].alias("created_at"),
        node["updatedAt"].alias("updated_at"),
        node["onlineStoreUrl"].alias("store_url"),
        node["featuredImage"]["url"].alias("image_url"),
        _price(node["priceRange"]["minVariantPrice"]).alias("min_price"),
        _price(node["priceRange"]["maxVariantPrice"]).alias("max_price"),
        _price(node["compareAtPriceRange"]["minVariantPrice"]).alias("compare_at_min_price"),
        _price(node["compareAtPriceRange"]["maxVariantPrice"]).alias("compare_at_max_price"),
        node["priceRange"]["minVariantPrice"]["currencyCode"].alias("currency_code"),
    )


def _edge_rows(nodes: DataFrame, edges: Column, shape: str) -> DataFrame:
    node = F.col("node")
    return nodes.select(
        node["id"].alias("product_id"),
        node["title"].alias("title"),
        F.posexplode_outer(objects(edges, shape)).alias("position", "edge"),
    )


def product_variants(nodes: DataFrame) -> DataFrame:
    """One row per variant; a product without variants keeps one row."""
    variant = F.col("edge.node")
    return _edge_rows(nodes, F.col("node.variants.edges"), schemas.VARIANT_EDGE).select(
        "product_id",
        "title",
        "position",
        variant["id"].alias("variant_id"),
        variant["title"].alias("variant_title"),
        variant["sku"].alias("sku"),
        variant["availableForSale"].alias("available"),
        _price(variant["price"]).alias("price"),
        _price(variant["compareAtPrice"]).alias("compare_at_price"),
        variant["price"]["currencyCode"].alias("currency_code"),
    )


def product_images(nodes: DataFrame) -> DataFrame:
    """One row per image; a product without images keeps one row."""
    image = F.col("edge.node")
    return _edge_rows(nodes, F.col("node.images.edges"), schemas.IMAGE_EDGE).select(
        "product_id",
        "title",
        "position",
        image["url"].alias("url"),
        image["altText"].alias("alt_text"),
        image["width"].try_cast("int").alias("width"),
        image["height"].try_cast("int").alias("height"),
    )
