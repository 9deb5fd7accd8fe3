"""Table layouts: layers, published tables, page documents."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# ---- warehouse layers ------------------------------------------------------

# The tables of each layer.
LAYERS: dict[str, tuple[str, ...]] = {
    "raw": ("raw_customers", "raw_orders", "raw_shopify_orders"),
    "stg": ("stg_customers", "stg_orders"),
    "dw": ("dim_customers", "fact_orders"),
    "mart": ("mart_sales_summary", "mart_daily_sales", "mart_city_sales", "mart_customer_level_sales"),
}

LAYER_OF = {table: layer for layer, tables in LAYERS.items() for table in tables}

CUSTOMER_COLUMNS = ("customer_id", "customer_name", "city", "customer_level")

RAW_ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_amount",
    "order_date",
    "currency_code",
    "ship_country",
    "refund_amount",
)

ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_amount",
    "order_date",
    "order_month",
    "currency_code",
    "ship_country",
    "refund_amount",
    "net_amount",
)

SUMMARY_COLUMNS = (
    "summary_key",
    "city",
    "customer_level",
    "order_month",
    "currency_code",
    "order_count",
    "gross_sales",
    "total_refunds",
    "net_sales",
    "avg_order_amount",
)

SALES_MEASURES = (
    "order_count",
    "customer_count",
    "gross_merchandise_value",
    "total_refunds",
    "net_sales",
    "average_order_value",
)

DAILY_COLUMNS = ("order_date", "order_month", "currency_code", *SALES_MEASURES)
CITY_COLUMNS = ("city", "order_month", "currency_code", *SALES_MEASURES)
LEVEL_COLUMNS = ("customer_level", "order_month", "currency_code", *SALES_MEASURES)

# Name and type of the 44 columns of the wide order table, in table order.
# Amounts are exact decimals here and leave as doubles.
WIDE_ORDER_TYPES: dict[str, str] = {
    "shopify_gid": "string",
    "shop_name": "string",
    "order_id": "string",
    "legacy_order_id": "bigint",
    "customer_legacy_id": "bigint",
    "created_at": "string",
    "beijing_created_at": "string",
    "use_created_at": "string",
    "berlin_created_at": "string",
    "order_status": "string",
    "product_quantity": "int",
    "total_product_amount": "decimal(18,4)",
    "shippingfee": "decimal(18,4)",
    "total_product_discount": "decimal(18,4)",
    "discountfee": "decimal(18,4)",
    "tax": "decimal(18,4)",
    "logistics_status": "string",
    "marketing_intention": "int",
    "currency_code": "string",
    "total_price": "decimal(18,4)",
    "product_sales": "decimal(18,4)",
    "totalrefunded": "decimal(18,4)",
    "discount_method": "string",
    "customer_display_name": "string",
    "customer_email": "string",
    "customer_phone": "string",
    "bill_country": "string",
    "shipping_address1": "string",
    "shipping_address2": "string",
    "shipping_city": "string",
    "shipping_province": "string",
    "shipping_country": "string",
    "shipping_zip": "string",
    "shipping_phone": "string",
    "shipping_name": "string",
    "discount_code": "string",
    "updated_at": "string",
    "cancelled_at": "string",
    "cancel_reason": "string",
    "product_details": "string",
    "discount_information": "string",
    "billing_address": "string",
    "refunds": "string",
    "etl_synced_at": "timestamp",
}

WIDE_ORDER_COLUMNS = tuple(WIDE_ORDER_TYPES)


# ---- published tables ------------------------------------------------------

# The type of every published column. Sums of money may need more than
# twelve digits at scale, so money is eighteen wide.
PUBLISHED_TYPES: dict[str, str] = {
    "customer_id": "bigint",
    "customer_name": "string",
    "city": "string",
    "customer_level": "string",
    "order_id": "bigint",
    "order_amount": "decimal(18,2)",
    "order_date": "date",
    "order_month": "string",
    "currency_code": "string",
    "ship_country": "string",
    "refund_amount": "decimal(18,2)",
    "net_amount": "decimal(18,2)",
    "summary_key": "string",
    "order_count": "bigint",
    "customer_count": "bigint",
    "gross_sales": "decimal(18,2)",
    "gross_merchandise_value": "decimal(18,2)",
    "total_refunds": "decimal(18,2)",
    "net_sales": "decimal(18,2)",
    "avg_order_amount": "decimal(18,2)",
    "average_order_value": "decimal(18,2)",
}


@dataclass(frozen=True)
class PublishedTable:
    """One database table: where its rows come from, its keys and its columns."""

    schema: str
    name: str
    source: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    audit: tuple[str, ...] = ("etl_processed_at",)

    def target(self, prefix: str = "") -> str:
        return f"{self.schema}.{prefix}{self.name}"

    @property
    def not_null(self) -> tuple[str, ...]:
        """Every published column must be filled."""
        return self.columns

    @property
    def types(self) -> dict[str, str]:
        return {c: PUBLISHED_TYPES[c] for c in self.columns}


RAW_AUDIT = ("source_system", "etl_loaded_at")

# Parents first; deleting runs the other way round.
PUBLISHED: tuple[PublishedTable, ...] = (
    PublishedTable("raw", "customers_raw", "raw_customers", CUSTOMER_COLUMNS, ("customer_id",), RAW_AUDIT),
    PublishedTable("raw", "orders_raw", "raw_orders", RAW_ORDER_COLUMNS, ("order_id",), RAW_AUDIT),
    PublishedTable("stg", "customers_clean", "stg_customers", CUSTOMER_COLUMNS, ("customer_id",)),
    PublishedTable("stg", "orders_clean", "stg_orders", ORDER_COLUMNS, ("order_id",)),
    PublishedTable("dw", "dim_customers", "dim_customers", CUSTOMER_COLUMNS, ("customer_id",)),
    PublishedTable("dw", "fact_orders", "fact_orders", ORDER_COLUMNS, ("order_id",)),
    PublishedTable("mart", "sales_summary", "mart_sales_summary", SUMMARY_COLUMNS, ("summary_key",)),
    PublishedTable(
        "mart", "daily_sales", "mart_daily_sales", DAILY_COLUMNS,
        ("order_date", "currency_code"),
    ),
    PublishedTable(
        "mart", "city_sales", "mart_city_sales", CITY_COLUMNS,
        ("city", "order_month", "currency_code"),
    ),
    PublishedTable(
        "mart", "customer_level_sales", "mart_customer_level_sales", LEVEL_COLUMNS,
        ("customer_level", "order_month", "currency_code"),
    ),
)

# The wide order table is upserted on its own and is not part of the full publish.
WIDE_TABLE_NAME = "shopify_orders"
WIDE_KEY = ("shopify_gid",)
# Tables that are merged when read: their key, and what orders the versions of a key.
VERSIONED: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {"raw_shopify_orders": (WIDE_KEY, ("version_at", "edge"))}
WIDE_NOT_NULL = ("shopify_gid", "shop_name", "etl_synced_at")

# ---- page documents --------------------------------------------------------
# Numbers that the API may send as text or as number are read as text and cast later.
# Lists are read as text items, because one item of another kind would otherwise void its list.

_MONEY = "STRUCT<shopMoney: STRUCT<amount: STRING, currencyCode: STRING>>"
_ADDRESS = (
    "STRUCT<address1: STRING, address2: STRING, city: STRING, province: STRING,"
    " country: STRING, zip: STRING, phone: STRING, name: STRING>"
)

# What the wide table reads of a line, and what the table of lines reads.
WIDE_LINE = (
    f"name STRING, quantity STRING, sku STRING, originalUnitPriceSet {_MONEY}, totalDiscountSet {_MONEY},"
    " discountAllocations ARRAY<STRING>"
)
ORDER_LINE = (
    "id STRING, name STRING, quantity STRING, currentQuantity STRING, isGiftCard BOOLEAN, sku STRING, vendor STRING,"
    " product STRUCT<id: STRING, title: STRING>,"
    f" originalTotalSet {_MONEY}, originalUnitPriceSet {_MONEY}, discountedTotalSet {_MONEY}, totalDiscountSet {_MONEY}"
)

DISCOUNT_ALLOCATION = (
    f"allocatedAmountSet {_MONEY},"
    " discountApplication STRUCT<__typename: STRING, title: STRING, code: STRING>"
)

ORDER_NODE = (
    "STRUCT<id: STRING, legacyResourceId: STRING, name: STRING, createdAt: STRING,"
    " updatedAt: STRING, cancelledAt: STRING, cancelReason: STRING, displayFinancialStatus: STRING,"
    " displayFulfillmentStatus: STRING, customerAcceptsMarketing: BOOLEAN, currentSubtotalLineItemsQuantity: STRING,"
    " currencyCode: STRING, discountCode: STRING,"
    f" subtotalPriceSet: {_MONEY}, totalShippingPriceSet: {_MONEY}, totalDiscountsSet: {_MONEY}, totalTaxSet: {_MONEY},"
    f" totalPriceSet: {_MONEY}, totalRefundedSet: {_MONEY},"
    " customer: STRUCT<id: STRING, legacyResourceId: STRING, displayName: STRING, email: STRING, phone: STRING,"
    " firstName: STRING, lastName: STRING>,"
    f" shippingAddress: {_ADDRESS}, billingAddress: STRING, lineItems: STRUCT<nodes: ARRAY<STRING>>,"
    " fulfillments: ARRAY<STRING>, refunds: STRING, metafields: STRUCT<edges: ARRAY<STRING>>,"
    " transactions: ARRAY<STRING>>"
)

REFUND = (
    f"id STRING, createdAt STRING, note STRING, totalRefundedSet {_MONEY},"
    " refundLineItems STRUCT<edges: ARRAY<STRING>>"
)

REFUND_LINE_EDGE = (
    "node STRUCT<quantity: STRING, lineItem: STRUCT<id: STRING, name: STRING,"
    f" variant: STRUCT<id: STRING, sku: STRING>, originalUnitPriceSet: {_MONEY}>>"
)

FULFILLMENT = "status STRING, trackingInfo ARRAY<STRING>"
TRACKING = "number STRING, url STRING, company STRING"
TRANSACTION = "id STRING, kind STRING, status STRING, gateway STRING, createdAt STRING"
METAFIELD_EDGE = "node STRUCT<namespace: STRING, key: STRING, value: STRING>"

_PRICE = "STRUCT<amount: STRING, currencyCode: STRING>"
_RANGE = f"STRUCT<minVariantPrice: {_PRICE}, maxVariantPrice: {_PRICE}>"
_IMAGE = "STRUCT<url: STRING, altText: STRING, width: STRING, height: STRING>"

PRODUCT_NODE = (
    "STRUCT<id: STRING, title: STRING, handle: STRING, description: STRING, vendor: STRING, productType: STRING,"
    " tags: ARRAY<STRING>, createdAt: STRING, updatedAt: STRING, onlineStoreUrl: STRING,"
    f" featuredImage: {_IMAGE}, priceRange: {_RANGE}, compareAtPriceRange: {_RANGE},"
    " variants: STRUCT<edges: ARRAY<STRING>>, images: STRUCT<edges: ARRAY<STRING>>>"
)

VARIANT_EDGE = (
    "node STRUCT<id: STRING, title: STRING, sku: STRING, availableForSale: BOOLEAN,"
    f" price: {_PRICE}, compareAtPrice: {_PRICE}>"
)
IMAGE_EDGE = f"node {_IMAGE}"

CUSTOMER_NODE = (
    "STRUCT<legacyResourceId: STRING, firstName: STRING, lastName: STRING, email: STRING, tags: ARRAY<STRING>,"
    " defaultAddress: STRUCT<city: STRING>>"
)

COMPACT_ORDER_NODE = (
    "STRUCT<legacyResourceId: STRING, name: STRING, createdAt: STRING, displayFinancialStatus: STRING,"
    f" currentTotalPriceSet: {_MONEY},"
    f" customer: {CUSTOMER_NODE}>"
)


def pruned(shape: str, paths: Iterable[str]) -> str:
    """A struct type with only those fields that the dotted paths name, in its own order.

    The JSON parser then passes over everything else without building values. A path to a struct takes all of it; an unknown one is an error.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        name, _, rest = path.partition(".")
        wanted.setdefault(name, []).append(rest)
    fields, known = [], dict(_fields(shape))
    for name, rests in wanted.items():
        if name not in known or (all(rests) and not known[name].startswith("STRUCT<")):
            raise ValueError(f"no field {name} in {shape}")
    for name, kind in known.items():
        if name in wanted:
            fields.append(f"{name}: {kind if '' in wanted[name] else pruned(kind, wanted[name])}")
    return f"STRUCT<{', '.join(fields)}>"


def _fields(shape: str) -> list[tuple[str, str]]:
    """Names and types of a struct type's fields."""
    found, depth, start, inner = [], 0, 0, shape.removeprefix("STRUCT<").removesuffix(">")
    for at, sign in enumerate(f"{inner},"):
        depth += (sign == "<") - (sign == ">")
        if sign == "," and depth == 0:
            name, _, kind = inner[start:at].strip().partition(":")
            found.append((name.strip(), kind.strip()))
            start = at + 1
    return found
