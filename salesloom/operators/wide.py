"""Nested order documents to the wide order table, one select, no Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.functions.clock import CITY_ZONES, city_clock, instant, wall_clock
from salesloom.functions.money import money_or_zero, to_money
from salesloom.functions.text import blank_to, or_empty, strip_all
from salesloom.sources.pages import objects, order_nodes, order_number, whole_number

# Gift and sample items that do not count as products.
EXCLUDED_SKUS = ("DG-002", "DG-004", "TBFS-01")
# Fixed value: orders without a customer get an id of their own above this number.
GUEST_OFFSET = 5_000_000_000_000

_LONG_MONEY = "decimal(38,4)"


def _shop_amount(holder: Column, name: str) -> Column:
    return money_or_zero(holder[name]["shopMoney"]["amount"])


def _count(value: Column) -> Column:
    """Whole number out of a JSON number or text, 0 when missing; a fraction is cut off."""
    given = F.nullif(value, F.lit(""))
    cut = given.cast("decimal(20,6)").cast("int")
    return F.when(given.isNull(), 0).otherwise(F.coalesce(value.try_cast("int"), cut))


def _line_totals(lines: Column, excluded: Sequence[str]) -> Column:
    """Price and discount times quantity, summed over the lines that count as products."""
    none = F.lit(Decimal(0)).cast(_LONG_MONEY)

    def add(done: Column, line: Column) -> Column:
        quantity = _count(line["quantity"])
        counts = ~F.coalesce(line["sku"], F.lit("")).isin(*excluded)
        amount = done["amount"] + _shop_amount(line, "originalUnitPriceSet") * quantity
        discount = done["discount"] + _shop_amount(line, "totalDiscountSet") * quantity
        summed = F.struct(amount.cast(_LONG_MONEY).alias("amount"), discount.cast(_LONG_MONEY).alias("discount"))
        return F.when(counts, summed).otherwise(done)

    return F.aggregate(lines, F.struct(none.alias("amount"), none.alias("discount")), add)


def line_discounts(lines: Column) -> Column:
    """Per line: name, sku, quantity and its discounts with type, title, code, amount and currency."""

    def discount(allocation: Column) -> Column:
        applied = allocation["discountApplication"]
        money = allocation["allocatedAmountSet"]["shopMoney"]
        return F.struct(
            applied["__typename"].alias("type"),
            applied["title"].alias("title"),
            applied["code"].alias("code"),
            money_or_zero(money["amount"]).cast("double").alias("amount"),
            money["currencyCode"].alias("currency"),
        )

    def line_info(line: Column) -> Column:
        allocations = objects(F.coalesce(line["discountAllocations"], F.array().cast("array<string>")),
                              schemas.DISCOUNT_ALLOCATION)
        return F.struct(
            line["name"].alias("name"),
            line["sku"].alias("sku"),
            line["quantity"].try_cast("bigint").alias("quantity"),
            F.transform(allocations, discount).alias("discounts"),
        )

    return F.transform(lines, line_info)


def with_lines(nodes: DataFrame, shape: str = schemas.WIDE_LINE) -> DataFrame:
    """Nodes with their parsed lines, so that no later expression parses them again."""
    none = F.array().cast("array<string>")
    given = F.coalesce(F.col("node.lineItems.nodes"), none)
    return nodes.withColumn("line_texts", F.filter(given, lambda item: item.startswith("{"))).withColumn(
        "lines", F.transform("line_texts", lambda item: F.from_json(item, shape))
    )


_ID, _CUSTOMER_ID = ("legacyResourceId", "id"), "customer.legacyResourceId"
# What each wide column reads of an order node.
NODE_READS: dict[str, tuple[str, ...]] = {
    "shopify_gid": ("id",),
    "shop_name": (),
    "order_id": ("name",),
    "legacy_order_id": _ID,
    "customer_legacy_id": (*_ID, _CUSTOMER_ID),
    "created_at": ("createdAt",),
    **{name: ("createdAt",) for name in CITY_ZONES},
    "order_status": ("displayFinancialStatus",),
    "product_quantity": ("currentSubtotalLineItemsQuantity",),
    "total_product_amount": ("lineItems",),
    "shippingfee": ("totalShippingPriceSet",),
    "total_product_discount": ("lineItems",),
    "discountfee": ("totalDiscountsSet",),
    "tax": ("totalTaxSet",),
    "logistics_status": ("displayFulfillmentStatus",),
    "marketing_intention": ("customerAcceptsMarketing",),
    "currency_code": ("currencyCode",),
    "total_price": ("totalPriceSet",),
    "product_sales": ("subtotalPriceSet",),
    "totalrefunded": ("totalRefundedSet",),
    "discount_method": (),
    "customer_display_name": ("customer.displayName", "customer.firstName", "customer.lastName"),
    "customer_email": ("customer.email",),
    "customer_phone": ("customer.phone",),
    "bill_country": ("billingAddress",),
    **{f"shipping_{part}": (f"shippingAddress.{part}",) for part in ("address1", "address2", "city", "province", "country", "zip", "phone", "name")},
    "discount_code": ("discountCode",),
    "updated_at": ("updatedAt",),
    "cancelled_at": ("cancelledAt",),
    "cancel_reason": ("cancelReason",),
    "product_details": ("lineItems",),
    "discount_information": ("lineItems",),
    "billing_address": ("billingAddress",),
    "refunds": ("refunds",),
    "etl_synced_at": (),
}


def node_fields(columns: Iterable[str]) -> list[str]:
    """The node fields that these wide columns read, for `order_nodes(fields=...)`."""
    return list(dict.fromkeys(path for name in columns for path in NODE_READS[name])) or ["id"]


def wide_columns(pages_: DataFrame, shop_name: str, columns: Sequence[str], on_fault: str = "raise") -> DataFrame:
    """Some wide columns straight from order pages; of each node only what they read is parsed."""
    return wide_orders(order_nodes(pages_, on_fault, fields=node_fields(columns)), shop_name, columns=columns)


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def wide_orders(
    nodes: DataFrame,
    shop_name: str,
    excluded_skus: Sequence[str] = EXCLUDED_SKUS,
    keep: Sequence[str] = (),
    versioned: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The 44 columns of the wide order table, or those in `columns`, plus `keep` columns of the pages.

    `versioned` adds `version_at`, the point in time of the update: the text columns drop the offset and the
    fractions of a second, so they cannot order versions.
    """
    node = F.col("node")
    wanted = list(schemas.WIDE_ORDER_TYPES) if columns is None else list(columns)
    reads = {path.partition(".")[0] for path in node_fields(wanted)}
    helpers = {"node": node}
    if "lineItems" in reads:
        nodes = with_lines(nodes)
        helpers |= {"line_texts": F.col("line_texts"), "lines": F.col("lines"), "products": _line_totals(F.col("lines"), excluded_skus)}
    if "createdAt" in reads:
        helpers["created"] = instant(node["createdAt"])
    if "legacyResourceId" in reads:
        helpers["legacy_order_id"] = order_number(node)
    if "customer_legacy_id" in wanted:
        helpers["customer_number"] = whole_number(node["customer"]["legacyResourceId"])
    if "billingAddress" in reads:
        helpers["billing"] = F.when(node["billingAddress"].startswith("{"), node["billingAddress"])
    prepared = nodes.select(*keep, *[value.alias(name) for name, value in helpers.items()])
    lines, created = F.col("lines"), F.col("created")
    customer, shipping = node["customer"], node["shippingAddress"]
    no_customer = F.coalesce(F.col("customer_number"), F.lit(0)) == 0
    full_name = strip_all(
        F.concat(strip_all(or_empty(customer["firstName"])), F.lit(" "), strip_all(or_empty(customer["lastName"])))
    )
    values = {
        "shopify_gid": or_empty(node["id"]),
        "shop_name": F.lit(shop_name),
        "order_id": or_empty(node["name"]),
        "legacy_order_id": F.col("legacy_order_id"),
        "customer_legacy_id": F.when(
            no_customer & F.col("legacy_order_id").isNotNull(), F.lit(GUEST_OFFSET) + F.col("legacy_order_id")
        ).otherwise(F.col("customer_number")),
        "created_at": wall_clock(node["createdAt"]),
        **{name: city_clock(created, zone) for name, zone in CITY_ZONES.items()},
        "order_status": or_empty(node["displayFinancialStatus"]),
        "product_quantity": _count(node["currentSubtotalLineItemsQuantity"]),
        "total_product_amount": to_money(F.col("products.amount")),
        "shippingfee": _shop_amount(node, "totalShippingPriceSet"),
        "total_product_discount": to_money(F.col("products.discount")),
        "discountfee": _shop_amount(node, "totalDiscountsSet"),
        "tax": _shop_amount(node, "totalTaxSet"),
        "logistics_status": or_empty(node["displayFulfillmentStatus"]),
        "marketing_intention": F.coalesce(node["customerAcceptsMarketing"], F.lit(False)).cast("int"),
        "currency_code": or_empty(node["currencyCode"]),
        "total_price": _shop_amount(node, "totalPriceSet"),
        "product_sales": _shop_amount(node, "subtotalPriceSet"),
        "totalrefunded": _shop_amount(node, "totalRefundedSet"),
        "discount_method": F.lit(""),
        "customer_display_name": blank_to(customer["displayName"], full_name),
        "customer_email": or_empty(customer["email"]),
        "customer_phone": or_empty(customer["phone"]),
        "bill_country": or_empty(F.get_json_object("billing", "$.country")),
        "shipping_address1": or_empty(shipping["address1"]),
        "shipping_address2": or_empty(shipping["address2"]),
        "shipping_city": or_empty(shipping["city"]),
        "shipping_province": or_empty(shipping["province"]),
        "shipping_country": or_empty(shipping["country"]),
        "shipping_zip": or_empty(shipping["zip"]),
        "shipping_phone": or_empty(shipping["phone"]),
        "shipping_name": strip_all(or_empty(shipping["name"])),
        "discount_code": or_empty(node["discountCode"]),
        "updated_at": wall_clock(node["updatedAt"]),
        "cancelled_at": wall_clock(node["cancelledAt"]),
        "cancel_reason": or_empty(node["cancelReason"]),
        "product_details": F.concat(F.lit("["), F.array_join("line_texts", ","), F.lit("]")),
        "discount_information": _json(line_discounts(lines)),
        "billing_address": F.coalesce(F.col("billing"), F.lit("{}")),
        "refunds": F.coalesce(node["refunds"], F.lit("null")),
        "etl_synced_at": F.current_timestamp(),
    }
    typed = [values[name].cast(schemas.WIDE_ORDER_TYPES[name]).alias(name) for name in wanted]
    version = [instant(node["updatedAt"]).alias("version_at")] if versioned else []
    return prepared.select(*keep, *typed, *version)
