"""The star-schema tables of a folder as the inputs of the warehouse jobs.

Nothing is subset: every function reads its tables whole. Re-deliveries, blanks and
missing parts follow from the values of the rows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.session import shared_dir, shuffles_removed
from salesloom.sources.pages import read_pages

MONEY = "decimal(18,2)"


@cache
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a lazy scan; its footer is read for the schema once per session, not once per use."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def located(spark: SparkSession, folder: str, customers: DataFrame) -> DataFrame:
    """Rows with c_nationkey, joined to their nation and region."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their nation and region."""
    return located(spark, folder, table(spark, folder, "customer"))


def orders_with_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer, nation and region."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return located(spark, folder, orders.join(customers, F.col("o_custkey") == F.col("c_custkey")))


def _deliveries(twice: Column) -> Column:
    return F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with blanks around their texts; overdrawn ones come a second time without a name."""
    rows = places(spark, folder).select(
        "c_custkey", "c_name", "n_name", "c_mktsegment", _deliveries(F.col("c_acctbal") < 0).alias("delivery")
    )
    return rows.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("delivery") == 1, F.concat(F.lit(" "), "c_name", F.lit("　"))).alias("customer_name"),
        F.concat(F.lit("　"), F.lower("n_name"), F.lit(" ")).alias("city"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit("  ")).alias("customer_level"),
    )


def currency(region: Column) -> Column:
    return (
        F.when(region == "AFRICA", " zar ").when(region == "AMERICA", "usd").when(region == "ASIA", "cny")
        .when(region == "EUROPE", "eur").otherwise("")
    )


def refunds(spark: SparkSession, folder: str) -> DataFrame:
    """Value of the returned lines per order."""
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return (
        table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey").agg(F.round(F.sum(net), 2).cast(MONEY).alias("refund"))
    )


def base_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer and refund, each once."""
    return orders_with_customers(spark, folder).join(
        refunds(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )


def as_raw_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        currency(F.col("r_name")).alias("currency_code"),
        F.when(F.col("n_name") == "NATION_0", "").otherwise(F.col("n_name")).alias("ship_country"),
        F.col("refund").alias("refund_amount"),
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as delivered: pending ones come twice."""
    once = base_orders(spark, folder)
    return as_raw_orders(once.withColumn("delivery", _deliveries(F.col("o_orderstatus") == "P")))


# ---- nested documents ------------------------------------------------------

SKUS = {"A": "SKU-A", "N": "SKU-N", "R": "DG-002"}


def _in_share(key: str, share: int, shares: int) -> Column:
    """Whether an order belongs to one of the shares that its key is dealt to; orders without a key are one share's."""
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(shares)) == share


def order_parts(spark: SparkSession, folder: str, share: int = 0, shares: int = 1) -> DataFrame:
    """Orders with all their line items, in the order of the line number; all of them or one share."""
    item = F.struct(
        F.col("l_linenumber").cast("int").alias("n"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").cast(MONEY).alias("unit"),
        F.col("l_discount").cast("decimal(12,2)").alias("disc"),
        F.col("l_tax").cast(MONEY).alias("tax"),
    )
    orders, lines = orders_with_customers(spark, folder), table(spark, folder, "lineitem")
    if shares > 1:
        orders, lines = orders.filter(_in_share("o_orderkey", share, shares)), lines.filter(_in_share("l_orderkey", share, shares))
    lines = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("items"))
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    # The joined sides may all be broadcast, and the scan of the orders be one split: the texts are built in many tasks.
    return joined.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")


def _money(amount: Column, code: Column | None = None) -> Column:
    parts = [amount.cast("string").alias("amount")]
    if code is not None:
        parts.append(code.alias("currencyCode"))
    return F.when(amount.isNotNull(), F.struct(F.struct(*parts).alias("shopMoney")))


def _line_id(item: Column, key: Column) -> Column:
    return F.concat(F.lit("gid://shop/LineItem/"), item["n"].cast("string"), F.lit("-"), key)


def _sku(item: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in SKUS.items() for x in pair])[item["flag"]]


def _line(item: Column, key: Column) -> Column:
    """A line as JSON text; taxed lines have one discount, large ones another."""

    def allocation(amount: Column, title: Column) -> Column:
        applied = F.struct(F.lit("ManualDiscountApplication").alias("__typename"), title.alias("title"))
        return F.struct(_money(amount, F.lit("USD")).alias("allocatedAmountSet"), applied.alias("discountApplication"))

    given = F.array_compact(
        F.array(
            F.when(item["tax"] > 0, allocation(item["tax"], F.concat(F.lit("Deal "), item["flag"]))),
            F.when(item["qty"] > 25, allocation(item["disc"].cast(MONEY), F.lit("Bulk"))),
        )
    )
    line = F.struct(
        _line_id(item, key).alias("id"),
        F.concat(F.lit("Line "), item["n"].cast("string")).alias("name"),
        item["qty"].alias("quantity"),
        _sku(item).alias("sku"),
        _money(item["unit"], F.lit("USD")).alias("originalUnitPriceSet"),
        _money(item["disc"]).alias("totalDiscountSet"),
        F.when(F.size(given) > 0, given).alias("discountAllocations"),
    )
    return F.to_json(line)


def _refund(item: Column, key: Column, date: Column) -> Column:
    """A returned line as a refund of its own."""
    line = F.struct(
        _line_id(item, key).alias("id"),
        F.concat(F.lit("Line "), item["n"].cast("string")).alias("name"),
        F.struct(_sku(item).alias("sku")).alias("variant"),
        _money(item["unit"]).alias("originalUnitPriceSet"),
    )
    returned = F.struct(F.struct(item["qty"].alias("quantity"), line.alias("lineItem")).alias("node"))
    return F.struct(
        F.concat(F.lit("gid://shop/Refund/"), item["n"].cast("string"), F.lit("-"), key).alias("id"),
        F.concat(date, F.lit("T20:00:00Z")).alias("createdAt"),
        _money(item["unit"], F.lit("USD")).alias("totalRefundedSet"),
        F.struct(F.array(returned).alias("edges")).alias("refundLineItems"),
    )


def created_text(status: Column, day: Column) -> Column:
    date = F.date_format(day, "yyyy-MM-dd")
    return (
        F.when(status == "F", F.concat(date, F.lit("T23:30:00Z")))
        .when(status == "O", F.concat(date, F.lit("T01:15:30+08:00")))
        .otherwise(F.concat(date, F.lit("T02:30:00.250-05:00")))
    )


# Orders whose pages are built at once, and shares at most: each share reads the tables again.
SHARE_ORDERS, MOST_SHARES = 500_000, 8


@cache
def order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The order pages as text files, written once a session, as recorded pages lie: queries start from them.

    The files are compressed, and large tables come in shares: what the shuffles of one share leave on disk goes before the next.
    """
    path = f"{shared_dir(spark, 'order-pages')}/orders"
    shares = min(MOST_SHARES, 1 + table(spark, folder, "orders").count() // SHARE_ORDERS)
    for share in range(shares):
        with shuffles_removed(spark):
            built_order_pages(spark, folder, share, shares).write.mode("append").option("compression", "gzip").text(path)
    return read_pages(spark, path)


def built_order_pages(spark: SparkSession, folder: str, share: int = 0, shares: int = 1) -> DataFrame:
    """One page document per order; pages of pending orders have two edges that hold no order."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    customer = F.struct(
        F.when(priority == "4-NOT SPECIFIED", "0").otherwise(F.col("c_custkey").cast("string")).alias("legacyResourceId"),
        F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_name")).alias("displayName"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("firstName"),
        F.col("n_name").alias("lastName"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
    )
    shipping = F.struct(
        F.lower("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.concat(F.lit(" "), "c_name", F.lit("\t")).alias("name"),
    )
    items = F.coalesce("items", F.array().cast("array<struct<n:int,flag:string,qty:bigint,unit:decimal(18,4),disc:decimal(12,2),tax:decimal(18,4)>>"))
    returned = F.filter(items, lambda i: i["flag"] == "R")

    def total(rows: Column, field: str, kind: str) -> Column:
        zero = F.lit(0).cast(kind)
        return F.aggregate(rows, zero, lambda done, i: (done + i[field]).cast(kind))

    quantity = total(items, "qty", "bigint")
    discounts = total(items, "disc", "decimal(12,2)")
    refunded = F.when(F.size(returned) > 0, total(returned, "unit", "decimal(18,4)"))
    cancelled = (status == "F") & (priority == "1-URGENT")
    tracking = F.struct(key.alias("number"), F.lit("Carrier").alias("company"))
    payment = F.struct(
        F.concat(F.lit("gid://shop/Transaction/"), key).alias("id"),
        F.lit("SALE").alias("kind"),
        status.alias("status"),
        F.concat(date, F.lit("T21:00:00Z")).alias("createdAt"),
    )
    field = F.struct(
        F.struct(F.lit("crm").alias("namespace"), F.lit("segment").alias("key"), F.col("c_mktsegment").alias("value")).alias("node")
    )
    node = F.struct(
        F.concat(F.lit("gid://shop/Order/"), key).alias("id"),
        F.when(status != "P", key).alias("legacyResourceId"),
        F.concat(F.lit("#"), key).alias("name"),
        created_text(status, F.col("o_orderdate")).alias("createdAt"),
        F.concat(date, F.lit("T12:00:00Z")).alias("updatedAt"),
        F.when(cancelled, F.concat(date, F.lit("T05:00:00.123Z"))).alias("cancelledAt"),
        F.when(cancelled, "CUSTOMER").alias("cancelReason"),
        status.alias("displayFinancialStatus"),
        priority.alias("displayFulfillmentStatus"),
        (F.col("c_acctbal") > 0).alias("customerAcceptsMarketing"),
        quantity.alias("currentSubtotalLineItemsQuantity"),
        currency(F.col("r_name")).alias("currencyCode"),
        _money(F.col("o_totalprice").cast(MONEY)).alias("totalPriceSet"),
        _money(F.col("o_totalprice").cast(MONEY)).alias("subtotalPriceSet"),
        _money(F.when(status != "F", F.lit("12.50"))).alias("totalShippingPriceSet"),
        _money(discounts).alias("totalDiscountsSet"),
        _money(F.when(F.size(items) > 0, total(items, "tax", "decimal(18,4)"))).alias("totalTaxSet"),
        _money(refunded).alias("totalRefundedSet"),
        F.when(priority != "5-LOW", customer).alias("customer"),
        shipping.alias("shippingAddress"),
        F.when(F.col("c_acctbal") >= 0, F.struct(F.col("n_name").alias("country"))).alias("billingAddress"),
        F.when(F.size(returned) > 0, F.transform(returned, lambda i: _refund(i, key, date))).alias("refunds"),
        F.when(status == "F", F.array(F.struct(F.lit("SUCCESS").alias("status"), F.array(tracking).alias("trackingInfo")))).alias(
            "fulfillments"
        ),
        F.array(payment).alias("transactions"),
        F.struct(F.array(field).alias("edges")).alias("metafields"),
    )
    lines = F.concat_ws(",", F.transform(items, lambda i: _line(i, key)), F.when(status == "O", F.lit("7")))
    # The lines are spliced into the node as text, so that a list item that is no object can be among them.
    node_text = F.concat(F.lit('{"lineItems":{"nodes":['), lines, F.lit("]},"), F.substring(F.to_json(node), 2, 2**31 - 1))
    document = F.concat(
        F.lit('{"data":{"orders":{"edges":[{"cursor":"c1","node":'), node_text,
        F.lit("}"),
        F.when(status == "P", ',5,{"cursor":"c2","node":null}').otherwise(""),
        F.lit('],"pageInfo":{"hasNextPage":false}}}}'),
    )
    return order_parts(spark, folder, share, shares).select(document.alias("document"))


def event_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page document per event: an update of the order named after the user, in day folders.

    The same kind of moment comes with three offsets, and some updates have no creation time.
    """
    offset = F.col("event_id") % 3
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

    def at(hours: int, zone: str) -> Column:
        return F.concat(F.date_format(F.col("ts") + F.expr(f"INTERVAL {hours} HOURS"), form), F.lit(zone))

    clock = F.when(offset == 0, at(0, "Z")).when(offset == 1, at(8, "+08:00")).otherwise(at(-5, "-05:00"))
    node = F.struct(
        F.concat(F.lit("gid://shop/Order/"), F.col("user_id").cast("string")).alias("id"),
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("name"),
        F.when(F.col("event_id") % 7 != 0, clock).alias("createdAt"),
        clock.alias("updatedAt"),
        F.col("event_type").alias("displayFinancialStatus"),
        F.struct(F.struct(F.col("value").cast(MONEY).cast("string").alias("amount")).alias("shopMoney")).alias("totalPriceSet"),
    )
    document = F.concat(F.lit('{"orders":{"edges":[{"node":'), F.to_json(node), F.lit("}]}}"))
    return table(spark, folder, "events").select(document.alias("document"), F.col("ts").cast("date").alias("day"))


def product_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page document per part, a product with two variants and one image."""
    key = F.col("p_partkey").cast("string")
    price = F.col("p_retailprice").cast(MONEY)

    def amount(value: Column) -> Column:
        return F.struct(value.cast("string").alias("amount"), F.lit("EUR").alias("currencyCode"))

    def variant(name: str, value: Column, before: Column) -> Column:
        node = F.struct(
            F.concat(F.lit(f"gid://shop/Variant/{name}-"), key).alias("id"),
            F.lit(name).alias("title"),
            F.concat("p_brand", F.lit(f"-{name}")).alias("sku"),
            (F.col("p_size") > 25).alias("availableForSale"),
            amount(value).alias("price"),
            before.alias("compareAtPrice"),
        )
        return F.struct(node.alias("node"))

    node = F.struct(
        F.concat(F.lit("gid://shop/Product/"), key).alias("id"),
        F.col("p_name").alias("title"),
        F.translate("p_name", " ", "-").alias("handle"),
        F.col("p_brand").alias("vendor"),
        F.col("p_type").alias("productType"),
        F.array("p_type", "p_brand").alias("tags"),
        F.struct(amount(price).alias("minVariantPrice"), amount(price + 5).alias("maxVariantPrice")).alias("priceRange"),
        F.struct(
            F.array(variant("base", price, F.lit(None).cast("struct<amount:string,currencyCode:string>")),
                    variant("gift", price + 5, amount(price + 10))).alias("edges")
        ).alias("variants"),
        F.when(
            F.col("p_size") > 10,
            F.struct(F.array(F.struct(F.struct(F.concat(F.lit("img/"), key).alias("url"), F.col("p_size").alias("width")).alias("node"))).alias("edges")),
        ).alias("images"),
    )
    document = F.concat(
        F.lit('{"data":{"products":{"edges":[{"cursor":"p","node":'), F.to_json(node), F.lit('},"x"]}}}')
    )
    return table(spark, folder, "part").select(document.alias("document"))


def tag_list(balance: Column) -> Column:
    return (
        F.when(balance > 9000, F.array(F.lit("VIP"), F.lit("reseller")))
        .when(balance > 7000, F.array(F.lit("Gold Circle")))
        .when(balance > 5000, F.array(F.lit("new"), F.lit("Silver")))
        .when(balance > 3000, F.array(F.lit(" "), F.lit("bronze club")))
        .when(balance > 1000, F.array(F.lit(" "), F.lit(" Key Account "), F.lit("b")))
        .when(balance > 0, F.array().cast("array<string>"))
    )


def customer_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page document per customer."""
    node = F.struct(
        F.col("c_custkey").cast("string").alias("legacyResourceId"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("firstName"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("lastName"),
        tag_list(F.col("c_acctbal")).alias("tags"),
        F.struct(F.when(F.col("n_name") != "NATION_0", F.col("n_name")).alias("city")).alias("defaultAddress"),
    )
    document = F.concat(F.lit('{"data":{"customers":{"edges":[{"node":'), F.to_json(node), F.lit("}]}}}"))
    return places(spark, folder).select(document.alias("document"))


def compact_order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One compact page document per order."""
    money = F.struct(F.col("o_totalprice").cast(MONEY).cast("string").alias("amount"), F.lit("EUR").alias("currencyCode"))
    node = F.struct(
        F.col("o_orderkey").cast("string").alias("legacyResourceId"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:59:59+14:00")).alias("createdAt"),
        F.struct(F.when(F.col("o_orderstatus") != "F", money).alias("shopMoney")).alias("currentTotalPriceSet"),
        F.struct(F.col("o_custkey").alias("legacyResourceId")).alias("customer"),
    )
    document = F.concat(F.lit('{"data":{"orders":{"edges":[{"node":'), F.to_json(node), F.lit("}]}}}"))
    return table(spark, folder, "orders").select(document.alias("document"))


# ---- inbox documents -------------------------------------------------------


def inbox_customer_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One inbox document per customer; the market segment decides its shape."""
    segment = F.col("c_mktsegment")
    key = F.col("c_custkey").cast("string")

    def text(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    name, city = text(F.col("c_name")), text(F.concat(F.lit(" "), "n_name", F.lit(" ")))
    plain = F.concat(F.lit('[{"customer_id":'), key, F.lit(',"customer_name":'), name, F.lit(',"city":'), city,
                     F.lit(',"customer_level":" GOLD "},5,"x",[1]]'))
    named = F.concat(F.lit('{"n":[1],"customers":[{"id":"'), key, F.lit('","name":'), name, F.lit("}]}"))
    data = F.concat(F.lit('{"data":[{"customer_id":'), key, F.lit(',"customer_name":null,"name":"unused","city":"  "}],"n":[2]}'))
    only = F.concat(F.lit('{"n":1,"rows":[{"id":'), key, F.lit(',"name":"  ","defaultCity":'), city, F.lit(',"level":"Silver"}]}'))
    bare = F.concat(F.lit('[{"customer_id":'), key, F.lit("}]"))
    document = (
        F.when(segment == "AUTOMOBILE", plain).when(segment == "BUILDING", named).when(segment == "FURNITURE", data)
        .when(segment == "HOUSEHOLD", only).otherwise(bare)
    )
    return places(spark, folder).select(document.alias("document"))


def inbox_order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One inbox document per order; the priority decides its shape."""
    priority = F.col("o_orderpriority")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    amount = F.col("o_totalprice").cast(MONEY).cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    head = F.concat(F.lit('{"order_id":'), key, F.lit(',"customer_id":'), customer, F.lit(',"order_amount":'), amount)
    alias = F.concat(F.lit('{"id":"'), key, F.lit('","customerId":'), customer, F.lit(',"total":"'), amount, F.lit('"'))
    document = (
        F.when(priority == "1-URGENT", F.concat(F.lit("["), head, F.lit(',"order_date":"'), day, F.lit('"}]')))
        .when(priority == "2-HIGH", F.concat(F.lit('{"orders":['), alias, F.lit(',"createdAt":"'), day, F.lit('T23:30:00Z"},7]}')))
        .when(priority == "3-MEDIUM", F.concat(F.lit('{"data":['), alias, F.lit(',"date":"'), day, F.lit('T00:10:00+09:00"}]}')))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit('{"batch":['), head, F.lit(',"order_date":"'), day, F.lit(' 10:00:00"}]}')))
        .otherwise(F.concat(F.lit("["), head, F.lit("}]")))
    )
    return table(spark, folder, "orders").select(document.alias("document"))
