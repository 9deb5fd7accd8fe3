"""Nested order documents, products and inbox documents, case by case."""

from __future__ import annotations

import json
import time
from datetime import date
from decimal import Decimal
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import children, products
from salesloom.operators.wide import wide_orders
from salesloom.sources import inbox, pages
from salesloom.sources.csv_files import read_csv_text


def documents(spark, *payloads):
    texts = [(p if isinstance(p, str) else json.dumps(p),) for p in payloads]
    return spark.createDataFrame(texts, "document string")


def orders_page(*nodes, wrap=True):
    body = {"orders": {"edges": [{"cursor": "c", "node": n} for n in nodes], "pageInfo": {"hasNextPage": False}}}
    return {"data": body} if wrap else body


def wide_row(spark, node, **options):
    return wide_orders(pages.order_nodes(documents(spark, orders_page(node))), "demo", **options).first()


def money(amount, code="USD"):
    return {"shopMoney": {"amount": amount, "currencyCode": code}}


def line(sku, quantity, unit, discount, allocations=()):
    return {"id": "l", "name": f"n {sku}", "quantity": quantity, "sku": sku, "originalUnitPriceSet": money(unit),
            "totalDiscountSet": money(discount), "discountAllocations": list(allocations)}


def test_full_order(spark):
    deal = {"allocatedAmountSet": money("1.25"), "discountApplication": {"__typename": "ManualDiscountApplication", "title": "ü"}}
    node = {
        "id": "gid://shopify/Order/55", "legacyResourceId": "77", "name": "#1", "createdAt": "2026-03-08T02:30:00+08:00",
        "updatedAt": "2026-03-09T00:00:00Z", "cancelledAt": "2026-03-10T01:02:03.999Z", "cancelReason": "OTHER",
        "displayFinancialStatus": "PAID", "displayFulfillmentStatus": "FULFILLED", "customerAcceptsMarketing": True,
        "currentSubtotalLineItemsQuantity": 4, "currencyCode": "USD", "discountCode": "HI",
        "subtotalPriceSet": money("90.10"), "totalShippingPriceSet": money("5"), "totalDiscountsSet": money("2.5"),
        "totalTaxSet": money("0.333"), "totalPriceSet": money("95.10"), "totalRefundedSet": money("3.00"),
        "customer": {"legacyResourceId": 12, "displayName": " ", "firstName": " Ann ", "lastName": "Lee", "email": "a@b", "phone": None},
        "shippingAddress": {"address1": "x 1", "city": "Köln", "country": "DE", "name": " Ann\t"},
        "billingAddress": {"country": "AT", "zip": None},
        "lineItems": {"nodes": [line("A", 3, "10.10", "0.5", [deal, 4]), line("DG-002", 9, "100", "1"), 7, line(None, 2, "1", "0")]},
        "refunds": None,
    }
    row = wide_row(spark, node)
    assert tuple(row.asDict()) == schemas.WIDE_ORDER_COLUMNS and len(schemas.WIDE_ORDER_COLUMNS) == 44
    assert (row.shopify_gid, row.shop_name, row.order_id, row.legacy_order_id, row.customer_legacy_id) == (
        "gid://shopify/Order/55", "demo", "#1", 77, 12)
    assert (row.created_at, row.beijing_created_at, row.use_created_at, row.berlin_created_at) == (
        "2026-03-08 02:30:00", "2026-03-08 02:30:00", "2026-03-07 13:30:00", "2026-03-07 19:30:00")
    assert (row.updated_at, row.cancelled_at, row.cancel_reason) == ("2026-03-09 00:00:00", "2026-03-10 01:02:03", "OTHER")
    assert (row.total_product_amount, row.total_product_discount, row.tax) == (Decimal("32.3"), Decimal("1.5"), Decimal("0.333"))
    assert (row.product_quantity, row.marketing_intention, row.totalrefunded, row.product_sales) == (4, 1, 3, Decimal("90.1"))
    assert (row.customer_display_name, row.customer_email, row.customer_phone, row.bill_country) == ("Ann Lee", "a@b", "", "AT")
    assert (row.shipping_city, row.shipping_name, row.shipping_zip, row.discount_code, row.discount_method) == ("Köln", "Ann", "", "HI", "")
    assert [entry["sku"] for entry in json.loads(row.product_details)] == ["A", "DG-002", None]
    assert json.loads(row.discount_information) == [
        {"name": "n A", "sku": "A", "quantity": 3, "discounts": [
            {"type": "ManualDiscountApplication", "title": "ü", "code": None, "amount": 1.25, "currency": "USD"}]},
        {"name": "n DG-002", "sku": "DG-002", "quantity": 9, "discounts": []},
        {"name": "n None", "sku": None, "quantity": 2, "discounts": []},
    ]
    assert json.loads(row.billing_address) == {"country": "AT", "zip": None} and row.refunds == "null"
    assert row.etl_synced_at is not None
    assert wide_row(spark, node, excluded_skus=("A",)).total_product_amount == 902


def test_empty_order(spark):
    row = wide_row(spark, {"id": "gid://shopify/Order/9"})
    assert (row.legacy_order_id, row.customer_legacy_id) == (9, 5_000_000_000_009)
    assert (row.created_at, row.beijing_created_at, row.updated_at, row.cancelled_at) == (None,) * 4
    assert (row.total_price, row.total_product_amount, row.product_quantity, row.marketing_intention) == (0, 0, 0, 0)
    assert (row.customer_display_name, row.currency_code, row.bill_country, row.shipping_name) == ("", "", "", "")
    assert (row.product_details, row.discount_information, row.billing_address, row.refunds) == ("[]", "[]", "{}", "null")


@pytest.mark.parametrize(
    ("node", "order", "customer"),
    [
        ({"id": "gid://x/Order/5", "legacyResourceId": "oops", "customer": {"legacyResourceId": "0"}}, 5, 5_000_000_000_005),
        ({"id": "gid://x/Order/5", "legacyResourceId": 6, "customer": {"legacyResourceId": "bad"}}, 6, 5_000_000_000_006),
        ({"id": "nothing", "customer": {"legacyResourceId": "3"}}, None, 3),
        ({"id": "nothing", "customer": None}, None, None),
        ({"id": "nothing", "customer": {"legacyResourceId": 0}}, None, 0),
    ],
)
def test_ids(spark, node, order, customer):
    row = wide_row(spark, node)
    assert (row.legacy_order_id, row.customer_legacy_id) == (order, customer)


def test_bad_amount_raises(spark):
    with pytest.raises(PySparkException):
        wide_row(spark, {"id": "x", "totalPriceSet": money("1,50")})


def test_pages_of_every_shape(spark):
    many = orders_page(*[{"id": f"gid://x/Order/{i}"} for i in range(200)])
    junk = {"orders": {"edges": [5, None, "x", {"cursor": "c", "node": 3}, {"cursor": "c"}, {"node": {"id": "gid://x/Order/900"}}]}}
    rows = pages.order_nodes(documents(spark, many, junk, orders_page({"id": "gid://x/Order/901"}, wrap=False), {"data": None}, "not json", orders_page()), on_fault="skip")
    numbers = sorted(r.n for r in rows.select(pages.order_number(F.col("node")).alias("n")).collect())
    assert numbers == [*range(200), 900, 901]


@pytest.mark.parametrize("bad", ["not json", '{"data":{"orders":{"edges":[{"node":{"id":"x"', '{"errors":[{"message":"m"}],"data":null}', '{"data":{"orders":null}}'])
def test_damaged_pages_stop_the_job_or_are_rejected(spark, bad):
    recorded = documents(spark, orders_page({"id": "gid://x/Order/1"}), bad, orders_page())
    with pytest.raises(PySparkException):
        pages.order_nodes(recorded).collect()
    assert pages.order_nodes(recorded, on_fault="skip").count() == 1
    rejected = pages.rejected_pages(recorded, "orders").collect()
    assert [r.document for r in rejected] == [bad] and rejected[0].reject_reason


def test_page_chains(spark):
    def part(more, after=None, end=None, wrap=False, cursors=()):
        orders = {"edges": [{"cursor": c} for c in cursors], "pageInfo": {"hasNextPage": more, "endCursor": end}}
        return json.dumps({"after": after, **({"data": {"orders": orders}} if wrap else {"orders": orders})})

    days = {
        1: [part(True), part(False)],  # nothing recorded about the order of pages
        2: [part(True), part(True)],
        3: [part(True, None, "a"), part(True, "a", None, True, ("x", "b")), part(False, "b", "c"), part(False, "b", "c")],
        4: [part(True, None, "a"), part(False, "b", "c")],  # the page between is missing
        5: [part(True, None, "a"), part(True, "a", "b")],  # the last page is missing
        6: ["not json", part(False)],
        7: [part(False)],
    }
    rows = spark.createDataFrame([(d, day) for day, docs in days.items() for d in docs], "document string, day int")
    found = {r.day: (r.page_count, r.gaps, r.open_ends, r.complete) for r in pages.page_chains(rows, "orders").collect()}
    assert found == {1: (2, 0, 0, True), 2: (1, 0, 1, False), 3: (3, 0, 0, True), 4: (2, 1, 1, False), 5: (2, 0, 1, False), 6: (1, 0, 0, True), 7: (1, 0, 0, True)}


def test_page_folders(spark, folder):
    import os

    for day, ids in (("2026-04-01", [1, 2]), ("2026-04-02", [3])):
        os.makedirs(f"{folder}/day={day}")
        with open(f"{folder}/day={day}/p.json", "w") as handle:
            json.dump(orders_page(*[{"id": f"gid://x/Order/{i}"} for i in ids]), handle, indent=1)
    read = pages.read_pages(spark, folder, page_per_line=False)
    wanted = wide_orders(pages.order_nodes(read.filter("day = '2026-04-02'")), "demo", keep=("day",)).first()
    assert (wanted.day, wanted.legacy_order_id) == (date(2026, 4, 2), 3)
    assert pages.page_probe(read, "orders").first().asDict() == {"page_count": 2, "node_count": 3}


def test_children(spark):
    refund = {"id": "r1", "createdAt": "2026-01-01T00:00:00Z", "note": "n", "totalRefundedSet": money("5"), "refundLineItems": {"edges": [
        {"node": {"quantity": 2, "lineItem": {"id": "l1", "name": "x", "variant": {"sku": "S"}, "originalUnitPriceSet": money("2.5")}}}, 4]}}
    node = {
        "id": "gid://x/Order/1", "lineItems": {"nodes": [line("A", 1, "2", "0", [{"allocatedAmountSet": money("1"), "discountApplication": {}}])]},
        "refunds": [refund, {"id": "r2", "refundLineItems": {"edges": []}}],
        "fulfillments": [{"status": "OK", "trackingInfo": [{"number": "1"}, {"number": "2"}]}, {"status": "OPEN", "trackingInfo": []}],
        "transactions": [{"id": "t", "kind": "SALE"}], "metafields": {"edges": [{"node": {"namespace": "a", "key": "b", "value": "c"}}]},
    }
    nodes = pages.order_nodes(documents(spark, orders_page(node, {"id": "gid://x/Order/2"})))
    assert [(r.legacy_order_id, r.sku, r.quantity, r.unit_price) for r in children.order_lines(nodes).orderBy("legacy_order_id").collect()] == [
        (1, "A", 1, 2), (2, None, None, 0)]
    assert sorted((r.refund_id, r.line_id, r.quantity) for r in children.refund_lines(nodes).collect()) == [("r1", "l1", 2), ("r2", None, None)]
    assert sorted((r.status, r.tracking_number) for r in children.fulfillments(nodes).collect()) == [("OK", "1"), ("OK", "2"), ("OPEN", None)]
    assert [r.kind for r in children.transactions(nodes).collect()] == ["SALE"]
    assert [(r.key, r.value) for r in children.metafields(nodes).collect()] == [("b", "c")]
    assert [(r.legacy_order_id, r.amount) for r in children.order_discounts(nodes).collect()] == [(1, 1.0)]


def test_products(spark):
    product = {
        "id": "p1", "title": "T", "tags": ["a", "b"], "priceRange": {"minVariantPrice": {"amount": "1.5", "currencyCode": "EUR"}},
        "variants": {"edges": [{"node": {"id": "v1", "sku": "S", "availableForSale": True, "price": {"amount": "2", "currencyCode": "EUR"}}}]},
        "images": {"edges": [{"node": {"url": "u", "width": 3}}, {"node": {"url": "w"}}]},
    }
    page = {"data": {"products": {"edges": [{"node": product}, {"node": {"id": "p2", "title": "A"}}, {"node": 4}]}}}
    nodes = pages.product_nodes(documents(spark, page))
    listed = products.products(nodes).orderBy("title").collect()
    assert [(r.product_id, r.min_price, r.tags) for r in listed] == [("p2", None, None), ("p1", Decimal("1.5"), "a,b")]
    assert sorted((r.product_id, r.variant_id or "") for r in products.product_variants(nodes).collect()) == [("p1", "v1"), ("p2", "")]
    assert sorted((r.product_id, r.url or "") for r in products.product_images(nodes).collect()) == [("p1", "u"), ("p1", "w"), ("p2", "")]


# ---- inbox -----------------------------------------------------------------


def people(spark, payload, base="customers"):
    rows = inbox.inbox_customers(inbox.json_records(documents(spark, payload), base)).collect()
    return [tuple(r) for r in rows]


def test_inbox_envelopes(spark):
    row = {"id": 1, "name": "A", "defaultCity": "X", "level": " GOLD "}
    wanted = [(1, "A", "X", "gold")]
    assert people(spark, [row, 5, "x", None, [row]]) == wanted
    assert people(spark, {"customers": [row], "data": [], "n": 1}) == wanted
    assert people(spark, {"data": [row], "other": []}) == wanted
    assert people(spark, {"other": [row], "n": {"a": [1]}}) == wanted
    assert people(spark, "﻿\n " + json.dumps([row], indent=2)) == wanted
    assert people(spark, []) == []
    for bad in ({"a": [row], "b": [row]}, {"a": 1}, "5", "[{", "nonsense"):
        with pytest.raises(PySparkException):
            people(spark, bad)


def test_inbox_defaults(spark):
    assert people(spark, [{"customer_id": 7}]) == [(7, "customer_7", "unknown", "standard")]
    assert people(spark, [{"customer_id": "7", "customer_name": " ", "city": "", "customer_level": "  "}]) == [(7, "customer_7", "unknown", "standard")]
    # a key that is there counts, even with NULL
    assert people(spark, [{"customer_id": 7, "customer_name": None, "name": "unused"}]) == [(7, "customer_7", "unknown", "standard")]
    for bad in ({"customer_id": None, "id": 5}, {"name": "x"}, {"id": "five"}):
        with pytest.raises(PySparkException):
            people(spark, [bad])


def test_inbox_orders(spark):
    rows = [
        {"order_id": 1, "customer_id": 2, "order_amount": 1.5, "order_date": "2026-04-01"},
        {"id": 2, "customerId": 2, "amount": "2.25", "date": "2026-04-01T23:59:00-11:00"},
        {"id": 3, "customerId": 2, "total": 3, "createdAt": "2026-04-02T00:00:00Z"},
        {"id": 4, "customerId": 2, "total": 4, "order_date": None, "date": "2026-01-01"},
    ]
    today = F.lit("2026-05-05").cast("date")
    frame = inbox.inbox_orders(inbox.json_records(documents(spark, {"orders": rows}), "orders"), today)
    assert [(r.order_id, float(r.order_amount), r.order_date) for r in frame.orderBy("order_id").collect()] == [
        (1, 1.5, date(2026, 4, 1)), (2, 2.25, date(2026, 4, 1)), (3, 3.0, date(2026, 4, 2)), (4, 4.0, date(2026, 5, 5))]
    for bad in ({"id": 1, "customerId": 2}, {"id": 1, "amount": 3}, {"id": 1, "customerId": 2, "amount": None, "total": 5}):
        with pytest.raises(PySparkException):
            inbox.inbox_orders(inbox.json_records(documents(spark, [bad]), "orders"), today).collect()


def test_inbox_csv(spark, folder):
    with open(f"{folder}/customers.csv", "w", encoding="utf-8") as handle:
        handle.write('id,name,defaultCity\n5,"Lee, ""Ann""",\n6,,Rom\n')
    rows = inbox.inbox_customers(inbox.inbox_records(spark, folder, "customers")).orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == [(5, 'Lee, "Ann"', "unknown", "standard"), (6, "customer_6", "Rom", "standard")]
    with pytest.raises(ValueError, match="lacks columns: city"):
        read_csv_text(spark, f"{folder}/customers.csv", ("id", "city"))


def test_customer_and_compact_order_pages(spark):
    page = {"data": {"customers": {"edges": [{"node": {"legacyResourceId": "4", "firstName": "A", "lastName": None, "tags": ["VIP"], "defaultAddress": None}}]}}}
    assert tuple(pages.customers_from_pages(documents(spark, page)).first()) == (4, "A", "unknown", "vip")
    node = {"legacyResourceId": "8", "createdAt": "2026-04-01T23:00:00-10:00", "currentTotalPriceSet": money("7.5", "EUR"), "customer": {"legacyResourceId": "4"}}
    row = pages.orders_from_pages(documents(spark, orders_page(node))).first()
    assert (row.order_id, row.customer_id, float(row.order_amount), row.order_date, row.currency_code) == (8, 4, 7.5, date(2026, 4, 1), "EUR")


def test_nodes_are_parsed_with_the_fields_that_are_read(spark):
    from salesloom import schemas
    from salesloom.operators import narrow
    from salesloom.operators.wide import NODE_READS, node_fields, wide_columns

    assert schemas.pruned("STRUCT<a: STRUCT<b: INT, c: ARRAY<STRING>>, d: INT>", ["a.c", "d"]) == "STRUCT<a: STRUCT<c: ARRAY<STRING>>, d: INT>"
    assert schemas.pruned("STRUCT<a: STRUCT<b: INT, c: INT>, d: INT>", ["a.b", "a"]) == "STRUCT<a: STRUCT<b: INT, c: INT>>"
    for wrong in ("x", "d.e"):
        with pytest.raises(ValueError):
            schemas.pruned("STRUCT<a: INT, d: INT>", [wrong])
    assert list(NODE_READS) == list(schemas.WIDE_ORDER_TYPES)
    node = {"id": "gid://x/Order/7", "createdAt": "2026-04-01T10:00:00Z", "totalPriceSet": {"shopMoney": {"amount": "3.50"}}, "refunds": [{"id": 1}],
            "customer": {"legacyResourceId": "4", "displayName": "A"}, "shippingAddress": {"country": "DE", "city": "B"}, "currencyCode": "EUR"}
    recorded = documents(spark, orders_page(node))
    whole = wide_orders(pages.order_nodes(recorded), "demo")
    for columns in (narrow.ORDER_READS, narrow.CUSTOMER_READS, *[[c] for c in NODE_READS if c != "etl_synced_at"]):
        some = wide_columns(recorded, "demo", columns)
        assert some.collect() == whole.select(*columns).collect(), columns
    assert set(node_fields(narrow.ORDER_READS)) == {
        "legacyResourceId", "id", "customer.legacyResourceId", "createdAt", "totalPriceSet", "currencyCode", "shippingAddress.country", "totalRefundedSet"}
    plan = wide_columns(recorded, "demo", narrow.ORDER_READS)._jdf.queryExecution().optimizedPlan().toString()
    assert "totalRefundedSet" in plan and "transactions" not in plan and "lineItems" not in plan


PAGE_QUERIES = ("latest_customer_attributes", "narrow_customers", "narrow_orders", "order_fulfillments", "order_lines", "order_metafields", "order_transactions",
                "refund_lines", "wide_clocks", "wide_discounts", "wide_ids", "wide_line_totals", "wide_orders")


def star_tables(spark, folder, orders=60):
    """Customers, orders (one without a key, two that share theirs) and lines (an order without, one with many)."""
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.createDataFrame([(0, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    people = [(i, f"Customer#{i}", 0, i - 2.0, "BUILDING" if i % 2 else "MACHINERY") for i in range(5)]
    spark.createDataFrame(people, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    keys = [None, 7, 7, *range(100, 100 + orders)]
    placed = [(k, i % 5, "FOP"[i % 3], 10.5 * i, f"1996-01-{1 + i % 28:02d}", "1-URGENT") for i, k in enumerate(keys)]
    spark.createDataFrame(placed, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day string, o_orderpriority string").selectExpr(
        "* EXCEPT (day)", "CAST(day AS timestamp_ntz) AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    lines = [(k, n, 5.0 * n, 3.25 * i, 0.05, 0.01 * (n % 2), "ANR"[(i + n) % 3]) for i, k in enumerate(keys) if k != 100 for n in range(1, 40 if k == 101 else 4)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                          " l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = {blocks.apply(i).name() for i in range(blocks.size())}
    return {name for name in names if name.startswith("shuffle_")}


def test_order_pages_lie_compressed_and_come_in_shares(spark, folder, monkeypatch):
    from querybook import adapters

    star_tables(spark, folder)
    whole = sorted(r.document for r in adapters.built_order_pages(spark, folder).collect())
    assert len(whole) == 63
    monkeypatch.setattr(adapters, "SHARE_ORDERS", 20)
    before = shuffle_files(spark)
    read = adapters.order_pages(spark, folder)
    for _ in range(100):  # they go in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert sorted(r.document for r in read.collect()) == whole
    size = sum(Path(unquote(urlparse(f).path)).stat().st_size for f in read.inputFiles())
    assert size < sum(map(len, whole)) / 2


@pytest.fixture(scope="module")
def star_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    star_tables(spark, folder, 12)
    return folder


@pytest.mark.parametrize("name", PAGE_QUERIES)
def test_queries_over_order_pages_read_compressed_files(spark, star_folder, name):
    from __spark_entry__ import queries
    from querybook import adapters

    frame = queries()[name](spark, star_folder)
    assert frame.count() > 0
    files = adapters.order_pages(spark, star_folder).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    assert set(frame.inputFiles()) == set(files)
