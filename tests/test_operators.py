"""Operators against brute force in plain Python, and the shape of their plans."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesloom.functions.money import as_doubles
from salesloom.operators import evolve, incremental, layers, marts, narrow, quality, reports
from salesloom.plans.warehouse import build_warehouse
from salesloom.sources.tables import CATALOG_BY_TABLE, CatalogEntry, Kpi
from tests.conftest import values

RAW_ORDERS = (
    "order_id bigint, customer_id bigint, order_amount decimal(18,4), order_date date, currency_code string,"
    " ship_country string, refund_amount decimal(18,4)"
)
RAW_CUSTOMERS = "customer_id bigint, customer_name string, city string, customer_level string"


def hot_orders(n: int = 1500, seed: int = 7) -> list[tuple]:
    """Random orders; one customer holds a third of them, one row a tenth, some customers are unknown."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        customer = 1 if rng.random() < 0.34 else rng.choice([2, 3, 4, 5, 6, 77, None])
        amount = Decimal(rng.randint(-500, 99999)) / 100
        refund = rng.choice([None, Decimal(0), Decimal(rng.randint(0, 120000)) / 100])
        rows.append((rng.randint(1, n), customer, amount, date(2026, rng.randint(1, 3), rng.randint(1, 28)),
                     rng.choice(["eur", " EUR ", "", None, "usd"]), rng.choice(["de", " ", None]), refund))
    return rows + [rows[0]] * (n // 10)


CUSTOMERS = [
    (1, " Ann ", "berlin", "Gold"), (1, "Ann", "BERLIN ", "gold"), (1, None, "aachen", "gold"), (2, "Bob", "paris", "vip"),
    (3, "Cy", "berlin", "gold"), (4, "Di", None, "gold"), (5, "Ed", "paris", "standard"), (6, "Flo", "rome", "vip"), (None, "Who", "x", "y"),
]


def brute_stage(rows):
    staged = set()
    for oid, customer, amount, day, currency, country, refund in rows:
        if amount is not None and amount > 0:
            refund = refund or Decimal(0)
            staged.add((oid, customer, amount, day, day.strftime("%Y-%m"), (currency or "").strip().upper() or "UNKNOWN",
                        (country or "").strip().upper() or "UNKNOWN", refund, max(amount - refund, Decimal(0))))
    return staged


def brute_mart(staged, key, known=None):
    groups = defaultdict(list)
    for row in staged:
        if known is None or row[1] in known:
            groups[key(row)].append(row)
    cent = Decimal("0.01")
    return {
        k: (len(v), len({r[1] for r in v if r[1] is not None}), sum(r[2] for r in v).quantize(cent, ROUND_HALF_UP),
            sum(r[7] for r in v).quantize(cent, ROUND_HALF_UP), sum(r[8] for r in v).quantize(cent, ROUND_HALF_UP),
            (sum(r[8] for r in v) / len(v)).quantize(cent, ROUND_HALF_UP))
        for k, v in groups.items()
    }


@pytest.mark.parametrize("partitions", [1, 7])
def test_marts_against_brute_force(spark, partitions):
    rows = hot_orders()
    raw = spark.createDataFrame(rows, RAW_ORDERS).repartition(partitions)
    tables = build_warehouse(spark.createDataFrame(CUSTOMERS, RAW_CUSTOMERS).repartition(partitions), raw)
    staged = brute_stage(rows)
    assert {tuple(r) for r in tables["stg_orders"].collect()} == staged
    people = {r.customer_id: (r.customer_name, r.city, r.customer_level) for r in tables["dim_customers"].collect()}
    assert people[1] == ("Ann", "BERLIN", "gold") and people[4] == ("Di", None, "gold") and len(people) == 7

    def table(name, *keys):
        measures = ("order_count", "customer_count", "gross_merchandise_value", "total_refunds", "net_sales", "average_order_value")
        return {tuple(r[k] for k in keys): tuple(r[m] for m in measures) for r in tables[name].collect()}

    known = {k for k in people if k is not None}
    assert table("mart_daily_sales", "order_date", "currency_code") == brute_mart(staged, lambda r: (r[3], r[5]))
    assert table("mart_city_sales", "city", "order_month", "currency_code") == brute_mart(
        staged, lambda r: (people[r[1]][1], r[4], r[5]), known)
    assert table("mart_customer_level_sales", "customer_level", "order_month", "currency_code") == brute_mart(
        staged, lambda r: (people[r[1]][2], r[4], r[5]), known)
    summary = {(r.city, r.customer_level, r.order_month, r.currency_code): (r.order_count, r.gross_sales, r.avg_order_amount, r.summary_key)
               for r in tables["mart_sales_summary"].collect()}
    wanted = brute_mart(staged, lambda r: (people[r[1]][1], people[r[1]][2], r[4], r[5]), known)
    assert {k: (v[0], v[2], v[5]) for k, v in wanted.items()} == {k: v[:3] for k, v in summary.items()}
    assert all((v[3] is None) == (k[0] is None) and (k[0] is None or v[3] == "|".join(k)) for k, v in summary.items())


def test_months_out_of_days(spark):
    fact = layers.stg_orders(spark.createDataFrame(hot_orders(400), RAW_ORDERS))
    assert values(marts.months_of_days(marts.customer_days(fact))) == values(marts.customer_months(fact))


def test_two_versions_of_an_order_stay(spark):
    rows = [(1, 1, Decimal(5), date(2026, 1, 1), "eur", "de", None), (1, 1, Decimal(6), date(2026, 1, 1), "eur", "de", None)] * 2
    assert layers.stg_orders(spark.createDataFrame(rows, RAW_ORDERS)).count() == 2


def test_no_distinct_aggregate_and_partial_sums(spark):
    """Marts sum before the shuffle and never count distinct."""
    fact = layers.stg_orders(spark.createDataFrame(hot_orders(50), RAW_ORDERS))
    plan = marts.mart_daily_sales(fact)._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "count(distinct" not in plan and "Window" not in plan


# ---- incremental -----------------------------------------------------------


def keyed(spark, rows):
    return spark.createDataFrame(rows, "order_id bigint, v string")


def test_unseen_keeps_copies_and_rows_without_key(spark):
    existing = keyed(spark, [(1, "a"), (2, "b"), (2, "b"), (None, "x")])
    incoming = keyed(spark, [(2, "c"), (3, "d"), (3, "d"), (3, "e"), (None, "y"), (None, "y")])
    assert values(incremental.unseen(existing, incoming)) == values(keyed(spark, [(3, "d"), (3, "d"), (3, "e"), (None, "y"), (None, "y")]))
    once = incremental.append_unseen(existing, incoming)
    twice = incremental.append_unseen(once, incoming.filter("order_id is not null"))
    assert values(twice) == values(once)


def test_unseen_of_nothing(spark):
    some, none = keyed(spark, [(1, "a")]), keyed(spark, [])
    assert incremental.unseen(some, none).count() == 0
    assert incremental.unseen(none, some).count() == 1
    assert incremental.unseen(some, keyed(spark, [(None, "z")])).count() == 1


def test_unseen_prunes_the_history(spark, folder):
    keyed(spark, [(i, "a") for i in range(1000)]).write.parquet(f"{folder}/old")
    keyed(spark, [(i, "b") for i in range(990, 1010)]).write.parquet(f"{folder}/new")
    fresh = incremental.unseen(spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new"))
    assert fresh.count() == 10
    plan = fresh._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(order_id" in plan and "LessThanOrEqual(order_id" in plan


def test_latest_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(1 if rng.random() < 0.4 else rng.randint(2, 30), rng.choice([None, *range(20)]), i) for i in range(2000)]
    best = {}
    for key, version, i in rows:
        rank = (-1 if version is None else version, i)
        best[key] = max(best.get(key, (-2, -2)), rank)
    frame = spark.createDataFrame(rows, "k bigint, version bigint, i bigint")
    got = {r.k: (-1 if r.version is None else r.version, r.i) for r in incremental.latest(frame, ["k"], ["version", "i"]).collect()}
    assert got == best


def test_upsert_is_idempotent_and_prefers_new(spark):
    schema = "id bigint, updated_at string, v string"
    old = spark.createDataFrame([(1, "2026-01-02", "old"), (2, "2026-01-01", "keep"), (3, "2026-01-05", "newer")], schema)
    new = spark.createDataFrame([(1, "2026-01-02", "new"), (3, "2026-01-01", "stale"), (4, None, "first")], schema)
    once = incremental.upsert_latest(old, new, ["id"], ["updated_at"])
    assert {r.id: r.v for r in once.collect()} == {1: "new", 2: "keep", 3: "newer", 4: "first"}
    assert values(incremental.upsert_latest(once, new, ["id"], ["updated_at"])) == values(once)


def test_days(spark):
    bounds = spark.createDataFrame([(date(2026, 2, 27), date(2026, 3, 2))], "first_day date, last_day date")
    assert [r.day.day for r in incremental.calendar(bounds).collect()] == [27, 28, 1, 2]
    assert [r.day.day for r in incremental.look_back(bounds, 2).collect()] == [1, 2]
    assert incremental.look_back(bounds, -3).count() == 1
    assert [incremental.look_back_days(v) for v in (None, "x", "0", 3, " 5 ")] == [14, 14, 1, 3, 5]


# ---- quality ---------------------------------------------------------------


def test_quality_fixture(spark):
    """One order of an unknown customer, and no daily mart."""
    day = date(2026, 4, 1)
    people = spark.createDataFrame([(7, "Ines", "PORTO", "silver")], RAW_CUSTOMERS)
    orders = spark.createDataFrame([(31, 8, Decimal("12.5"), day)], "order_id bigint, customer_id bigint, order_amount decimal(18,4), order_date date")
    checks = quality.quality_checks(spark, {
        "raw_customers": people, "raw_orders": orders, "stg_orders": orders, "dim_customers": people, "fact_orders": orders,
        "mart_sales_summary": orders, "mart_daily_sales": None,
    })
    failed = {r.check_name: r.failed_rows for r in checks.filter("not passed").collect()}
    assert failed == {"fact_orders_customer_reference_valid": 1, "mart_daily_sales_not_empty": 1}
    assert tuple(quality.quality_totals(checks).first()) == (7, 5, 2, False)
    with pytest.raises(quality.DataQualityError, match=r"failed_rows=1\); mart_daily"):
        quality.raise_for_failed(checks)


def test_empty_raw_tables_fail_without_rows(spark):
    empty = spark.createDataFrame([], RAW_CUSTOMERS)
    row = quality.not_empty("raw_customers_not_empty", empty, spark).first()
    assert (row.passed, row.failed_rows) == (False, 0)


def test_orphans_count_orders_and_missing_customers(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "customer_id bigint")
    dim = spark.createDataFrame([(1,), (1,), (2,)], "customer_id bigint")
    assert quality.orphan_orders(fact, dim).first().n == 4
    assert quality.duplicate_keys(dim, ["customer_id"]).first().n == 1


# ---- narrow tables ---------------------------------------------------------


def test_narrow_tables(spark):
    schema = (
        "shopify_gid string, legacy_order_id bigint, customer_legacy_id bigint, created_at string, total_price decimal(18,4),"
        " currency_code string, shipping_country string, totalrefunded decimal(18,4), customer_display_name string, shipping_city string"
    )
    rows = [
        ("g1", 1, 7, "2026-04-01 23:59:59", Decimal("5"), "", None, None, " Old ", "rome"),
        ("g2", 2, 7, "2026-04-02 00:00:00", Decimal("6"), " eur ", " Italy ", Decimal("1"), " New ", ""),
        ("g3", None, 7, "2026-04-03 00:00:00", Decimal("6"), "eur", "x", None, "Last", "oslo"),
        ("g4", 4, 8, None, Decimal("6"), "eur", "x", None, "  ", None),
        ("g5", 5, None, "2026-04-03 00:00:00", Decimal("6"), "eur", "x", None, "No", "oslo"),
    ]
    wide = spark.createDataFrame(rows, schema)
    orders = {r.order_id: tuple(r)[3:6] for r in narrow.narrow_orders(wide).collect()}
    assert orders == {1: (date(2026, 4, 1), "UNKNOWN", ""), 2: (date(2026, 4, 2), "eur", "Italy")}
    people = {r.customer_id: tuple(r)[1:] for r in narrow.narrow_customers(wide).collect()}
    assert people == {7: ("New", "UNKNOWN", "standard"), 8: ("guest", "UNKNOWN", "standard")}


# ---- reports ---------------------------------------------------------------


def test_cards(spark):
    rows = spark.createDataFrame(
        [(1, 10.5, "3", None, "a"), (2, None, "x", None, "b"), (3, 0.25, "", None, "c")],
        "order_id bigint, net double, amount string, nothing double, note string",
    )
    entry = CatalogEntry("mart", "t", "t", kpis=(Kpi("net", "net", "avg"), Kpi("nothing", "nothing"), Kpi("amount", "amount"), Kpi("gone", "gone")))
    cards = {r.label: (r.value, r.text) for r in reports.kpi_cards(rows, entry).collect()}
    assert cards == {"rows": (3.0, "3"), "net": (5.38, "5.38"), "amount": (3.0, "3")}
    zeros = {r.label: r.value for r in reports.kpi_cards(rows, entry, null_as_zero=True).collect()}
    assert zeros == {"rows": 3.0, "net": 3.58, "amount": 3.0, "nothing": 0.0}
    guessed = [r.label for r in reports.kpi_cards(rows, CatalogEntry("raw", "t", "t")).orderBy("position").collect()]
    assert guessed == ["rows", "∑ net", "∑ amount"]


def test_average_without_numbers_is_a_dash(spark):
    rows = spark.createDataFrame([("a", None)], "k string, v double")
    entry = CatalogEntry("mart", "t", "t", kpis=(Kpi("v", "v", "avg"),))
    assert [r.text for r in reports.kpi_cards(rows, entry).orderBy("position").collect()] == ["1", "—"]


def test_heuristic_takes_the_four_largest(spark):
    rows = spark.createDataFrame([(1, -50, 3, 4, 5, 6)], "a int, b int, c int, d int, e int, customer_id int")
    assert [r.label for r in reports.heuristic_cards(rows).collect()] and sorted(
        r.label for r in reports.heuristic_cards(rows).collect()
    ) == ["∑ b", "∑ c", "∑ d", "∑ e"]


def test_chart_series(spark):
    rows = spark.createDataFrame([("b", "2"), (None, "1"), ("c", None), ("d", "x")], "k string, v string")
    entry = CatalogEntry("mart", "t", "t", "bar", "k", "v")
    assert [tuple(r) for r in reports.chart_series(rows, entry).collect()] == [("", 1.0), ("b", 2.0)]


def test_ranking_shares_ties(spark):
    city = spark.createDataFrame([("a", 5, 1), ("b", 5, 1), ("c", 9, 1), ("c", 1, 2)], "city string, gross_merchandise_value int, order_count int")
    assert [(r.city, r.sales_rank) for r in reports.city_ranking(city, top=3).collect()] == [("c", 1), ("a", 2), ("b", 2)]
    assert [r.city for r in reports.city_ranking(city).collect()] == ["c", "a", "b"]


def test_dashboard_filter_skips_absent_columns(spark):
    rows = spark.createDataFrame([("2026-01", "a"), ("2026-02", "b")], "order_month string, city string")
    assert reports.dashboard_filter(rows, months=["2026-02"], levels=["gold"]).count() == 1


def test_catalogue_columns_exist(spark):
    from salesloom import schemas

    columns = {p.source: p.columns for p in schemas.PUBLISHED}
    for table, entry in CATALOG_BY_TABLE.items():
        used = [k.column for k in entry.kpis] + [c for c in (entry.label_column, entry.value_column) if c]
        assert set(used) <= set(columns[table])


# ---- schema changes --------------------------------------------------------


def test_migrations(spark):
    old = spark.createDataFrame([("k", Decimal("10.00"), None, " "), ("m", Decimal("4.00"), Decimal("1.00"), "USD")],
                                "summary_key string, total_sales decimal(12,2), total_refunds decimal(18,4), currency_code string")
    new = {r.summary_key: r for r in evolve.migrate_additive("mart_sales_summary", old).collect()}
    assert (new["k"].currency_code, new["k"].gross_sales, new["k"].net_sales) == ("CNY", 10, 10)
    assert (new["m"].currency_code, new["m"].net_sales) == ("USD", 3)
    with pytest.raises(PySparkException, match="gross_sales must not be NULL"):
        evolve.migrate_additive("mart_sales_summary", old.drop("total_sales")).collect()
    staged = spark.createDataFrame([(1, Decimal(5), Decimal(9))], "order_id int, order_amount decimal(18,4), refund_amount decimal(18,4)")
    assert evolve.migrate_additive("stg_orders", staged).first().net_amount == -4
    assert as_doubles(evolve.migrate_additive("raw_orders", staged)).first().refund_amount == 9.0
    assert evolve.migrate_additive("dim_customers", staged) is staged
