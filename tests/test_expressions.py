"""Column expressions against values worked out by hand or in plain Python."""

from __future__ import annotations

from datetime import date, datetime, timezone
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesloom.functions import clock, money, text


def one(spark, expression, **inputs):
    kinds = {str: "string", int: "bigint", float: "double", Decimal: "decimal(38,4)", date: "date", type(None): "string", list: "array<string>"}
    schema = ", ".join(f"{name} {kinds[type(value)]}" for name, value in inputs.items())
    return spark.createDataFrame([tuple(inputs.values())], schema).select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "trimmed", "stripped"),
    [(" a ", "a", "a"), ("　a b ", "a b", "a b"), ("\ta\n", "\ta\n", "a"), ("", "", ""), (None, None, None)],
)
def test_trimming(spark, given, trimmed, stripped):
    assert one(spark, text.trim_u(F.col("v")), v=given) == trimmed
    assert one(spark, text.strip_all(F.col("v")), v=given) == stripped


@pytest.mark.parametrize(
    ("tags", "level"),
    [
        ("VIP, reseller", "vip"), ("Gold Circle", "gold"), ("", "standard"), ("  ", "standard"), (None, "standard"),
        ("Key Account, x", "key_account"), (" , , b c", "b_c"), ("silver,gold", "gold"), (",", "standard"),
    ],
)
def test_levels_of_text(spark, tags, level):
    assert one(spark, text.level_from_tags(F.col("v")), v=tags) == level


def test_levels_of_lists(spark):
    expression = text.level_from_tags(F.col("v"), is_array=True)
    assert one(spark, expression, v=[" ", "Key Account"]) == "key_account"
    assert one(spark, expression, v=["a", "bronze x"]) == "bronze"
    assert one(spark, expression, v=[]) == "standard"


@pytest.mark.parametrize(
    ("gid", "number"),
    [("gid://shopify/Order/123", 123), ("gid://shopify/Order/123 ", 123), ("gid://shopify/Order/x", None), ("123", None), (None, None), ("", None)],
)
def test_gid_number(spark, gid, number):
    assert one(spark, text.gid_number(F.col("v")), v=gid) == number


def test_whole_numbers(spark):
    for given, wanted in (("12", 12), (" 12 ", 12), ("1.5", 2), ("2.5", 2), (None, None), ("9007199254740993", 9007199254740993)):
        assert one(spark, text.to_bigint(F.col("v")), v=given) == wanted
    with pytest.raises(PySparkException):
        one(spark, text.to_bigint(F.col("v")), v="x1")


def test_shop_names(spark):
    for given, wanted in (("Demo.myshopify.com", "demo"), ("shop.example", "shop.example"), ("", "shopify_store"), (None, "shopify_store")):
        assert one(spark, text.shop_label(F.col("v")), v=given) == wanted
    for given, wanted in (("https://Demo-1.myshopify.com/", "demo-1.myshopify.com"), ("demo.example.com", None), ("-a.myshopify.com", None)):
        assert one(spark, text.store_domain(F.col("v")), v=given) == wanted


@pytest.mark.parametrize("iso", ["2026-03-08T06:59:59Z", "2026-03-08T07:00:00Z", "2026-10-25T00:59:59+00:00", "2026-10-25T01:00:00Z",
                                 "2026-04-01T23:30:00+08:00", "2026-01-01T00:00:00.250-05:00", "2026-07-01T10:00:00"])
def test_clocks(spark, iso):
    moment = datetime.fromisoformat(iso.replace("Z", "+00:00"))
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    assert one(spark, clock.wall_clock(F.col("v")), v=iso) == moment.strftime("%Y-%m-%d %H:%M:%S")
    for zone in clock.CITY_ZONES.values():
        wanted = moment.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S")
        assert one(spark, clock.city_clock(clock.instant(F.col("v")), zone), v=iso) == wanted


def test_empty_clocks(spark):
    for given in ("", None):
        assert one(spark, clock.wall_clock(F.col("v")), v=given) is None
        assert one(spark, clock.city_clock(clock.instant(F.col("v")), "Europe/Berlin"), v=given) is None


def test_lenient_dates(spark):
    today = F.lit("2026-05-05").cast("date")
    for given, wanted in (
        ("2026-04-01", date(2026, 4, 1)), ("2026-04-01T23:59:00-10:00", date(2026, 4, 1)), ("2026-04-01T00:00:00Z", date(2026, 4, 1)),
        ("2026-04-01 10:00", date(2026, 4, 1)), ("  ", date(2026, 5, 5)), (None, date(2026, 5, 5)),
    ):
        assert one(spark, clock.lenient_date(F.col("v"), today), v=given) == wanted
    with pytest.raises(PySparkException):
        one(spark, clock.lenient_date(F.col("v"), today), v="soon")


@pytest.mark.parametrize(
    ("total", "count"),
    [("1.0000", 8), ("0.0150", 1), ("2.0100", 2), ("100.0000", 3), ("-0.0150", 1), ("-1.0000", 8), ("99999999999999.9900", 7),
     ("0.0000", 5), ("12345678901234567890.1234", 999)],
)
def test_mean_is_exact(spark, total, count):
    wanted = (Decimal(total) / count).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert one(spark, money.mean(F.col("t"), F.col("n")), t=Decimal(total), n=count) == wanted


def test_mean_of_nothing(spark):
    assert one(spark, money.mean(F.col("t"), F.col("n")), t=Decimal("0"), n=0) is None


@pytest.mark.parametrize(
    ("value", "shown"),
    [("1234567", "1.23M"), ("1235000", "1.24M"), ("-2500000", "-2.50M"), ("10000", "10.0k"), ("45649", "45.6k"), ("9999", "9999"),
     ("0", "0"), ("12.5", "12.50"), ("-0.005", "-0.01"), ("1.005", "1.01"), ("9999.9999", "10000.00")],
)
def test_number_text(spark, value, shown):
    assert one(spark, money.number_text(F.col("v")), v=Decimal(value)) == shown


def test_number_text_of_nothing(spark):
    assert one(spark, money.number_text(F.col("v").cast("decimal(10,2)")), v=None) == "—"
