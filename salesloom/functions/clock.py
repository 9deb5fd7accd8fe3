"""Date and time text expressions.

Clock readings are TIMESTAMP_NTZ inside. The session runs in UTC (`session.configure`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The renderings of an order's creation time.
CITY_ZONES = {
    "beijing_created_at": "Asia/Shanghai",
    "use_created_at": "America/New_York",
    "berlin_created_at": "Europe/Berlin",
}


def _text(clock: Column) -> Column:
    return F.substring(clock.cast("string"), 1, 19)


def _given(iso: Column) -> Column:
    return F.nullif(iso, F.lit(""))


def wall_clock(iso: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` as written in the ISO text, its offset dropped."""
    return _text(_given(iso).cast("timestamp_ntz"))


def instant(iso: Column) -> Column:
    """The point in time of an ISO text; text without an offset is UTC, the session's time zone."""
    return _given(iso).cast("timestamp")


def city_clock(moment: Column, zone: str) -> Column:
    """`yyyy-MM-dd HH:mm:ss` of an instant on the clocks of a time zone."""
    here = moment.cast("timestamp_ntz")
    return _text(F.convert_timezone(F.current_timezone(), F.lit(zone), here))


def clock_date(text: Column) -> Column:
    """Date of a `yyyy-MM-dd HH:mm:ss` text; other text raises."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date")


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def any_date(value: Column) -> Column:
    """Date written with dashes or slashes; other text raises."""
    return F.coalesce(value.try_cast("date"), F.to_date(F.replace(value, F.lit("/"), F.lit("-")), "yyyy-M-d"))


def lenient_date(text: Column, today: Column | None = None) -> Column:
    """Date out of a date or date-time text, its own calendar day; blank means today, damaged text raises."""
    now = F.current_date() if today is None else today
    given = F.nullif(F.btrim(text), F.lit(""))
    return F.when(given.isNull(), now).otherwise(
        F.when(F.length(given) <= 10, F.to_date(given, "yyyy-M-d")).otherwise(given.cast("timestamp_ntz").cast("date"))
    )
