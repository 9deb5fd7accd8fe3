"""Incremental loads: unseen keys, latest versions, day windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Copies of one known key that may reach the join, see known_keys.
_COPIES = 8


def known_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys of a table for a semi or anti join, a few copies of each at most.

    Every task keeps one copy of a key before the shuffle, so a key with very many rows
    is no burden. Plainly distinct keys would already lie where the join wants them, and
    the join would then read them through an aggregate, in which case Spark cannot split
    a hot key on the other side. With a copy number among the grouping keys they are
    shuffled once more and it can.
    """
    copy = F.pmod(F.spark_partition_id(), F.lit(_COPIES))
    return rows.select(key, copy.alias("copy")).distinct().select(key)


def unseen(existing: DataFrame, incoming: DataFrame, key: str = "order_id") -> DataFrame:
    """Incoming rows whose key the existing table does not hold.

    Copies inside the batch all stay, and so do rows without a key. Keys outside the
    range of the batch cannot match, so that range is pushed into the scan of the
    existing table, where file statistics skip most of the history.
    """
    low = incoming.select(F.min(key)).scalar()
    # Not a second aggregate: Spark would merge the two, and a merged bound is not pushed into the scan.
    high = incoming.select(key).filter(F.col(key).isNotNull()).orderBy(F.col(key).desc()).limit(1).scalar()
    in_range = existing.filter((F.col(key) >= low) & (F.col(key) <= high))
    return incoming.join(known_keys(in_range, key), key, "left_anti").select(*incoming.columns)


def append_unseen(existing: DataFrame, incoming: DataFrame, key: str = "order_id") -> DataFrame:
    """The existing rows plus the unseen incoming rows."""
    return existing.unionByName(unseen(existing, incoming, key))


def latest(rows: DataFrame, key: Sequence[str], version: Sequence[str | Column]) -> DataFrame:
    """The row with the highest version of every key, NULL versions lowest.

    An aggregate, not a window: every task keeps one candidate per key before the
    shuffle. Rows with equal versions are told apart by a hash of the row.
    """
    keys = list(key)
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(*version, F.xxhash64(*rest))
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in rows.columns])


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Whole rows replaced by key: the highest version wins, the incoming row on a tie."""
    both = existing.withColumn("arrival", F.lit(0)).unionByName(
        incoming.withColumn("arrival", F.lit(1)), allowMissingColumns=True
    )
    return latest(both, key, [*version, "arrival"]).drop("arrival")


def look_back_days(value: object = None, default: int = 14) -> int:
    """Number of days to look back: at least one, the default when unreadable."""
    try:
        return max(1, int(str(value).strip()))
    except ValueError:
        return default


def calendar(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day between the two dates of each bounds row."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("day"))


def look_back(bounds: DataFrame, days: int, last: str = "last_day") -> DataFrame:
    """The last `days` days up to the end date of each bounds row."""
    start = bounds.withColumn("first_day", F.date_sub(F.col(last), max(1, days) - 1))
    return calendar(start, "first_day", last)


def in_days(rows: DataFrame, clock: str, first_day: Column, last_day: Column) -> DataFrame:
    """Rows whose clock lies in the days from first to last; half open, so no second is lost."""
    start = first_day.cast("timestamp_ntz")
    end = F.date_add(last_day, 1).cast("timestamp_ntz")
    return rows.filter((F.col(clock) >= start) & (F.col(clock) < end))


def day_counts(days: DataFrame, rows: DataFrame, clock: str, *measures: Column) -> DataFrame:
    """Row count and measures per calendar day; days without rows count zero."""
    counted = rows.groupBy(F.col(clock).cast("date").alias("day")).agg(F.count("*").alias("row_count"), *measures)
    return days.join(counted, "day", "left").fillna(0, subset=["row_count"])
