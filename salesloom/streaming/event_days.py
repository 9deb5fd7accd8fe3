"""The daily mart by event time: days close behind a watermark, and rows that come later are kept apart.

The watermark of a micro-batch is the latest order time of all batches before it, less the delay. Days that end before it are closed.
A row of a closed day, or without a time, is late: it is landed whole and changes nothing. All other rows are accepted and landed as
sums per customer and day. Once a batch has moved the watermark on, the days that it closes are added up, once, from their own
folders, and written: a closed day never changes, so readers take it as it is and add up the open days only.

`withWatermark` with a window in append mode closes days in the same way, but it drops late rows without a trace. Here accepted and late
rows together are the input. Nothing is held as state: the watermark is landed with each batch, so a batch that runs again
after a failure decides as it did before and replaces its own folders.

Under the output folder:

    open/order_date=<day>/batch_id=<n>     accepted sums
    late/batch_id=<n>                      late rows, with the watermark they missed
    closed/batch_id=<n>                    mart rows of the days that the batch closed
    clock/batch_id=<n>                     one row: latest order time up to and with this batch

Defined cases: an empty batch closes nothing; a row of an open day counts however much older than the batch's other rows it is; the
first batch has no watermark, so all its rows with a time are accepted; a time in the far future closes all days before it, as
any watermark would, so times should be checked upstream. Days that no later order closes stay open.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesloom.operators import marts
from salesloom.session import configure
from salesloom.streaming.jobs import CUSTOMER_DAY, customer_days, landed

_SUMS = ("order_count", "order_amount", "refund_amount", "net_amount")


def land_event_days(orders: DataFrame, out: str, checkpoint: str, delay: str = "2 days", clock: str = "order_time", available_now: bool = True) -> StreamingQuery:
    """Start the stream of orders; `delay` is an interval such as `2 days`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        before = clock_of(spark, out, batch_id - 1)
        opened = first_open_day(before, delay)
        day = F.col(clock).cast("date")
        late = day.isNull() if opened is None else day.isNull() | (day < F.lit(opened))
        held = batch.persist()
        missed = held.filter(late).withColumn("open_from", F.lit(opened).cast("date"))
        missed.write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
        # The days of a repeated batch are those of its first try, so it replaces all its folders.
        accepted = customer_days(held.filter(~late), clock).withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "order_date")
        in_folders = accepted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("order_date", "batch_id")
        in_folders.parquet(f"{out}/open")
        times = held.select(F.col(clock).alias("latest"))
        times = times if before is None else times.unionByName(before)
        times.agg(F.max("latest").alias("latest")).write.mode("overwrite").parquet(f"{out}/clock/batch_id={batch_id}")
        held.unpersist()
        close(spark, out, batch_id, opened, first_open_day(clock_of(spark, out, batch_id), delay))

    writer = orders.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def clock_of(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    """One row: the latest order time up to and with a batch; None before the first batch."""
    return None if batch_id < 0 else spark.read.parquet(f"{out}/clock/batch_id={batch_id}")


def first_open_day(clock: DataFrame | None, delay: str) -> date | None:
    """The first day that is not closed by this clock; None while nothing is."""
    if clock is None:
        return None
    return clock.select((F.max("latest") - F.expr(f"interval {delay}")).cast("date")).first()[0]


def close(spark: SparkSession, out: str, batch_id: int, begin: date | None, end: date | None) -> None:
    """Write the mart rows of the days from begin (all earlier ones, if None) to before end."""
    sums = accepted_days(spark, out)
    if end is None or sums is None:
        return
    days = sums.filter(F.col("order_date") < F.lit(end))
    if begin is not None:
        days = days.filter(F.col("order_date") >= F.lit(begin))
    # Batches up to this one: a repeated batch must not see what came behind it.
    _mart(days.filter(F.col("batch_id") <= batch_id)).write.mode("overwrite").parquet(f"{out}/closed/batch_id={batch_id}")


def accepted_days(spark: SparkSession, out: str) -> DataFrame | None:
    """Sums per customer, day, currency and batch of all accepted rows."""
    return landed(spark, f"{out}/open")


def _mart(sums: DataFrame) -> DataFrame:
    return marts.daily_sales(sums.groupBy(*CUSTOMER_DAY).agg(*(F.sum(c).alias(c) for c in _SUMS)))


def closed_days(spark: SparkSession, out: str) -> DataFrame | None:
    """The daily mart of all closed days."""
    found = landed(spark, f"{out}/closed")
    return None if found is None else found.drop("batch_id")


def open_days(spark: SparkSession, out: str, delay: str = "2 days") -> DataFrame | None:
    """The daily mart, so far, of the days that are not closed; reads their folders only."""
    sums, opened = accepted_days(spark, out), first_open_day(landed(spark, f"{out}/clock"), delay)
    if sums is None:
        return None
    return _mart(sums if opened is None else sums.filter(F.col("order_date") >= F.lit(opened)))


def late_rows(spark: SparkSession, out: str) -> DataFrame | None:
    """Rows that came after their day was closed, with the first day that was open then; rows without a time."""
    return landed(spark, f"{out}/late")
