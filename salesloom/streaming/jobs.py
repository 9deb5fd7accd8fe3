"""Structured Streaming forms of the incremental jobs.

Upserts go into versioned tables. Every other job lands its micro-batches as folders `batch_id=<n>` of immutable files. A
batch that runs again after a failure replaces its own folder and nothing else, so
results are exactly-once; readers resolve versions with the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesloom.operators import marts
from salesloom.operators.incremental import unseen
from salesloom.operators.wide import wide_orders
from salesloom.session import configure
from salesloom.sinks.key_index import KeyIndex
from salesloom.sinks.versioned import VersionedTable
from salesloom.sources import pages

# State on disk instead of in executor memory.
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder or pattern as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def page_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Order pages, one per line, out of `day=` folders as a stream."""
    reader = spark.readStream.schema("value string, day date").format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(root).withColumnRenamed("value", "document")


def land(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    prepare: Callable[[DataFrame, int], DataFrame] = lambda batch, _: batch,
    mode: str = "append",
    available_now: bool = True,
    after: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Start the stream; each micro-batch becomes the folder `batch_id=<n>` under `out`. `after` runs behind each of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # A stream's own session switches adaptive execution off; the batch jobs need it for skewed keys.
        configure(batch.sparkSession)
        # Held, because a job may read its batch more than once.
        held = batch.persist()
        prepare(held, batch_id).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        held.unpersist()
        if after is not None:
            after(batch.sparkSession, batch_id)

    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def landed(spark: SparkSession, out: str) -> DataFrame | None:
    """All landed batches with their `batch_id`, or None before the first one."""
    try:
        return spark.read.parquet(out)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def land_unseen(
    stream: DataFrame, existing: DataFrame, out: str, checkpoint: str, key: str = "order_id"
) -> StreamingQuery:
    """Land the rows whose key is neither in the existing table nor in an earlier batch.

    Every landed batch is indexed (`KeyIndex`), and of the earlier batches only those are read that may hold a key of the new
    one, so a micro-batch does not read the stream's whole history. A batch that runs again replaces its folder and its entry.
    """
    index_path = f"{out.rstrip('/')}-keys"

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        return unseen(earlier_keys(spark, out, index_path, existing, batch, batch_id, key), batch, key)

    def index(spark: SparkSession, batch_id: int) -> None:
        KeyIndex(spark, index_path, key).add(f"b{batch_id}", spark.read.parquet(f"{out}/batch_id={batch_id}"))

    return land(stream, out, checkpoint, prepare, after=index)


def earlier_keys(
    spark: SparkSession, out: str, index_path: str, existing: DataFrame, batch: DataFrame, batch_id: int, key: str
) -> DataFrame:
    """The known keys that a batch has to be compared with: those of the table, and of the earlier batches that may hold one of its keys."""
    known = existing.select(key)
    folders = KeyIndex(spark, index_path, key).folders_that_may_hold(batch)
    paths = [f"{out}/batch_id={f[1:]}" for f in folders if int(f[1:]) < batch_id]
    return known.unionByName(spark.read.parquet(*paths).select(key)) if paths else known


def without_repeats(stream: DataFrame, key: Sequence[str], clock: str, delay: str) -> DataFrame:
    """A stream without rows whose key came within the delay before; the state stays bounded.

    Rows behind the watermark are dropped too, repeated or not. Where none may get lost, use `land_unseen`, which
    compares with everything landed and keeps no state.
    """
    return stream.withWatermark(clock, delay).dropDuplicatesWithinWatermark(list(key))


def merge_latest(
    stream: DataFrame, table: VersionedTable, checkpoint: str, writer: str, compact_every: int = 8, available_now: bool = True
) -> StreamingQuery:
    """Upsert a stream into a versioned table: each micro-batch writes its latest rows and commits them under its number.

    A micro-batch that runs again after a failure finds its number committed and changes nothing. Every `compact_every` batches the youngest
    folders of like size are merged, so readers meet few folders however long the stream has run.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        configure(batch.sparkSession)
        here = replace(table, spark=batch.sparkSession)
        here.upsert(batch, writer, batch_id)
        if batch_id % compact_every == compact_every - 1:
            here.compact()

    started = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (started.trigger(availableNow=True) if available_now else started).start()


def merge_wide_orders(page_documents: DataFrame, shop_name: str, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Stream order pages into a versioned wide table with the day of each row's page."""
    wide = wide_orders(pages.order_nodes(page_documents, position="edge"), shop_name, keep=("day", "edge"), versioned=True)
    return merge_latest(wide, table, checkpoint, f"pages of {shop_name}")


CUSTOMER_DAY = ("customer_id", "order_date", "order_month", "currency_code")


def customer_days(orders: DataFrame, clock: str = "order_time") -> DataFrame:
    """Order sums per customer, day and currency."""
    order_date = F.col(clock).cast("date")
    dated = orders.withColumns({"order_date": order_date, "order_month": F.date_format(order_date, "yyyy-MM")})
    return dated.groupBy(*CUSTOMER_DAY).agg(
        F.count("*").alias("order_count"),
        F.sum("order_amount").alias("order_amount"),
        F.sum("refund_amount").alias("refund_amount"),
        F.sum("net_amount").alias("net_amount"),
    )


def land_customer_days(orders: DataFrame, out: str, checkpoint: str, clock: str = "order_time") -> StreamingQuery:
    """Land the customer days of each micro-batch.

    No state and no watermark: sums of batches add up, so an order counts however late it comes.
    """
    return land(orders, out, checkpoint, lambda batch, _: customer_days(batch, clock))


def daily_sales_of_stream(spark: SparkSession, out: str) -> DataFrame:
    """The daily mart over the landed customer days; one row per customer and day keeps customer counts exact."""
    sums = [F.sum(c).alias(c) for c in ("order_count", "order_amount", "refund_amount", "net_amount")]
    return marts.daily_sales(landed(spark, out).groupBy(*CUSTOMER_DAY).agg(*sums))


def with_reject_reason(orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders with why they would fail the row checks, NULL when they pass."""
    # Dealt out once more: the join then reads both sides from exchanges of its own, and Spark can split a hot customer.
    known = dim.select(F.col("customer_id").alias("known__")).distinct().hint("rebalance")
    found = orders.join(known, F.col("customer_id") == F.col("known__"), "left")
    reason = (
        F.when(F.col("customer_id").isNull(), "no customer")
        .when(F.col("order_amount") <= 0, "amount not positive")
        .when(F.col("known__").isNull(), "unknown customer")
    )
    return found.select(*orders.columns, reason.alias("reject_reason"))


def land_checked(orders: DataFrame, dim: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Land orders with their reject reason; accepted rows have none."""
    return land(orders, out, checkpoint, lambda batch, _: with_reject_reason(batch, dim))
