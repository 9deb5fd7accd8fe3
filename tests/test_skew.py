"""Hot keys: one key holds a third of the rows, another third has no key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesloom.operators import incremental, quality
from salesloom.streaming import jobs

SKEW_SETTINGS = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
}


@pytest.fixture()
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture()
def hot(no_broadcast, folder):
    spark = no_broadcast
    third, n = F.col("id") % 3, 240_000
    old = spark.range(0, n // 2, 1, 8).select(F.when(third == 0, 5).otherwise(F.col("id")).alias("order_id"))
    old.write.parquet(f"{folder}/old")
    key = F.when(third == 0, F.lit(None)).when(third == 1, 7_000_000).otherwise(F.col("id") + n // 4)
    spark.range(0, n, 1, 8).select(key.alias("order_id"), F.md5(F.col("id").cast("string")).alias("v")).write.parquet(f"{folder}/new")
    return spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new")


def plan_after_run(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_anti_join_splits_the_hot_key(hot):
    old, new = hot
    fresh = incremental.unseen(old, new)
    known = {r.order_id for r in old.collect()}
    wanted = sum(1 for r in new.select("order_id").collect() if r.order_id is None or r.order_id not in known)
    assert fresh.count() == wanted
    assert "SortMergeJoin(skew=true)" in plan_after_run(fresh)


def test_reject_join_splits_the_hot_key(hot):
    dim, orders = (t.withColumnRenamed("order_id", "customer_id") for t in hot)
    reasons = jobs.with_reject_reason(orders.withColumn("order_amount", F.lit(1)), dim)
    assert "SortMergeJoin(skew=true)" in plan_after_run(reasons)


def test_latest_and_orphans_reduce_before_the_shuffle(hot):
    old, new = hot
    assert "partial_max_by" in incremental.latest(new, ["order_id"], ["v"])._jdf.queryExecution().toString()
    orphans = quality.orphan_orders(new.withColumnRenamed("order_id", "customer_id"), old.withColumnRenamed("order_id", "customer_id"))
    assert "partial_count" in orphans._jdf.queryExecution().toString()
    known = {r.order_id for r in old.collect()}
    assert orphans.first().n == sum(1 for r in new.select("order_id").collect() if r.order_id not in known)
