"""Large JSON arrays cut anywhere: the same items as a whole parse."""

from __future__ import annotations

import glob
import json
import math
import random

import pytest

from salesloom.sources import inbox, json_arrays


def write(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as file:
        file.write(text)
    return f"{folder}/{name}"


def value(chance, deep=0):
    kind = chance.randrange(8 if deep < 3 else 5)
    if kind < 2:
        return "".join(chance.choice(['a', '}', '{', ']', '[', '"', "\\", ",", " ", "é", "\n", "𝄞"]) for _ in range(chance.randrange(9)))
    if kind < 5:
        return chance.choice([1, 2.5, None, True, -3])
    if kind < 6:
        return [value(chance, deep + 1) for _ in range(chance.randrange(3))]
    return {f"k{n}}}": value(chance, deep + 1) for n in range(chance.randrange(3))}


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_items_equal_a_whole_parse(spark, folder, small_splits):
    chance, want = random.Random(4), {}
    for n in range(5):
        items = [f"s{v}" if isinstance(v, str) else v for v in (value(chance) for _ in range(chance.randrange(30)))]
        items += [{"id": k, "t": "x}\\\"" * k} for k in range(n * 5)]
        chance.shuffle(items)
        space = chance.choice([None, 1])
        write(folder, f"{n}.json", chance.choice(["", "﻿", " \n"]) + json.dumps(items, indent=space, ensure_ascii=n % 2 == 0) + chance.choice(["", "\n"]))
        want[f"{n}.json"] = sorted(json.dumps(i) for i in items if isinstance(i, dict))
    write(folder, "5.json", " [ ] ")
    want["5.json"] = []
    fragments = json_arrays.fragments(spark, folder)
    assert fragments.select("file", "split").distinct().count() > 8
    got = {name: [] for name in want}
    for row in json_arrays.items_of_arrays(spark, folder).collect():
        for item in row["items"]:
            if item and item.startswith("{"):
                got[row["file"].rpartition("/")[2]].append(json.dumps(json.loads(item)))
    assert {n: sorted(v) for n, v in got.items()} == want


def test_objects_and_broken_arrays(spark, folder, small_splits):
    whole = [{"id": k, "name": f"n{k}", "city": "x } y"} for k in range(60)]
    write(folder, "a.json", json.dumps(whole))
    write(folder, "b.json", json.dumps({"n": [1], "customers": [{"id": 100 + k, "name": "b"} for k in range(30)]}))
    write(folder, "c.json", '[{"id": 900}]')
    for limit in (0, 1000):
        records = inbox.json_file_records(spark, folder, "customers", limit)
        ids = sorted(r.customer_id for r in inbox.inbox_customers(records).collect())
        assert ids == [*range(60), *range(100, 130), 900], limit
    for k, text in enumerate(('[{"id": 1}, {"id": 2}', '[{"id": 1}, {"id": "2]', '[{"id": 1} {"id": 2}]', '[{"id": 1}]]', "[", '[{"id": 1}')):
        path = write(folder, f"broken-{k}.txt", text)
        with pytest.raises(Exception, match="cannot be read"):
            json_arrays.items_of_arrays(spark, path).collect()


def test_one_array_is_read_by_many_tasks(spark, folder):
    from pyspark.sql import functions as F

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        rows = ",".join(json.dumps({"order_id": k, "customer_id": k % 7, "order_amount": 1.5, "order_date": "2026-04-01", "note": "}" * (k % 5)}) for k in range(20_000))
        path = write(folder, "orders.json", f"[{rows}]")
        splits = json_arrays.fragments(spark, path).groupBy("split").count().collect()
        assert len(splits) >= 5 and max(r["count"] for r in splits) < 20_000
        records = inbox.json_file_records(spark, path, "orders", 0)
        orders = inbox.inbox_orders(records).agg(F.count("*").alias("n"), F.sum("order_id").alias("s"), F.sum("order_amount").alias("a")).first()
        assert (orders.n, orders.s, float(orders.a)) == (20_000, sum(range(20_000)), 30_000.0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sizes_of_files_are_known_without_reading_them(spark, folder, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    with open(f"{folder}/a.json", "w") as file:
        file.write("[" + ",\n".join(f'{{"id": {i}}}' for i in range(50)) + "]")
    plans, is_empty = [], DataFrame.isEmpty
    monkeypatch.setattr(DataFrame, "isEmpty", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or is_empty(self))
    for limit, scans in ((1 << 20, 1), (100, 2)):
        plans.clear()
        assert inbox.json_file_records(spark, folder, "orders", limit).count() == 50
        assert len(plans) == scans and not any("FileScan text" in plan for plan in plans), plans


def test_inbox_arrays_are_written_order_by_order(spark, folder, monkeypatch):
    from querybook import file_queries

    orders = [(i, i % 7, 1.5 * i, "1996-02-03") for i in range(-40, 400)] + [(5, 1, 7.25, "1996-02-04"), (5, 1, 7.25, "1996-02-04"), (None, 2, 1.0, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double, day string").selectExpr(
        "* EXCEPT (day)", "CAST(day AS timestamp_ntz) AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(1, "C", 0, "BUILDING")], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    monkeypatch.setattr(file_queries, "shared_dir", lambda _, name: f"{folder}/{name}")
    stopped = RuntimeError("the inbox is written")
    monkeypatch.setattr(file_queries, "materialize_inbox", lambda *_: (_ for _ in ()).throw(stopped))
    with pytest.raises(RuntimeError, match="the inbox is written"):
        file_queries.materialized_inbox(spark, folder)
    texts = [open(f).read() for f in glob.glob(f"{folder}/inbox-run/inbox/orders.json/**/part-*", recursive=True)]
    parts = [json.loads(text) for text in texts]
    assert len(parts) == len({int(math.fmod(o[0], 16)) if o[0] is not None else None for o in orders})
    assert all(len({math.fmod(o["id"], 16) if "id" in o else None for o in part}) == 1 for part in parts)
    found = sorted((o.get("id", 1000), o["customerId"], float(o["total"]), o.get("createdAt", "")) for part in parts for o in part)
    assert found == sorted((1000 if i is None else i, c, t, d or "") for i, c, t, d in orders)
    assert max(len(line) for text in texts for line in text.split("\n")) < 200
