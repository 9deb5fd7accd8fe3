"""The key index: no key is missed, and a micro-batch reads only folders that may hold its keys."""

from __future__ import annotations

import random

from salesloom.sinks.key_index import KeyIndex
from salesloom.streaming import jobs
from tests.conftest import values
from tests.test_streaming import drop_file, stream_of


def keys(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "k bigint")


def test_no_key_is_missed_and_few_folders_are_named(spark, folder):
    index, chance = KeyIndex(spark, f"{folder}/index", "k"), random.Random(3)
    assert index.folders_that_may_hold(keys(spark, [1])) == []
    sets = {f"b{n}": {chance.randrange(-(10**12), 10**12) for _ in range(size)} for n, size in enumerate((1, 40, 3000, 9000))}
    for name, held in sets.items():
        index.add(name, keys(spark, [*held, None]))
    for name, held in sets.items():
        probe = chance.sample(sorted(held), min(3, len(held)))
        found = index.folders_that_may_hold(keys(spark, [*probe, None]))
        assert name in found and len(found) <= 2
    strangers = [chance.randrange(-(10**12), 10**12) for _ in range(20)]
    assert len(index.folders_that_may_hold(keys(spark, strangers))) <= 2
    assert index.folders_that_may_hold(keys(spark, [])) == [] and index.folders_that_may_hold(keys(spark, [None])) == []
    # A batch that runs again replaces its entry.
    index.add("b1", keys(spark, [5]))
    assert index.folders_that_may_hold(keys(spark, [5])) == ["b1"]
    assert "b1" not in index.folders_that_may_hold(keys(spark, sorted(sets["b1"])))


def test_micro_batches_do_not_read_the_history(spark, folder):
    schema = "order_id bigint, v string"
    existing = spark.createDataFrame([(-1, "old")], schema)
    for n in range(5):
        # The ranges of all batches overlap; the third batch repeats keys of the first.
        rows = [(k * 5 + n, f"b{n}") for k in range(200)] + ([(k * 5, "again") for k in range(3)] if n == 3 else [])
        drop_file(spark, folder, n, rows, schema)
    out, read = f"{folder}/out", []
    plain = jobs.earlier_keys

    def watched(*given):
        found = plain(*given)
        read.append(len(found.inputFiles()))
        return found

    jobs.earlier_keys = watched
    try:
        jobs.land_unseen(stream_of(spark, folder), existing, out, f"{folder}/state").awaitTermination()
    finally:
        jobs.earlier_keys = plain
    assert values(jobs.landed(spark, out), "order_id") == [(k,) for k in range(1000)] or sorted(
        r.order_id for r in jobs.landed(spark, out).collect()
    ) == list(range(1000))
    assert len(read) == 5 and sum(r > 0 for r in read) <= 2 and read[-1] <= read[3]
