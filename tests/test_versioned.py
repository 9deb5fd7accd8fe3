"""Merge-on-read tables: batches only, lost jobs, racing writers, compaction."""

from __future__ import annotations

import random

import pytest

from salesloom.sinks import versioned
from salesloom.sinks.versioned import Folder, VersionedTable
from salesloom.sources import storage
from tests.conftest import values

SHAPE = "k bigint, v int, name string"


def table(spark, folder):
    return VersionedTable(spark, f"{folder}/t", ("k",), ("v",))


def files(spark, folder):
    return {n for name in storage.names(spark, f"{folder}/t/data") for n in storage.names(spark, f"{folder}/t/data/{name}") if n.startswith("part-")}


def test_a_second_batch_writes_its_rows_only(spark, folder):
    wide = table(spark, folder)
    assert not wide.exists()
    with pytest.raises(ValueError):
        wide.read()
    assert wide.upsert(spark.range(1000).selectExpr("id AS k", "1 AS v", "'a' AS name")) == 1000
    before = files(spark, folder)
    assert wide.upsert(spark.createDataFrame([(3, 2, "b"), (3, 1, "stale"), (2000, 1, "c"), (5, 0, "old"), (6, 1, "tie")], SHAPE)) == 4
    assert before < files(spark, folder)
    assert [f.rows for f in wide.manifest().folders] == [1000, 4]
    found = {r.k: r.name for r in wide.read().collect()}
    assert len(found) == 1001 and [found[k] for k in (3, 2000, 5, 6, 7)] == ["b", "c", "a", "tie", "a"]


def test_model_of_many_batches_and_compactions(spark, folder):
    chance, wide, want = random.Random(5), table(spark, folder), {}
    for step in range(12):
        rows = [(chance.randrange(40), chance.randrange(5), f"{step}-{n}") for n in range(chance.choice((1, 3, 30)))]
        unique = {}
        for k, v, name in rows:
            if k not in unique or v > unique[k][0]:
                unique[k] = (v, name)
        wide.upsert(spark.createDataFrame([(k, v, n) for k, (v, n) in unique.items()], SHAPE))
        for k, (v, name) in unique.items():
            if k not in want or v >= want[k][0]:
                want[k] = (v, name)
        if step % 3 == 2:
            wide.compact()
        if step == 9:
            wide.compact(everything=True)
            assert len(wide.manifest().folders) == 1
    assert {r.k: (r.v, r.name) for r in wide.read().collect()} == want
    wide.clean()
    assert {r.k: (r.v, r.name) for r in wide.read().collect()} == want
    assert len(storage.names(spark, f"{folder}/t/data")) == len(wide.manifest().folders)


class Killed(Exception):
    pass


@pytest.mark.parametrize("action", ["upsert", "compact"])
@pytest.mark.parametrize("moment", ["before the rows", "before the commit", "while committing"])
def test_a_killed_job_loses_nothing(spark, folder, monkeypatch, action, moment):
    wide = table(spark, folder)
    for n in range(3):
        wide.upsert(spark.createDataFrame([(n, 1, "a"), (9, n, f"v{n}")], SHAPE))
    before, commits = values(wide.read()), storage.names(spark, f"{folder}/t/manifest")

    def killed(*_):
        raise Killed

    with monkeypatch.context() as patch:
        if moment == "before the rows":
            patch.setattr(VersionedTable, "_written", killed)
        elif moment == "before the commit":
            patch.setattr(VersionedTable, "_commit", killed)
        else:
            patch.setattr(storage, "write_once", killed)
        with pytest.raises(Killed):
            wide.compact(everything=True) if action == "compact" else wide.upsert(spark.createDataFrame([(0, 7, "b")], SHAPE))
    assert values(wide.read()) == before and storage.names(spark, f"{folder}/t/manifest") == commits
    # The rerun succeeds, and what the dead job left is removed.
    if action == "compact":
        assert wide.compact(everything=True) == 3
        assert values(wide.read()) == before
    else:
        wide.upsert(spark.createDataFrame([(0, 7, "b")], SHAPE))
        assert {r.k: r.name for r in wide.read().collect()} == {0: "b", 1: "a", 2: "a", 9: "v2"}
    left = set(storage.names(spark, f"{folder}/t/data")) - {f.name for f in wide.manifest().folders}
    assert set(wide.clean()) == left


def test_racing_writers_both_stay(spark, folder, monkeypatch):
    wide, other = table(spark, folder), table(spark, folder)
    wide.upsert(spark.createDataFrame([(1, 1, "a")], SHAPE))
    plain, raced = storage.write_once, []

    def late(session, path, text):
        if not raced:
            raced.append(path)
            other.upsert(spark.createDataFrame([(2, 1, "other")], SHAPE))
        plain(session, path, text)

    monkeypatch.setattr(storage, "write_once", late)
    wide.upsert(spark.createDataFrame([(3, 1, "mine")], SHAPE))
    assert {r.k: r.name for r in wide.read().collect()} == {1: "a", 2: "other", 3: "mine"}
    raced.clear()
    # A batch that comes during a compaction stays behind the merged folder.
    assert wide.compact(everything=True) == 3
    assert [f.rows for f in wide.manifest().folders] == [3, 1]
    assert {r.k: r.name for r in wide.read().collect()} == {1: "a", 2: "other", 3: "mine"}


def test_a_token_is_applied_once(spark, folder):
    wide = table(spark, folder)
    batch = spark.createDataFrame([(1, 1, "a")], SHAPE)
    assert [wide.upsert(batch, "stream", t) for t in (0, 0, 1, 0)] == [1, 0, 1, 0]
    assert wide.upsert(batch, "another", 0) == 1 and wide.manifest().tokens == {"stream": 1, "another": 0}


def test_folders_of_like_size():
    sized = lambda *rows: [Folder(str(k), r) for k, r in enumerate(rows)]
    assert versioned.like_size(sized(100, 10, 1)) == 2
    assert versioned.like_size(sized(100, 10, 10)) == 1
    assert versioned.like_size(sized(100, 30, 10)) == 0
    assert versioned.like_size(sized(1, 1, 1, 1)) == 0 and versioned.like_size([]) == 0


def test_reading_leaves_out_replaced_rows_without_moving_whole_rows(spark, folder):
    pairs = VersionedTable(spark, f"{folder}/t", ("k", "part"), ("v", "w"))
    shape = "k bigint, part string, v int, w string, name string"
    old = [(1, "a", 1, None, "old"), (1, None, 1, "x", "old"), (None, None, 1, "x", "old"), (2, "a", None, None, "old"), (3, "a", 5, "x", "stays")]
    pairs.upsert(spark.createDataFrame(old, shape))
    pairs.upsert(spark.createDataFrame([(1, "a", 1, "x", "new"), (None, None, 1, "x", "tie"), (2, "a", None, None, "tie"), (3, "a", 4, "z", "late")], shape))
    pairs.upsert(spark.createDataFrame([(1, None, None, None, "late"), (1, "a", 2, None, "newest"), (4, "a", 1, "x", "first")], shape))
    read = pairs.read()
    assert sorted(((r.k or 0, r.part or "", r.name) for r in read.collect())) == [
        (0, "", "tie"), (1, "", "old"), (1, "a", "newest"), (2, "a", "tie"), (3, "a", "stays"), (4, "a", "first")]
    plan = read._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "LeftAnti, BuildRight" in plan
    # Names are read once for each folder, by the scan that the anti join filters, and by no other.
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum("name" in line.split("ReadSchema")[1] for line in scans) == 3 and len(scans) > 3
