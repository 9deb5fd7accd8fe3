from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from salesloom.llm import common, multi_index

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def nearest(rows, query, k=5):
    """Brute force: cosine in double precision, ties to the smaller id."""
    vectors = {i: np.array(v, float) for i, v in rows}
    q = vectors[query]
    scored = sorted((-(q @ v) / np.sqrt((q @ q) * (v @ v)), i) for i, v in vectors.items() if i != query)
    return [(i, -s) for s, i in scored[:k]]


def test_recall_and_scores_against_brute_force(spark):
    common.prepared(spark)
    chance = np.random.default_rng(4)
    centres = chance.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.4 * chance.normal(size=16)).astype(np.float32).tolist()) for k in range(1200)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = {}
    for r in multi_index.search(frame, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for query in range(0, 1200, 50):
        mine = sorted(found[query])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        want = dict(nearest(rows, query))
        hits += sum(i in want for _, i, _ in mine)
        every = dict(nearest(rows, query, 1200))
        assert all(abs(every[i] - s) < 1e-12 for _, i, s in mine)
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)
    assert hits / (24 * 5) >= 0.9


def test_equal_vectors_ties_and_bad_vectors(spark):
    common.prepared(spark)
    rows = [(k, [1.0, 2.0, 0.5, 1.0], "x") for k in range(0, 60)]
    rows += [(100 + k, [2.0 + k, -1.0, 0.5, 1.0], "x") for k in range(5)]
    rows += [(200, None, "x"), (201, [0.0] * 4, "x"), (202, [1.0, None, 0.0, 0.0], "x"), (203, [float("nan"), 1.0, 0.0, 0.0], "x"),
             (204, [float("inf"), 1.0, 0.0, 0.0], "x"), (205, [1.0], "x"), (None, [1.0, 2.0, 0.5, 1.0], "x"), (7, [1.0, 2.0, 0.5, 1.0], "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = multi_index.search(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in found if r["query_id"] == 0] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in found if r["query_id"] == 50] == [0, 1, 2, 3, 4]
    assert {r["query_id"] for r in found} == {0, 50, 100}
    assert all(r["score"] == 1.0 or r["query_id"] == 100 for r in found)


def test_few_or_no_rows(spark):
    common.prepared(spark)
    frame = spark.createDataFrame([(0, [1.0, 0.0], "x"), (3, [0.0, 1.0], "x"), (4, [1.0, 1.0], "x")], SCHEMA)
    found = multi_index.search(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 4), (2, 3)]
    assert multi_index.search(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert multi_index.search(frame.filter("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def test_traversal_order():
    first, second = np.array([0.3, 0.1, 0.9]), np.array([0.2, 0.0])
    cells = multi_index.nearest_cells(first, second, np.ones(6, int), 6)
    sums = [first[c // 2] + second[c % 2] for c in cells]
    assert sorted(cells) == list(range(6)) and sums == sorted(sums)
    assert multi_index.nearest_cells(first, second, np.array([0, 0, 5, 0, 1, 9]), 6) == [2, 5]
