from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from salesloom.llm import common, toxicity
from tests.conftest import DATA


def maximal(scores, begin=0):
    """All maximal scoring segments by their definition: the best segment, then the same left and right of it."""
    best = (0.0, 0, 0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            total = sum(scores[i:j])
            if total > best[0] + 1e-9:
                best = (total, i, j)
    if best[0] <= 0:
        return []
    _, i, j = best
    return maximal(scores[:i], begin) + [(begin + i, begin + j)] + maximal(scores[j:], begin + j)


def test_scan_finds_all_maximal_segments():
    chance = np.random.default_rng(6)
    for _ in range(150):
        scores = chance.normal(-0.2, 1, chance.integers(0, 18))
        found = toxicity.maximal_segments(scores)
        assert [(s, e) for s, e, _ in found] == maximal(scores.tolist())
        assert all(abs(scores[s:e].sum() - x) < 1e-9 for s, e, x in found)


def test_decay_rate_solves_its_equation():
    counts = np.zeros(toxicity.BINS)
    values = toxicity.LOWEST + toxicity.BIN * (np.arange(toxicity.BINS) + 0.5)
    counts[np.searchsorted(values, -1.0)], counts[np.searchsorted(values, 1.0)] = 90, 10
    rate = toxicity.decay_rate(counts)
    assert abs((counts / 100 * np.exp(rate * values)).sum() - 1) < 1e-6
    assert toxicity.decay_rate(np.zeros(toxicity.BINS)) == 1.0


def fixture(spark):
    rows, labels = [], []
    for k in range(200):
        words = [f"w{chr(97 + (k * 7 + j) % 26)}{chr(97 + j % 13)}" for j in range(30)]
        if k % 5 == 0:
            words[10:12] = ["vilething", "vileperson"]
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(k % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_passages_and_unseen_words_of_a_known_stem(spark):
    common.prepared(spark)
    documents, labels = fixture(spark)
    model = toxicity.learn(documents, labels, F.lit(True))
    texts = [("a b vilething vileperson c d",), ("good words only here",), ("so vilest",), (None,), ("",)]
    frame = spark.createDataFrame(texts, "text string")
    found = [r["f"] for r in frame.select(toxicity.scanned(spark, model, F.col("text")).alias("f")).collect()]
    assert [(p["start"], p["end"]) for p in found[0]["passages"]] == [(2, 4)]
    assert found[0]["score"] > 0.3 and found[2]["score"] > 0.3
    assert found[1]["score"] < 0.3 and found[1]["passages"] == []
    assert found[3] == found[4] and 0 <= found[3]["score"] < 0.3


def test_without_labels_of_both_kinds(spark):
    common.prepared(spark)
    documents, labels = fixture(spark)
    for some, base in ((labels.limit(0), 0.0), (labels.filter("toxic = 1"), 1.0), (labels.filter("toxic = 0"), 0.0)):
        model = toxicity.learn(documents, some, F.lit(True))
        assert not model.fitted and model.score(0.0) == base
    doubled = labels.union(labels).union(spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, toxic int"))
    assert toxicity.learn(documents, doubled, F.lit(True)).base == 0.2
    assert documents.limit(0).select(toxicity.scanned(spark, model, F.col("text")).alias("f")).count() == 0


def test_held_out_accuracy(spark):
    from salesloom.llm.queries import QUERIES

    found = QUERIES["op8_toxicity"](spark, DATA.replace("sf0.001", "sf0.1"))
    labels = spark.read.parquet(f"{DATA.replace('sf0.001', 'sf0.1')}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)
