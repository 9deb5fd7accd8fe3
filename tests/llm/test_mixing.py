from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from salesloom.llm import common, mixing


def corpus(spark):
    rows, labels = [], []
    for k in range(120):
        kind = k % 4 == 0
        rows.append((k, " ".join((["junk!!", "spam!!"] if kind else ["plain", "word", "text"]) * (3 + k % 7)), "x"))
        if k % 3 == 0:
            labels.append((k, 0 if kind else 1, 0))
    rows += [(5, rows[5][1], "x"), (500, None, None), (None, "plain word", "y"), (501, "", "z")]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, rate string"),
        spark.createDataFrame(labels + [(None, 1, 0), (3, None, 1)], "doc_id bigint, quality int, toxic int"),
    )


def test_expected_totals_reach_the_targets(spark):
    common.prepared(spark)
    documents, labels = corpus(spark)
    weights = {"q1t0": 0.9, "q0t0": 0.1}
    names, members = mixing.memberships(documents, mixing.domains_of(labels))
    found, sums = mixing.fitted(members, names, weights, "q1t0")
    rows = found.collect()
    assert names == ["q0t0", "q1t0"]
    assert all(r["rate"] >= 0 for r in rows)
    reached = sum(np.array(r["p"]) * r["rate"] * r["n"] * r["copies"] for r in rows)
    assert np.allclose(reached, sums["targets"], rtol=1e-4, atol=1e-3)
    assert abs(sums["targets"][0] / sums["targets"].sum() - 0.1) < 1e-9
    assert abs(sums["targets"][1] - sums["totals"][1]) < 1e-6


def test_posteriors_follow_the_labels_and_stay_soft(spark):
    common.prepared(spark)
    documents, labels = corpus(spark)
    names, members = mixing.memberships(documents, mixing.domains_of(labels))
    for r in members.collect():
        assert abs(sum(r["p"]) - 1) < 1e-9
        if r["doc_id"] is not None and r["doc_id"] < 120:
            assert (r["p"][names.index("q0t0")] > 0.5) == (r["doc_id"] % 4 == 0)
            assert 0 < min(r["p"])
    twice = members.filter("doc_id = 5").first()
    assert (twice["copies"], twice["n"]) == (2, 24)
    assert members.filter("doc_id = 500").first()["n"] == 0


def test_impossible_targets_stay_nonnegative(spark):
    common.prepared(spark)
    documents, labels = corpus(spark)
    names, members = mixing.memberships(documents, mixing.domains_of(labels))
    found, sums = mixing.fitted(members, names, {"q1t0": 1.0, "q0t0": 0.0}, "q1t0")
    assert found.agg(F.min("rate")).first()[0] >= 0
    assert sums["reached"][0] < 0.02 * sums["totals"][0] + 1


def nearest_in_cone(rows, target, metric):
    """The totals nearest to the target that nonnegative rates can give, for two domains: the target itself inside the cone of the
    documents' vectors, or its projection on an edge."""
    vectors = [np.array(r["p"]) for r in rows if r["n"]]
    edges = [min(vectors, key=lambda v: v[0] / v.sum()), max(vectors, key=lambda v: v[0] / v.sum())]
    inside = np.linalg.solve(np.array(edges).T, target)
    if (inside >= 0).all():
        return target
    ends = [max(0.0, (e @ metric @ target) / (e @ metric @ e)) * e for e in edges]
    return min(ends, key=lambda x: (x - target) @ metric @ (x - target))


def test_totals_equal_those_of_a_second_solver(spark):
    common.prepared(spark)
    documents, labels = corpus(spark)
    names, members = mixing.memberships(documents, mixing.domains_of(labels))
    members = common.written(members, "test-members")
    rows = members.collect()
    mass = [r["n"] * r["copies"] for r in rows]
    gram = sum(m * np.outer(r["p"], r["p"]) for m, r in zip(mass, rows))
    metric = np.linalg.inv(gram)
    for weights in ({"q1t0": 0.9, "q0t0": 0.1}, {"q1t0": 0.5, "q0t0": 0.5}, {"q1t0": 1.0, "q0t0": 0.0}):
        _, sums = mixing.fitted(members, names, weights, "q1t0")
        best = nearest_in_cone(rows, sums["targets"], metric)
        assert np.abs(sums["reached"] - best).max() <= 1e-3 * sums["targets"].sum(), weights


def test_steps_in_blocks_change_nothing(spark, monkeypatch):
    common.prepared(spark)
    documents, labels = corpus(spark)
    names, members = mixing.memberships(documents, mixing.domains_of(labels))
    members = common.written(members, "test-members")
    rates = []
    for block in (2, 10):
        monkeypatch.setattr(mixing, "REPLAY", block)
        found, _ = mixing.fitted(members, names, {"q1t0": 0.97, "q0t0": 0.03}, "q1t0")
        rates.append([r["rate"] for r in found.orderBy("doc_id", "key").collect()])
    assert np.allclose(*rates)


def test_mixed_keeps_columns_and_copies_follow_rates(spark):
    common.prepared(spark)
    documents, labels = corpus(spark)
    found = mixing.mixed(documents, mixing.domains_of(labels), {"q1t0": 0.95, "q0t0": 0.05}, "q1t0")
    assert found.columns == documents.columns
    ids = [r["doc_id"] for r in found.collect()]
    assert ids.count(5) == 2 and 500 in ids and None in ids
    clean = [k for k in range(120) if k % 4]
    assert sum(k in ids for k in clean) >= 0.95 * len(clean)
    assert sum(k % 4 == 0 for k in ids if k is not None and k < 120) < 30


def test_without_labels_or_rows(spark):
    common.prepared(spark)
    documents, labels = corpus(spark)
    names, found = mixing.rates(documents, mixing.domains_of(labels.limit(0)), {"q1t0": 1.0})
    assert names == ["all"] and {r["rate"] for r in found.collect()} == {1.0}
    names, found = mixing.rates(documents.limit(0), mixing.domains_of(labels), {"q1t0": 1.0})
    assert found.count() == 0


def test_copies_have_the_rate_as_mean(spark):
    rows = spark.range(20000).select(mixing.copies_of(F.lit(1.3), F.col("id")).alias("c"))
    assert abs(rows.agg(F.avg("c")).first()[0] - 1.3) < 0.02
