from __future__ import annotations

import math
from collections import Counter

import numpy as np

from salesloom.llm import common, languages
from tests.conftest import DATA


def grams(texts):
    found = Counter()
    for buckets, owner in languages.hashed_ngrams(texts):
        found.update(zip(owner.tolist(), buckets.tolist()))
    return found


def test_pieces_of_a_long_text_lose_no_ngram(monkeypatch):
    texts = ["abc dé " * 40, None, "", "x", "漢字 kanji", "12 34", "short", "ab" * 33]
    whole = grams(texts)
    for size in (3, 7, 64):
        monkeypatch.setattr(languages, "PIECE_CHARS", size)
        assert grams(texts) == whole


def test_ngrams_match_plain_python():
    text = "Ab, cd"
    clean = " ab  cd "
    want = sum(any(c.isalpha() for c in clean[k : k + n]) for n in languages.ORDERS for k in range(len(clean) - n + 1))
    assert sum(grams([text]).values()) == want


def test_posterior_matches_plain_naive_bayes(spark):
    common.prepared(spark)
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the end", "en"), (None, "fr"), ("x", None)]
    model = languages.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.labels == ("de", "en")
    text = "the hund"
    scores = []
    for label in model.labels:
        counts = Counter()
        for t, g in rows:
            if g == label:
                counts.update({b: n for (_, b), n in grams([t]).items()})
        total = sum(counts.values()) + languages.SMOOTHING * (1 << languages.BUCKET_BITS)
        prior = (1 + sum(g == label for t, g in rows if t) - 1) / 3
        scores.append(math.log(prior) + sum(n * math.log((counts[b] + languages.SMOOTHING) / total) for (_, b), n in grams([text]).items()))
    want = np.exp(scores - np.max(scores))
    want = want / want.sum()
    name, share = model.predict([text])
    assert name == [model.labels[int(want.argmax())]]
    assert abs(share[0] - want.max()) < 1e-9


def test_defined_cases(spark):
    common.prepared(spark)
    empty = languages.learn(spark.createDataFrame([], "text string, lang string"))
    assert empty.predict(["abc", None]) == (["und", "und"], [0.0, 0.0])
    model = languages.learn(spark.createDataFrame([("ab", "en")], "text string, lang string"))
    assert model.predict([None, "", "12 !", "q"]) == (["und", "und", "und", "en"], [0.0, 0.0, 0.0, 1.0])


def test_held_out_accuracy(spark):
    from salesloom.llm.queries import QUERIES

    found = QUERIES["op1_language_id"](spark, DATA)
    lang = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
