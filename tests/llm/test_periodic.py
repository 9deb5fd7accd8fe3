from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from salesloom.llm import common, periodic
from salesloom.llm.queries import QUERIES
from tests.conftest import DATA


def plain_runs(words, least_words=6, exponent=4):
    """Every maximal stretch of each period, the smallest period of each stretch only."""
    found = {}
    n = len(words)
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j + q - i
                if length >= 2 * q:
                    found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(least_words, exponent * q))


def plain_row(doc_id, text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in text or "").split(" ") if w]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return {
        "n_runs": len(runs), "start": best and best[0], "length": best and best[1], "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        "collapsed_sha256": digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    }


def test_runs_equal_brute_force_on_random_words():
    chance = random.Random(3)
    texts = []
    for k in range(400):
        text = [chance.randrange(1 + k % 5) for _ in range(chance.randrange(60))]
        if k % 3 == 0:
            root = [chance.randrange(3) for _ in range(chance.randrange(1, 7))]
            at = chance.randrange(len(text) + 1)
            text[at:at] = (root * 9)[: chance.randrange(40)]
        texts.append(text)
    for least, exponent in ((6, 4), (2, 2), (5, 3)):
        found = periodic.runs_of([np.array(t, np.int64) for t in texts], least, exponent)
        assert [sorted(r) for r in found] == [plain_runs(t, least, exponent) for t in texts]


def test_fibonacci_words_and_one_long_run():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    long = np.zeros(150_000, np.int64)
    found = periodic.runs_of([np.array(b), long, np.tile(np.arange(900), 60)], 2, 2)
    assert sorted(found[0]) == plain_runs(b, 2, 2)
    assert found[1] == [(0, 150_000, 1)] and found[2] == [(0, 54_000, 900)]
    assert periodic.floor_of(6, 4) == 5


def test_defined_cases(spark):
    common.prepared(spark)
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (4, "a b c", "x"), (None, "x " * 30, "x"), (5, "p q " * 9 + "z", "x"),
            (5, "p q " * 9 + "z", "x"), (6, "né  " * 8, "x"), (7, "u v w u v w a a a a a a a u v", "x"), (8, "ab " * 40_000, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_runs string")
    for prepare in (None, periodic.with_period):
        found = periodic.periodic(frame, prepare=prepare).collect()
        assert len(found) == len(rows)
        for r in found:
            if r["n_words"] < 1000:
                given = next(t for i, t, _ in rows if i == r["doc_id"])
                want = plain_row(r["doc_id"] if prepare else None, given)
                assert {k: r[k] for k in want} == want
            assert hashlib.sha256(r["collapsed"].encode()).hexdigest() == r["collapsed_sha256"]
    assert periodic.periodic(frame.limit(0)).count() == 0


def test_query_equals_plain_python(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = QUERIES["op12_periodic_runs"](spark, DATA).collect()
    assert len(found) == len(texts)
    checked = 0
    for r in found:
        if len(texts[r["doc_id"]]) < 12_000:
            want = plain_row(r["doc_id"], texts[r["doc_id"]])
            assert {k: r[k] for k in want} == want
            checked += r["n_runs"] > 0
    assert checked > 10
