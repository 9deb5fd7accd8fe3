from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from salesloom.llm import common, personal_data

FORMS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base(text):
    out = []
    for kind, form in FORMS:
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def base_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = personal_data.by_document(frame)
    only = F.filter("spans", lambda s: s["kind"] < len(personal_data.KINDS))
    return {r["doc_id"]: r["s"] for r in found.select("doc_id", personal_data.written_spans(only).alias("s")).collect()}


def test_base_equals_plain_expressions(spark):
    common.prepared(spark)
    chance = random.Random(3)
    parts = ["a@b.c", "_d@e.f", "x.y@", "@q.r", "1.2.3.4", "256.1.1.1", "0255.1.2.3.4.5.6.7", "4111 1111 1111 1111", "4111111111111112",
             "+1 (555) 010-0000", "+12", "++1-2.3", " ", ".", "-", "é", "😀", "\n", "7", "a", "@", "5500005555555559"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 14))) for _ in range(500)]
    texts += ["", None, "😀 a@b.c", "a@b.c" * 3, "1" * 30, "4111 1111-1111 1111"]
    found = base_of(spark, texts)
    for i, text in enumerate(texts):
        assert found[i] == ",".join(base(text or "")), repr(text)


def test_very_long_runs_take_linear_time(spark):
    common.prepared(spark)
    texts = ["9" * 200_000, "a" * 200_000 + "@", "a@b" + ".c" * 50_000, "1." * 50_000, "+" + "1 " * 50_000, "- " * 100_000 + "1"]
    found = base_of(spark, texts)
    assert found[2] == f"email:0:{3 + 100_000}" and found[0] == "" and found[1] == ""


def test_contexts_discover_unseen_identifiers(spark):
    common.prepared(spark)
    rows = [(k, f"please write to card {n} today friend") for k, n in enumerate(
        ["4111111111111111", "5500005555555559", "4012888888881881", "5105105105105100", "4222222222222220", "4000056655665556"])]
    rows.append((90, "please write to card 4111111111111119 today friend"))
    rows.append((91, "chapter 4111111111111118 ends"))
    found = {r["doc_id"]: r["s"] for r in personal_data.by_document(spark.createDataFrame(rows, "doc_id bigint, text string")).select(
        "doc_id", personal_data.written_spans(F.col("spans")).alias("s")).collect()}
    assert found[90] == "other:21:37"
    assert found[91] == ""


UNSEEN = ["GB29NWBK60161331926819", "4111 1111 1111 1112", "PASS-8841-XK", "a.b-77.cd", "(743) 555-3824"]


def discoveries(rows, known_rows):
    """The graph in plain Python: rows are (value, before, behind, shape, seed)."""
    accepted = set()
    for _ in range(personal_data.ROUNDS):
        members, sides = {}, {}
        for value, before, behind, shape, seed in rows:
            for side, words in enumerate(((before,), (behind,), (before, behind))):
                for pattern in ((side, *words), (side, *words, "shape", shape)):
                    members.setdefault(pattern, {})[value] = seed or members.get(pattern, {}).get(value, False)
                    sides.setdefault(value, set()).add((side, pattern))
        strength = {}
        for pattern, values in members.items():
            hits = sum(seed or v in accepted for v, seed in values.items())
            if known_rows <= hits < len(values):
                strength[pattern] = hits / (len(values) + 1)
        fresh = set()
        for value, patterns in sides.items():
            best = {}
            for side, pattern in patterns:
                if pattern in strength and not members[pattern][value]:
                    best[side] = max(best.get(side, 0), strength[pattern])
            rest = 1.0
            for confidence in best.values():
                rest *= 1 - confidence
            if len(best) >= personal_data.LEAST_PATTERNS and 1 - rest >= personal_data.ACCEPT:
                fresh.add(value)
        accepted = fresh
    return accepted


def test_identifiers_of_any_form_are_found_by_their_context(spark):
    common.prepared(spark)
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "5105105105105100", "4222222222222220", "4000056655665556"]
    rows = [(k, f"please write to card {n} today friend") for k, n in enumerate(cards + UNSEEN)]
    rows += [(50, "chapter 12.44.6 of the book"), (51, "in the year 2024-10-11 it rained")]
    found = {r["doc_id"]: r["s"] for r in personal_data.by_document(spark.createDataFrame(rows, "doc_id bigint, text string")).select(
        "doc_id", personal_data.written_spans(F.col("spans")).alias("s")).collect()}
    for k, value in enumerate(UNSEEN, len(cards)):
        assert found[k] == f"other:21:{21 + len(value)}", value
    assert found[50] == found[51] == ""


def test_discovery_equals_plain_graph(spark):
    common.prepared(spark)
    chance = random.Random(11)
    befores, behinds, values = ["to", "card", "no", "the"], ["now", "please", "end"], [f"{'ab' * (k % 3)}{1000 + k}" for k in range(40)]
    rows = []
    for _ in range(260):
        value = chance.choice(values)
        seed = int(value[-2:]) % 5 != 0
        plain = seed or chance.random() < 0.7
        words = (chance.choice(befores[:3]), chance.choice(behinds[:2])) if plain else (befores[3], behinds[2])
        rows.append((value, *words, seed))
    frame = spark.createDataFrame([(4 if not s else 2, v, f"x {b} ", f" {a} y", s) for v, b, a, s in rows], "kind int, match string, before string, behind string, known boolean")
    found = {r["value"] for r in personal_data.discovered(frame).collect()}
    hashes = {r["h"]: r["v"] for r in spark.createDataFrame([(v,) for v in values], "v string").select("v", F.xxhash64("v").alias("h")).collect()}
    shape = lambda v: re.sub("[a-z]+", "a", re.sub("[0-9]+", "9", v))
    want = discoveries([(v, b, a, shape(v), s) for v, b, a, s in rows], personal_data.LEAST_KNOWN)
    assert {hashes[h] for h in found} == want and want


def test_redaction_and_defined_cases(spark):
    common.prepared(spark)
    rows = [(1, "é😀 a@b.c!", "k"), (1, "é😀 a@b.c!", "k"), (2, None, "k"), (None, "mail a@b.c 1.2.3.4", "k"), (4, "clean", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    found = personal_data.redacted(frame)
    assert found.columns == frame.columns
    texts = sorted((str(r["doc_id"]), r["text"]) for r in found.collect() if r["text"] is not None)
    assert texts == [("1", "é😀 [EMAIL]!"), ("1", "é😀 [EMAIL]!"), ("4", "clean"), ("None", "mail [EMAIL] [IP]")]
    assert found.count() == 5
    assert personal_data.redacted(frame.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["4111111111111111 a 4111111111111111@x.yz", "4111111111111111.1.2.3.4 +1 555 010 0000 1"])
def test_overlapping_kinds_are_masked_once(spark, text):
    common.prepared(spark)
    found = personal_data.redacted(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["text"]
    assert not re.search("[0-9]{3}", found)
