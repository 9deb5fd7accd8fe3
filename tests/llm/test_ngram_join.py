from __future__ import annotations

import random

import pytest

from salesloom.llm import common, components, ngram_join


def brute(rows, rule):
    """Smallest id in reach for every id, by comparing all pairs."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = rule.words
        sets[i] = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= rule.percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def family(chance, words, copies, changes):
    base = [chance.choice(words) for _ in range(chance.randint(20, 90))]
    out = [" ".join(base)]
    for _ in range(copies):
        copy = list(base)
        for _ in range(chance.randint(0, changes)):
            copy[chance.randrange(len(copy))] = chance.choice(words)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_equals_brute_force(spark, words, percent):
    common.prepared(spark)
    chance = random.Random(words)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(12):
        texts += family(chance, vocabulary, chance.randint(0, 12), 5)
    passage = " ".join(chance.choice(vocabulary) for _ in range(15))
    texts += [f"{passage} {' '.join(chance.choice(vocabulary) for _ in range(30))}" for _ in range(25)]
    texts += ["", None, " \t\n", "one", "ONE", "one two", "a b c", "A  B\x0bC", "a b c d", "a b c d e", "a b c d e f g", "a b c d e f g h"]
    rows = list(enumerate(texts))
    chance.shuffle(rows)
    rule = ngram_join.Rule(words, percent)
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n string").repartition(5)
    found = {r["doc_id"]: (r["n"], r["component"]) for r in ngram_join.classes(frame, rule).collect()}
    assert found == brute(rows, rule)


def test_sets_equal_plain_python(monkeypatch):
    chance = random.Random(1)
    parts = ["a", "b", "C", " ", " ", "\n", "\t", "\x0b", "é", "\u00a0", "\x1c", "w" * 300, "", "😀"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 40))) for _ in range(300)] + [None, "", "a"]
    wanted = []
    for text in texts:
        words = (text or "").encode().lower().split()
        wanted.append({tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set())
    for size in (50, 4_000_000):
        monkeypatch.setattr(ngram_join, "CHUNK_BYTES", size)
        found = ngram_join.ngram_sets(texts, 3)
        assert [len(f) for f in found] == [len(w) for w in wanted]
        names = {}
        for hashes, grams, text in zip(found, wanted, texts):
            for other, theirs in list(names.values())[-40:]:
                assert len(set(hashes.tolist()) & other) == len(grams & theirs)
            names[text] = set(hashes.tolist()), grams


def test_chain_of_near_copies_is_one_component(spark):
    common.prepared(spark)
    words = [f"c{k}" for k in range(140)]
    rows = [(k, " ".join(words[k : k + 60])) for k in range(60)]
    rule = ngram_join.Rule(4, 85)
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), rule).collect()
    assert {r["component"] for r in found} == {0} == {c for _, c in brute(rows, rule).values()}


def test_repeated_rows_null_ids_and_empty_table(spark):
    common.prepared(spark)
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "a b c d e"), (None, None), (5, "other words are in here")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(((r["doc_id"], r["n"], r["component"]) for r in ngram_join.classes(frame, ngram_join.Rule()).collect()), key=str)
    assert found == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 2, 1), (None, 0, None), (5, 2, 5)], key=str)
    assert ngram_join.classes(frame.limit(0), ngram_join.Rule()).count() == 0


def test_components_equal_union_find(spark):
    common.prepared(spark)
    chance = random.Random(5)
    edges = [(chance.randrange(400), chance.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1040)] + [(7, 7)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = components.components(spark.createDataFrame(edges, "x bigint, y bigint"))
    assert {r["id"]: r["component"] for r in found.collect()} == {i: root(i) for i in parent}
    assert components.components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_words_in_windows(monkeypatch):
    chance = random.Random(8)
    texts = [" ".join("x" * chance.choice((1, 3, 30, 90, 300)) + str(chance.randrange(9)) for _ in range(chance.randint(0, 40))) for _ in range(60)]
    plain = [set(f.tolist()) for f in ngram_join.ngram_sets(texts, 2)]
    monkeypatch.setattr(ngram_join, "WINDOW_BYTES", 512)
    ngram_join._powers.cache_clear()
    try:
        assert [set(f.tolist()) for f in ngram_join.ngram_sets(texts, 2)] == plain
    finally:
        ngram_join._powers.cache_clear()
    long = " ".join(f"w{k % 9000}" for k in range(200_000))
    (found,) = ngram_join.ngram_sets([long], 4)
    assert len(found) == 9000


def numbered(prefix, n, changed=()):
    return " ".join(f"other{k}" if k in changed else f"{prefix}{k}" for k in range(n))


@pytest.mark.parametrize("a,b", [("a", "b"), ("b", "a"), ("q", "c")])
def test_all_texts_of_an_id_are_compared(spark, a, b):
    common.prepared(spark)
    first, second = numbered(a, 60), numbered(b, 60)
    rows = [(1, first), (1, second), (2, numbered(b, 60, (59,))), (3, numbered(a, 60, (0,))), (4, numbered("z", 60))]
    rows += [(5, second), (6, numbered("y", 30)), (7, numbered("x", 30)), (6, numbered("x", 30)), (None, first)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component"] for r in ngram_join.classes(frame, ngram_join.Rule()).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 6, 7: 6, None: None}
    kept = sorted(map(str, (tuple(r) for r in ngram_join.one_of_each(frame.repartition(3), ngram_join.Rule()).collect())))
    want = [(1, first), (1, second), (4, numbered("z", 60)), (6, numbered("y", 30)), (6, numbered("x", 30)), (None, first)]
    assert kept == sorted(map(str, want))


def test_one_row_of_each_group_stays(spark):
    common.prepared(spark)
    text = numbered("a", 40)
    rows = [(3, text), (3, text), (3, text.upper()), (2, text + " "), (2, text + " "), (4, None), (4, None), (5, " "), (None, text), (None, text), (6, "one two")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, key string")
    found = ngram_join.one_of_each(frame, ngram_join.Rule(5, 80))
    assert found.columns == frame.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in found.collect() if r["text"]) == sorted(
        [("2", text + " "), ("5", " "), ("None", text), ("None", text), ("6", "one two")]
    )
    assert found.filter("text is null").count() == 2
    assert ngram_join.one_of_each(frame.limit(0), ngram_join.Rule()).count() == 0
