from __future__ import annotations

import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from salesloom.llm import common, masked_lm
from salesloom.llm.queries import QUERIES
from tests.conftest import DATA


def test_probabilities_sum_to_one():
    network = masked_lm.WindowNetwork()
    around = np.array([[1, 2, 3, 4]])
    every = np.arange(masked_lm.SIZE)
    logs = network.log_probabilities(np.repeat(around, len(every), axis=0), every)
    assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_gradients_equal_differences():
    chance = np.random.default_rng(2)
    network = masked_lm.WindowNetwork()
    around, targets = chance.integers(0, masked_lm.SIZE, (40, 4)), chance.integers(0, masked_lm.SIZE, 40)
    _, grads = network.gradients(around, targets)
    for name, gradient in grads.items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        losses = []
        for move in (1e-2, -1e-2):
            other = masked_lm.WindowNetwork(network.flat)
            other.parts[name][at] += move
            losses.append(-other.log_probabilities(around, targets).mean())
        assert abs((losses[0] - losses[1]) / 2e-2 - gradient[at]) < 2e-3, name


def test_scores_are_sums_over_tokens(monkeypatch):
    monkeypatch.setattr(masked_lm, "SCORE_BATCH", 7)
    vocabulary, network = masked_lm.Vocabulary(["the", "cat"]), masked_lm.WindowNetwork()
    texts = ["The cat sat on the mat", "", "x", "the cat " * 11]
    encoded = [vocabulary.ids(t) for t in texts]
    assert [len(i) for i in encoded] == [6, 0, 1, 22]
    sums = masked_lm.score_ids(network, encoded)
    for text, total in zip(texts, sums):
        ids = [0, 0, *vocabulary.ids(text).tolist(), 0, 0]
        want = sum(
            network.log_probabilities(np.array([[ids[k - 2], ids[k - 1], ids[k + 1], ids[k + 2]]]), np.array([ids[k]]))[0]
            for k in range(2, len(ids) - 2)
        )
        assert abs(total - want) < 1e-3


def test_rounds_train_on_every_position(monkeypatch):
    trained = Counter()

    def count(network, rows):
        trained.update(k for _, targets in rows for k in targets.tolist())
        return 0

    monkeypatch.setattr(masked_lm, "train_on", count)
    words = [f"w{k}" for k in range(60)]
    vocabulary = masked_lm.Vocabulary(words)
    texts = [" ".join(words[:41]), words[41], "", " ".join(words[42:45]), " ".join(words[45:])]
    ids = [vocabulary.ids(t).astype(np.uint16).tobytes() for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array([k % masked_lm.ROUNDS for k in range(len(ids))]), pa.array(ids, pa.binary())], ["phase", "ids"])
    for round_ in range(masked_lm.ROUNDS):
        shared = SimpleNamespace(value=masked_lm.WindowNetwork().flat)
        assert not list(masked_lm._trainer(shared, round_)(iter([batch])))
    assert trained == Counter(range(1, 61))


def test_words_of_one_bucket_have_their_own_probability(spark, folder):
    buckets = {}
    for k in range(300):
        buckets.setdefault(zlib.crc32(b"r%d" % k) % (masked_lm.SIZE - 1 - masked_lm.WORDS), []).append(f"r{k}")
    x, y = next(words for words in buckets.values() if len(words) > 1)[:2]
    rows = [(1, " ".join(f"f{k}" for k in range(masked_lm.WORDS) for _ in range(4)))]
    rows += [(2, f"f0 f1 {x} f2 f3"), (3, f"f0 f1 {y} f2 f3"), (4, x), (5, x), (None, "f0"), (6, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    found = {r["doc_id"]: r for r in QUERIES["op4_masked_lm"](spark, folder).collect()}
    assert len(found) == len(rows)
    assert abs(found[2]["log_likelihood"] - found[3]["log_likelihood"] - np.log(3)) < 1e-4
    assert found[6]["log_likelihood"] == 0 and found[6]["per_token"] is None


def test_learning_helps_on_texts_it_has_not_seen(spark):
    common.prepared(spark)
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    seen, unseen = documents.filter("doc_id % 5 <> 0"), [r["text"] for r in documents.filter("doc_id % 5 = 0").collect()]
    vocabulary, values = masked_lm.learn(seen)
    ids = [vocabulary.ids(t or "") for t in unseen]
    gain = sum(masked_lm.score_ids(masked_lm.WindowNetwork(values), ids)) - sum(masked_lm.score_ids(masked_lm.WindowNetwork(), ids))
    assert gain / sum(map(len, ids)) > 0.3


def test_defined_cases(spark):
    common.prepared(spark)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    vocabulary, values = masked_lm.learn(empty)
    assert np.array_equal(values, masked_lm.WindowNetwork().flat)
    rows = spark.createDataFrame([(1, None, 2), (1, None, 2), (None, "", 0), (3, "a b " * 50_000, 1)], "doc_id bigint, text string, n_tokens int")
    found = masked_lm.likelihoods(rows).collect()
    assert sorted(r["n_tokens"] for r in found) == [0, 0, 0, 100_000]
    assert all(r["log_likelihood"] == 0 for r in found if not r["n_tokens"])
    assert masked_lm.likelihoods(empty).count() == 0


def test_likelihoods_equal_plain_sums(spark):
    """End to end against the network applied word by word and shares counted in plain Python."""
    common.prepared(spark)
    documents = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    texts = {r["doc_id"]: (r["text"] or "").lower().split() for r in documents.collect()}
    vocabulary, values = masked_lm.learn(documents)
    network = masked_lm.WindowNetwork(values)
    counts = Counter(w for words in texts.values() for w in words)
    rare = {w: zlib.crc32(w.encode()) % (masked_lm.SIZE - 1 - masked_lm.WORDS) for w in counts if w not in vocabulary.known}
    totals = Counter()
    for w, bucket in rare.items():
        totals[bucket] += counts[w]
    for r in masked_lm.likelihoods(documents).collect():
        words = texts[r["doc_id"]]
        want = masked_lm.score_ids(network, [vocabulary.ids(" ".join(words))])[0]
        want += sum(np.log(counts[w] / totals[rare[w]]) for w in words if w in rare)
        assert r["n_tokens"] == len(words) and abs(r["log_likelihood"] - want) < 1e-3 * max(1, len(words))


def test_runs_hold_every_token(monkeypatch):
    monkeypatch.setattr(masked_lm, "CHUNK_CHARS", 60)
    texts = ["The cat sat", "", "the the mat", "x " * 40, "last one", " ".join(f"w{k}" for k in range(70_000)) + " w69999 w300"]
    rows = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array([5, None, 5, 7, 8, 9]), pa.array(texts)], ["row", "doc_id", "text"])
    runs = list(masked_lm._chunk_texts(iter([rows.slice(0, 2), rows.slice(2)])))
    assert [r["chunk"][0].as_py() for r in runs] == [0, 4]
    found, keys = [], []
    for run in runs:
        (chunk,) = masked_lm.read_chunks(run)
        keys += chunk.doc_ids.to_pylist()
        words = [chunk.words[c] for c in chunk.codes]
        assert dict(zip(chunk.words, run["counts"][0].as_py())) == Counter(words)
        ends = np.cumsum(chunk.lengths)
        found += [words[end - n : end] for n, end in zip(chunk.lengths, ends)]
    assert keys == [5, None, 5, 7, 8, 9] and found == [t.lower().split() for t in texts]


def test_words_are_joined_once_a_run(spark):
    """Words in buckets meet their counts once a run of documents, not once a document, and single words not at all."""
    common.prepared(spark)
    frequent = " ".join(f"f{k}" for k in range(masked_lm.WORDS))
    texts = [f"{frequent} {frequent} {frequent}"] + [f"f1 often o{k % 3} single{k}" for k in range(40)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    chunks = masked_lm.chunked(documents)
    counts = masked_lm.word_counts(chunks)
    known = masked_lm.Vocabulary([f"f{k}" for k in range(masked_lm.WORDS)])
    found = masked_lm.log_counts(chunks, counts, known).collect()
    assert chunks.count() == 1
    assert sorted(round(float(np.exp(r["log_count"]))) for r in found) == [13, 13, 14, 40]
