"""Toxic passages (operator 8): maximum-scoring segments over token log-odds.

Every token carries the log-odds that it comes from a toxic text. Shares are posterior means under Dirichlet priors in
two levels: the first letters of a word (its stem) start from the share of toxic texts, a word starts from its stem. A stem counts
the texts of its words, damped for each word, so that no single frequent word decides. So rare and unseen words take over what is known of their stem. DEVIATIONS posterior standard
deviations are taken off the log-odds, so that chance words of a few toxic texts stay small. Each token also pays a drift,
which makes the expectation negative in clean text, as local scan statistics need.

A linear-time scan (Ruzzo and Tompa) finds all maximal scoring segments of a text. Scores become E-values, K * length *
exp(-lambda * score): lambda solves E[exp(lambda * s)] = 1 over the token scores of clean learning texts, K is the
maximum-likelihood fit of the extreme-value law to their best segments. Segments with an E-value below SIGNIFICANT are the
passages; a text's evidence is the sum of -ln(E) of its passages, and a logistic curve over that evidence, fitted on the
learning texts, gives the score. Learning texts are scanned without their own share of the counts, as unseen texts are.

Learning uses a bounded sample of the labelled rows (LEARNING_ROWS, those with the smallest hash of the id), so that
ids and labels can be broadcast and no text is shuffled. The model holds at most MOST_TERMS words and as many stems.

Defined cases: null and empty texts have no passage and score as texts without evidence; without toxic or clean
learning rows the score is the share of toxic labels (0 without labels); several labels of one id count as toxic if one
is; repeated rows are scored alike; ids without label teach nothing; extra columns are ignored; empty tables work.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import whole

LEARNING_ROWS = 20_000
MOST_TERMS = 100_000
STEM_LETTERS = 4
# Weight of the prior in texts, for stems and for words.
STEM_PRIOR = 10.0
WORD_PRIOR = 5.0
WORD_LIMIT = 20.0
LEAST_TEXTS = 2
DEVIATIONS = 1.0
DRIFT = 1.5
SIGNIFICANT = 0.05
# Histogram of token scores on clean texts: bins of this width from LOWEST on.
BIN, LOWEST, BINS = 0.05, -12.0, 480

_WORD = re.compile(r"[^\W\d_]+")
PASSAGES = (
    "struct<score:double,evidence:double,n_tokens:bigint,best:double,"
    "passages:array<struct<start:int,end:int,score:double,e_value:double>>>"
)


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), left to right, in linear time.

    Only positive tokens start or end a segment; sums up to them come from one running sum.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum behind
    # For each held segment, the nearest earlier one with a smaller sum before it (-1: none).
    earlier: list[int] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, float(sums[i]), float(sums[i + 1])
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j = earlier[j]
            if j < 0 or held[j][3] >= right:
                held.append((start, end, left, right))
                earlier.append(j)
                break
            start, left = held[j][0], held[j][2]
            del held[j:], earlier[j:]
    return [(start, end, right - left) for start, end, left, right in held]


def _logit(p: float) -> float:
    return math.log(p) - math.log1p(-p)


@dataclass
class ToxicityModel:
    """Token log-odds, the extreme-value law of clean texts, and the curve from evidence to score."""

    base: float = 0.0  # share of toxic learning texts
    words: dict[str, tuple[float, float]] = field(default_factory=dict)  # posterior counts in toxic and clean texts
    stems: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    size: float = 0.1  # K
    intercept: float = 0.0
    slope: float = 0.0
    fitted: bool = False

    def odds(self, toxic: float, clean: float) -> float:
        """Log-odds of posterior counts, moved towards 0 (not beyond) by their uncertainty."""
        raw = math.log(toxic) - math.log(clean) - _logit(self.base)
        return math.copysign(max(abs(raw) - DEVIATIONS * math.sqrt(1 / toxic + 1 / clean), 0.0), raw)

    def token_scores(self, words: list[str], memory: dict[str, float], label: int | None = None) -> np.ndarray:
        """Score of each token. label: the words come from a learning text, whose own counts are left out."""
        for word in {w for w in words if w not in memory}:
            known = self.words.get(word)
            if known is None:
                odds = self.stems.get(word[:STEM_LETTERS], 0.0)
            elif label is None:
                odds = self.odds(*known)
            else:
                odds = self.odds(max(known[0] - (label == 1), 0.05), max(known[1] - (label == 0), 0.05))
            memory[word] = odds - DRIFT
        return np.fromiter(map(memory.__getitem__, words), float, len(words))

    def passages(self, found: list[tuple[int, int, float]], length: int) -> list[tuple[int, int, float, float]]:
        """Segments that are too good for a clean text of this length."""
        scored = ((s, e, x, self.size * length * math.exp(-min(self.rate * x, 700.0))) for s, e, x in found)
        return [p for p in scored if p[3] < SIGNIFICANT]

    def evidence(self, passages: list[tuple[int, int, float, float]]) -> float:
        return sum(-math.log(max(p[3], 1e-300)) for p in passages)

    def score(self, evidence: float) -> float:
        if not self.fitted:
            return self.base
        z = self.intercept + self.slope * math.log1p(evidence)
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts hold a word, and how many toxic ones; summed over a task in blocks."""
    texts: Counter[str] = Counter()
    toxic: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        names = list(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([texts[n] for n in names], pa.int64()),
                pa.array([toxic[n] for n in names], pa.int64()),
            ],
            ["word", "n", "toxic"],
        )

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(tokens(text))
            texts.update(words)
            if label:
                toxic.update(words)
        if len(texts) > 500_000:
            yield out()
            texts.clear()
            toxic.clear()
    yield out()


def learning_rows(documents: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """text and label (1: toxic) of the labelled documents in the bounded sample."""
    known = labels.filter(usable & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("label"))
    chosen = known.filter(F.col("label").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LEARNING_ROWS)
    return documents.select("doc_id", whole().alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")


def _weights(rows: DataFrame, model: ToxicityModel) -> None:
    counts = rows.mapInArrow(_term_counts, "word string, n bigint, toxic bigint").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")
    ).filter(F.col("n") >= LEAST_TEXTS)
    stem = F.substring("word", 1, STEM_LETTERS)
    # A word speaks for its stem with its texts, damped: one frequent word counts WORD_LIMIT texts at most.
    damped = F.col("n") / (1 + F.col("n") / WORD_LIMIT)
    share = F.col("toxic") / F.col("n")
    stems = counts.groupBy(stem.alias("stem")).agg(
        (F.sum(share * damped) + STEM_PRIOR * model.base).alias("a"),
        (F.sum((1 - share) * damped) + STEM_PRIOR * (1 - model.base)).alias("b"),
    )
    start = F.col("a") / (F.col("a") + F.col("b"))
    words = counts.join(stems.select("stem", start.alias("start")), stem == F.col("stem")).select(
        "word",
        (F.col("toxic") + WORD_PRIOR * F.col("start")).alias("a"),
        (F.col("n") - F.col("toxic") + WORD_PRIOR * (1 - F.col("start"))).alias("b"),
    )
    distance = F.abs(F.log(F.col("a")) - F.log(F.col("b")) - F.lit(_logit(model.base)))
    order = [(distance / F.sqrt(1 / F.col("a") + 1 / F.col("b"))).desc()]
    for row in stems.orderBy(*order, "stem").limit(MOST_TERMS).toLocalIterator():
        model.stems[row["stem"]] = model.odds(row["a"], row["b"])
    for row in words.orderBy(*order, "word").limit(MOST_TERMS).toLocalIterator():
        model.words[row["word"]] = row["a"], row["b"]


def _scan_learning(model):
    """First pass: label, words and best segment of each learning text; and, with label -1, the scores of clean words by bins."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histogram = np.zeros(BINS, np.int64)
        for batch, rows in _learning_scores(model, batches):
            found = []
            for label, scores in rows:
                if not label:
                    place = np.clip(((scores - LOWEST) / BIN).astype(np.int64), 0, BINS - 1)
                    histogram += np.bincount(place, minlength=BINS)
                found.append((label, len(scores), [max((x for _, _, x in maximal_segments(scores)), default=0.0)]))
            yield _learning_batch(found)
        yield _learning_batch([(-1, 0, histogram.astype(float))])

    return scan


def _weigh_learning(model):
    """Second pass, with the law known: label, words and evidence of each learning text, summed over all its passages."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _learning_scores(model, batches):
            fitted = model.value
            found = []
            for label, scores in rows:
                found.append((label, len(scores), [fitted.evidence(fitted.passages(maximal_segments(scores), len(scores)))]))
            yield _learning_batch(found)

    return weigh


def _learning_scores(model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[int, np.ndarray]]]]:
    memories: dict[int, dict[str, float]] = {0: {}, 1: {}}
    for batch in batches:
        labelled = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        yield batch, ((label, model.value.token_scores(tokens(text), memories[label], label)) for text, label in labelled)


def _learning_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
        ["label", "n", "found"],
    )


def decay_rate(counts: np.ndarray) -> float:
    """The positive root of E[exp(rate * s)] = 1 over a histogram of scores; where scores never rise above 0, or rise on
    average, a rate of 1."""
    values = LOWEST + BIN * (np.arange(len(counts)) + 0.5)
    total = counts.sum()
    if not total or (counts * values).sum() >= 0 or not counts[values > 0].any():
        return 1.0
    shares, low, high = counts / total, 0.0, 1.0

    def over(rate: float) -> bool:
        return float((shares * np.exp(np.minimum(rate * values, 700.0))).sum()) > 1.0

    while not over(high) and high < 1e3:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return high


def logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, by Newton steps with a weak ridge."""
    design, weights = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - y) + 1e-2 * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def learn(documents: DataFrame, labels: DataFrame, usable: Column) -> ToxicityModel:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic); usable says which ids may teach.

    To the driver come at most MOST_TERMS words and stems, and twice a row of a few numbers for each of the LEARNING_ROWS texts.
    """
    spark = documents.sparkSession
    rows = learning_rows(documents, labels, usable)
    model = ToxicityModel()
    sums = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    if not sums["n"]:
        return model
    model.base = sums["toxic"] / sums["n"]
    if not 0 < model.base < 1:
        return model
    _weights(rows, model)
    form = "label int, n bigint, found array<double>"
    # Destroyed after use, so that executors and their workers hold the final model only.
    unfitted = spark.sparkContext.broadcast(model)
    found = rows.mapInArrow(_scan_learning(unfitted), form).collect()
    unfitted.destroy()
    model.rate = decay_rate(sum((np.array(r["found"]) for r in found if r["label"] < 0), np.zeros(BINS)))
    clean = [(r["n"], r["found"][0]) for r in found if r["label"] == 0 and r["n"]]
    expected = sum(n * math.exp(-min(model.rate * best, 700.0)) for n, best in clean)
    model.size = len(clean) / expected if expected else 1.0
    calibrated = spark.sparkContext.broadcast(model)
    texts = rows.mapInArrow(_weigh_learning(calibrated), form).collect()
    calibrated.destroy()
    evidence = np.array([r["found"][0] for r in texts])
    model.intercept, model.slope = logistic_fit(np.log1p(evidence), np.array([float(r["label"]) for r in texts]))
    model.fitted = True
    return model


def scanned(spark: SparkSession, model: ToxicityModel, text: Column) -> Column:
    """Score, evidence and every significant passage (token positions) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PASSAGES)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, memory = shared.value, {}
        for batch in batches:
            if len(memory) > 200_000:
                memory.clear()
            rows = []
            for text in batch.to_pylist():
                words = tokens(text or "")
                segments = maximal_segments(model.token_scores(words, memory))
                passages = model.passages(segments, len(words))
                evidence = model.evidence(passages)
                rows.append(
                    {
                        "score": model.score(evidence),
                        "evidence": evidence,
                        "n_tokens": len(words),
                        "best": max((x for _, _, x in segments), default=0.0),
                        "passages": [dict(zip(("start", "end", "score", "e_value"), p)) for p in passages],
                    }
                )
            place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])
            kind = pa.struct(
                [("score", pa.float64()), ("evidence", pa.float64()), ("n_tokens", pa.int64()), ("best", pa.float64()),
                 ("passages", pa.list_(place))]
            )
            yield pa.array(rows, kind)

    return scan(text)
