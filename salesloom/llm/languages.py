"""Language identification (operator 1): multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything that is no letter becomes a space, and the n-grams of one to three characters that
hold a letter fall into 2^16 buckets. Learning counts buckets per language in every task and sums them in Spark; the
model is one matrix of log-probabilities (languages x buckets, so bounded by the label set), which is broadcast.
Scoring multiplies the sparse n-gram rows of a batch with that matrix in numpy: per language, the log-probabilities
of a batch's n-grams are gathered and summed by document. Texts of any length go through in pieces that overlap by
two characters, so no n-gram is lost or counted twice.

Defined cases: a null text and a text without a letter are `und` with score 0; without any labelled row every text
is `und`; equal posteriors go to the smaller label; repeated rows count as often as they occur and are each predicted;
rows without label or text teach nothing; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
PIECE_CHARS = 400_000
UNKNOWN = "und"

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, str, bool]]]:
    """Pieces of texts: index of the text, piece, and whether another piece follows; about PIECE_CHARS characters at once."""
    held: list[tuple[int, str, bool]] = []
    size, overlap = 0, max(ORDERS) - 1
    for i, text in enumerate(texts):
        text = f" {(text or '').lower()} "
        starts = range(0, max(1, len(text) - overlap), PIECE_CHARS)
        for begin in starts:
            held.append((i, text[begin : begin + PIECE_CHARS + overlap], begin != starts[-1]))
            size += len(held[-1][1])
            if size >= PIECE_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def hashed_ngrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of n-grams and the index of the text of each."""
    overlap = max(ORDERS) - 1
    for held in _pieces(texts):
        owners, parts, goes_on = zip(*held)
        points = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[np.minimum(points, 0x10FFFF)]
        points = np.where(letter, points, 32).astype(np.uint64)
        lengths = [len(p) for p in parts]
        part = np.repeat(np.arange(len(parts)), lengths)
        owner = np.array(owners)[part]
        # The last characters of a piece that goes on are the first of the next one: no n-gram starts there.
        last = np.cumsum(lengths) - np.where(goes_on, overlap, 0)
        starts_here = np.arange(len(points)) < last[part]
        for order in ORDERS:
            size = len(points) - order + 1
            if size <= 0:
                continue
            mixed = np.full(size, np.uint64(order))
            holds = np.zeros(size, bool)
            for k in range(order):
                mixed = (mixed ^ points[k : k + size]) * _MIX[k]
                mixed ^= mixed >> np.uint64(29)
                holds |= letter[k : k + size]
            keep = holds & starts_here[:size] & (part[:size] == part[order - 1 :])
            yield (mixed[keep] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), owner[:size][keep]


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    logs: np.ndarray  # languages x buckets
    priors: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Most likely label and its posterior."""
        count = len(texts)
        sums = np.zeros((len(self.labels), count))
        seen = np.zeros(count, bool)
        for buckets, owner in hashed_ngrams(texts):
            seen[owner] = True
            for k, logs in enumerate(self.logs):
                sums[k] += np.bincount(owner, weights=logs[buckets], minlength=count)
        if not self.labels:
            return [UNKNOWN] * count, [0.0] * count
        sums += self.priors[:, None]
        best = sums.argmax(axis=0)
        shares = 1.0 / np.exp(sums - sums.max(axis=0)).sum(axis=0)
        return (
            [self.labels[b] if s else UNKNOWN for b, s in zip(best, seen)],
            [float(p) if s else 0.0 for p, s in zip(shares, seen)],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task: a row for each label and bucket; bucket -1 counts texts."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        names = sorted(set(labels))
        code = np.array([names.index(label) for label in labels])
        for name in names:
            totals.setdefault(name, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
            totals[name][-1] += labels.count(name)
        for buckets, owner in hashed_ngrams(texts):
            for k, name in enumerate(names):
                totals[name][:-1] += np.bincount(buckets[code[owner] == k], minlength=1 << BUCKET_BITS)
    for name, counts in totals.items():
        at = np.flatnonzero(counts)
        buckets = np.where(at == 1 << BUCKET_BITS, -1, at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(buckets, pa.int32()), pa.array(counts[at], pa.int64())],
            ["label", "bucket", "n"],
        )


def learn(labelled: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Fit on all rows with text and label. What comes to the driver is at most labels x buckets counts."""
    rows = labelled.select(text, label).dropna()
    counts = rows.mapInArrow(_count, "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    labels = tuple(sorted(found["label"].unique()))
    sums = np.zeros((len(labels), 1 << BUCKET_BITS))
    texts = np.ones(len(labels))
    place = found["label"].map({name: k for k, name in enumerate(labels)}).to_numpy(dtype=np.int64)
    bucket, n = found["bucket"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.float64)
    texts[place[bucket < 0]] = n[bucket < 0]
    sums[place[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    sums += SMOOTHING
    logs = np.log(sums) - np.log(sums.sum(axis=1, keepdims=True))
    return LanguageModel(labels, logs, np.log(texts / max(texts.sum(), 1.0)))


def predicted(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """A struct of language and posterior for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, shares = shared.value.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["lang", "score"])

    return predict(text)
