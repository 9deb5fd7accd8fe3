"""Mixing documents to target weights (operator 5): soft membership and projected gradient, in DataFrame functions only.

A labelled table teaches a multinomial naive Bayes classifier over hashed words. It gives every document a posterior over the
domains (the labels), softened by the root of the text's length, so that long texts keep doubts too. With n_i the words
and P_i the posterior of document i, rates r_i >= 0 are fitted so that the expected words of each domain,
sum r_i n_i P_ik, match the targets: least squares over all documents by projected gradient, from r = 1. Residuals are
measured in the inverse of the domains' second moments (sum n_i P_i P_i'), in which a step of 1 is always safe.
Each step is one aggregation over all documents; what comes back is one number per domain. Rates are not stored between
steps: they follow from the posterior and the few vectors so far, which are written into the rates every REPLAY steps.

The classifier learns from a bounded sample of the labelled rows (LEARNING_ROWS, smallest hashes of the id): ids and labels
are broadcast and no text is shuffled. The weights broadcast for scoring have BUCKETS rows. Domains are as many as labels
differ; their list and the matrices of domains x domains are on the driver.

Defined cases: a text without words has the prior as posterior, no tokens and the rate 1; repeated rows (id and text equal)
count each and get one rate; domains without a target keep their words; without labels there is one domain `all`;
a target for an absent domain is left out; extra columns are ignored; empty tables work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import whole, written

LEARNING_ROWS = 20_000
BUCKETS = 1 << 15
SMOOTHING = 0.5
# Weight of a text's evidence: log-likelihoods are divided by length ** SOFTNESS.
SOFTNESS = 0.5
STEPS = 60
REPLAY = 10
TOLERANCE = 1e-6


def _words(text: Column) -> Column:
    """Runs between spaces and line ends; empty ones are left out later."""
    return F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain from the labels table: q<quality>t<toxic>; rows with a null are left out."""
    rows = labels.select("doc_id", "quality", "toxic").dropna()
    return rows.groupBy("doc_id").agg(
        F.min(F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))).alias("domain")
    )


def _word_weights(documents: DataFrame, labelled: DataFrame) -> tuple[list[str], np.ndarray, DataFrame | None]:
    """Domains, their log priors, and the log-probabilities of each bucket, one column per domain."""
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LEARNING_ROWS)
    rows = documents.select("doc_id", whole().alias("text")).join(F.broadcast(chosen), "doc_id")
    each = rows.select("domain", F.explode(_words(F.col("text"))).alias("word")).filter("word <> ''")
    counts = written(each.groupBy("domain", _bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("c")), "mixing-counts")
    texts = {r["domain"]: r["count"] for r in chosen.groupBy("domain").count().collect()}
    totals = {r["domain"]: r["c"] for r in counts.groupBy("domain").agg(F.sum("c").alias("c")).collect()}
    names = sorted(totals)
    if not names:
        return ["all"], np.zeros(1), None
    priors = np.log(np.array([texts[n] for n in names], float) / sum(texts[n] for n in names))
    columns = []
    for k, name in enumerate(names):
        c = F.sum(F.when(F.col("domain") == name, F.col("c")).otherwise(0))
        columns.append((F.log(c + SMOOTHING) - float(np.log(totals[name] + SMOOTHING * BUCKETS))).alias(f"w{k}"))
    return names, priors, counts.groupBy("bucket").agg(*columns)


def memberships(documents: DataFrame, labelled: DataFrame) -> tuple[list[str], DataFrame]:
    """Domains, and for each different (doc_id, text): copies, n (words) and p (posterior)."""
    names, priors, weights = _word_weights(documents, labelled)
    # In a select of its own, so that a text is hashed once and not for each of its words.
    keyed = documents.select("doc_id", F.xxhash64(whole()).alias("key"), _words(whole()).alias("words"))
    rows = keyed.select("doc_id", "key", F.posexplode("words").alias("at", "word"))
    rows = rows.withColumn("bucket", F.when(F.col("word") != "", _bucket(F.col("word"))))
    sums = [F.lit(0.0).alias("s0")]
    if weights is not None:
        rows = rows.join(F.broadcast(weights), "bucket", "left")
        # A bucket that no labelled text holds says nothing.
        sums = [F.sum(F.coalesce(f"w{k}", F.lit(0.0))).alias(f"s{k}") for k in range(len(names))]
    grouped = rows.groupBy("doc_id", "key").agg(
        F.sum((F.col("at") == 0).cast("long")).alias("copies"), F.count("bucket").alias("words"), *sums
    )
    n = F.col("words") / F.col("copies")
    scale = F.col("copies") * F.pow(F.greatest(n, F.lit(1.0)), F.lit(SOFTNESS))
    logits = F.array(*(F.lit(float(prior)) + F.col(f"s{k}") / scale for k, prior in enumerate(priors)))
    raised = grouped.select("doc_id", "key", "copies", n.alias("n"), logits.alias("z"))
    shares = raised.withColumn("e", F.transform("z", lambda z: F.exp(z - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    posterior = shares.withColumn("total", total).withColumn("p", F.transform("e", lambda x: x / F.col("total")))
    return names, posterior.select("doc_id", "key", "copies", "n", "p")


def _dot(p: Column, vector: np.ndarray) -> Column:
    out = F.lit(0.0)
    for k, v in enumerate(vector):
        out = out + p[k] * float(v)
    return out


def _stepped(rate: Column, steps: list[np.ndarray]) -> Column:
    """The rate after projected steps along these domain vectors."""
    if not steps:
        return rate
    vectors = F.array(*(F.array(*(F.lit(float(v)) for v in s)) for s in steps))

    def step(r: Column, v: Column) -> Column:
        along = F.aggregate(F.arrays_zip(F.col("p").alias("a"), v.alias("b")), F.lit(0.0), lambda s, x: s + x["a"] * x["b"])
        return F.greatest(r - along, F.lit(0.0))

    return F.aggregate(vectors, rate, step)


def target_totals(names: list[str], totals: np.ndarray, weights: dict[str, float], anchor: str | None) -> np.ndarray:
    """Words wanted of each domain. The anchor keeps its words and sets the volume; without one the named domains keep theirs
    together. Domains that weights does not name keep what they have."""
    targets = totals.astype(float).copy()
    named = [k for k, n in enumerate(names) if n in weights]
    whole_weight = sum(weights[names[k]] for k in named)
    if not whole_weight:
        return targets
    if anchor in names and weights.get(anchor):
        volume = totals[names.index(anchor)] / weights[anchor]
    else:
        volume = totals[named].sum() / whole_weight
    for k in named:
        targets[k] = weights[names[k]] * volume
    return targets


def fitted(members: DataFrame, names: list[str], weights: dict[str, float], anchor: str | None = None) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Add the rate to each member; also the totals, targets and reached totals of the domains."""
    size = len(names)
    state = written(members.withColumn("rate", F.lit(1.0)), "mixing-rates")
    mass = F.col("copies") * F.col("n")
    moments = [F.sum(mass * F.col("p")[j] * F.col("p")[k]).alias(f"g{j}_{k}") for j in range(size) for k in range(size)]
    first = state.agg(*(F.sum(mass * F.col("p")[k]).alias(f"t{k}") for k in range(size)), *moments).first()
    totals = np.array([first[f"t{k}"] or 0.0 for k in range(size)])
    gram = np.array([[first[f"g{j}_{k}"] or 0.0 for k in range(size)] for j in range(size)])
    targets = target_totals(names, totals, weights, anchor)
    scale = np.trace(gram)
    inverse = np.linalg.pinv(gram + 1e-9 * scale * np.eye(size)) if scale else np.zeros((size, size))
    steps: list[np.ndarray] = []
    reached = totals
    for _ in range(STEPS):
        if not scale or np.abs(reached - targets).max() <= TOLERANCE * targets.sum():
            break
        steps.append(inverse @ (reached - targets))
        rate = _stepped(F.col("rate"), steps)
        if len(steps) == REPLAY:
            state, steps = written(state.withColumn("rate", rate), "mixing-rates"), []
            rate = F.col("rate")
        now = state.withColumn("now", rate).agg(*(F.sum(F.col("now") * mass * F.col("p")[k]).alias(f"t{k}") for k in range(size))).first()
        reached = np.array([now[f"t{k}"] for k in range(size)])
    result = state.withColumn("rate", _stepped(F.col("rate"), steps))
    return result, {"totals": totals, "targets": targets, "reached": reached}


def copies_of(rate: Column, *identity: Column) -> Column:
    """A whole number of copies whose expectation is the rate, decided by a hash."""
    chance = F.pmod(F.xxhash64(F.lit("mixing"), *identity), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + chance).cast("int")


def rates(documents: DataFrame, labelled: DataFrame, weights: dict[str, float], anchor: str | None = None) -> tuple[list[str], DataFrame]:
    """Domains, and doc_id, key, copies (rows of this id and text), n, p and rate of every different document."""
    names, members = memberships(documents, labelled)
    return names, fitted(members, names, weights, anchor)[0]


def mixed(documents: DataFrame, labelled: DataFrame, weights: dict[str, float], anchor: str | None = None) -> DataFrame:
    """The documents, each as often as its rate says; all columns stay."""
    mark = "mix__"
    _, found = rates(documents, labelled, weights, anchor)
    times = found.select(
        F.col("doc_id").alias(f"{mark}id"), F.col("key").alias(f"{mark}key"), copies_of(F.col("rate"), F.col("doc_id"), F.col("key")).alias(f"{mark}times")
    )
    keyed = documents.withColumn(f"{mark}own", F.xxhash64(whole()))
    same = keyed["doc_id"].eqNullSafe(times[f"{mark}id"]) & (F.col(f"{mark}own") == F.col(f"{mark}key"))
    joined = keyed.join(times, same).filter(F.col(f"{mark}times") > 0)
    repeated = joined.withColumn(f"{mark}copy", F.explode(F.sequence(F.lit(1), F.col(f"{mark}times"))))
    return repeated.select(*documents.columns)
