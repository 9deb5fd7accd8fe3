"""Jaccard join of word n-grams (operator 2), by vertical partitioning.

A document's set holds the hashes of its distinct n-grams. The global order of all n-grams (the order of their hashes) is cut into
FRAGMENTS; a set becomes one sorted segment per fragment. For candidate pairs the overlaps of their segments are
counted fragment by fragment, each fragment's join by itself, and the partial counts are summed per pair. A pair links when
100 * overlap >= percent * union.

Three exact steps keep the pairs few:

1. Equal sets form classes; only one document of a class goes on.
2. A set that links with a different one misses at most (100 - percent) % of its n-grams there. N-grams in the lowest part of
   the order are counted over all documents; a document whose n-grams found nowhere else exceed that number
   links with nothing and needs no further look. Its text is not moved.
3. Two linked sets share an n-gram among the first ones of both, in an order that puts rare n-grams first (prefix filter), and
   at places that leave room for the overlap they need.
   Documents under such an n-gram are first tried against one of them only (stars); pairs that are connected by then
   are left out, and every other pair is tried. So a group of near copies costs links to its centre, not all its pairs,
   and no link between different components is lost.

Hashes have 64 bits (classes 128); texts are hashed in Arrow batches, everything else is DataFrame code. All
intermediate tables go to the shared folder.

Defined cases: a null text or one without words has the empty set and links with nothing, not even with other empty ones;
a text of fewer than n words has one n-gram, all its words; rows with one id are one node, all their different sets are compared
and share a component (`one_of_each` takes only near sets together); a row without id has no component and links nothing; extra columns are ignored; empty tables work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from salesloom.llm.common import chunks_by_size, whole, written
from salesloom.llm.components import components

# The order of hashes is cut here; a power of two.
FRAGMENT_BITS = 3
FRAGMENTS = 1 << FRAGMENT_BITS
STAR_ROUNDS = 2
CHUNK_BYTES = 1_000_000
# Running sums go over so many bytes at once, cut between words; so the tables of powers stay small.
WINDOW_BYTES = 1 << 18
BLOOM_FROM = "32MB"
LONG_WORD = 256

# Random odd numbers and byte codes, fixed by a seed.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE_CODES = np.random.default_rng(41).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2^64, for the places of one window."""
    found = []
    for factor in (_STEP, pow(_STEP, -1, 1 << 64)):
        steps = np.full(WINDOW_BYTES + 1, np.uint64(factor))
        steps[0] = 1
        found.append(np.cumprod(steps, dtype=np.uint64, out=steps))
    return found[0], found[1]


# The lowest hashes are the counted part: this share of all, as a multiple of the share that a linked set may miss.
COUNTED_MULTIPLE = 1.75


@dataclass(frozen=True)
class Rule:
    """Words of an n-gram, and the least Jaccard similarity in percent."""

    words: int = 4
    percent: int = 85

    @property
    def counted_below(self) -> int:
        """Hashes (signed 64 bits) below this are counted."""
        share = min(1.0, COUNTED_MULTIPLE * (100 - self.percent) / 100)
        return int(-(1 << 63) + share * (1 << 64)) if share < 1 else (1 << 63) - 1

    def may_miss(self, size: Column) -> Column:
        """How many n-grams a set of this size may miss in a linked one."""
        return F.floor((100 - self.percent) * size / F.lit(100)).cast("long")


def word_codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word of a lower-cased text and a 64-bit code of the word.

    A code is a sum of byte codes times powers of an odd number; running sums give all words at once. Words too long for the
    sums to be trusted get a code of their own.
    """
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _powers()
    codes = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(ends, base + WINDOW_BYTES, side="right"))
        if last == first:  # one word longer than the window
            first += 1
            continue
        piece = raw[base : ends[last - 1]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[piece] * powers[: len(piece)], dtype=np.uint64, out=sums[1:])
        begin, end = starts[first:last] - base, ends[first:last] - base
        codes[first:last] = (sums[end] - sums[begin]) * inverses[begin]
        first = last
    codes ^= (ends - starts).astype(np.uint64) * _FACTORS[3]
    codes = (codes ^ (codes >> np.uint64(30))) * _FACTORS[1]
    codes ^= codes >> np.uint64(27)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        codes[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return starts, codes


def mixed_windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    mixed = np.full(max(0, len(codes) - width + 1), np.uint64(width))
    for k in range(width):
        mixed = (mixed ^ codes[k : k + len(mixed)]) * _FACTORS[k % 4]
        mixed ^= mixed >> np.uint64(31)
    mixed *= _FACTORS[0]
    mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def ngram_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-grams of each text, as signed 64-bit numbers."""
    out: list[np.ndarray] = []
    raws = [(t or "").encode("utf-8", "replace") for t in texts]
    for part in chunks_by_size([len(r) + 1 for r in raws], CHUNK_BYTES):
        begins = np.cumsum([0, *(len(r) + 1 for r in raws[part])])
        starts, codes = word_codes(b" ".join(raws[part]).lower())
        cuts = np.searchsorted(starts, begins)
        hashes = mixed_windows(codes, size)
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if last - first >= size:
                out.append(np.unique(hashes[first : last - size + 1]))
            elif last > first:
                out.append(mixed_windows(codes[first:last], last - first))
            else:
                out.append(np.zeros(0, np.int64))
    return out


def hashed_sets(rule: Rule, part: str):
    """An Arrow function from texts to the size and key of their sets, and the hashes of the asked part: counted or all."""
    below, size = rule.counted_below, rule.words

    @F.arrow_udf("struct<n:bigint,key:binary,hashes:array<bigint>>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = ngram_sets(batch.to_pylist(), size)
            keys = [hashlib.blake2b(f.tobytes(), digest_size=16).digest() for f in found]
            kept = [f[: np.searchsorted(f, below)] for f in found] if part == "counted" else found
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])])
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
                ],
                ["n", "key", "hashes"],
            )

    return sets


def alone(counted: DataFrame, rule: Rule) -> DataFrame:
    """Ids of documents with more n-grams found nowhere else than a linked one may have."""
    each = counted.filter(F.col("doc_id").isNotNull()).select("doc_id", "n", F.explode("hashes").alias("hash"))
    single = each.groupBy("hash").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id"), F.min("n").alias("n")).filter("c = 1")
    own = single.groupBy("doc_id").agg(F.count("*").alias("own"), F.min("n").alias("n"))
    return own.filter(F.col("own") > rule.may_miss(F.col("n"))).select("doc_id")


def _segments(sets: DataFrame) -> DataFrame:
    """One row per set and fragment: id, n, fragment and its sorted hashes."""
    cut = F.explode("parts").alias("p")
    edges = [-(1 << 63) + k * (1 << (64 - FRAGMENT_BITS)) for k in range(FRAGMENTS)]
    parts = [
        F.struct(
            F.lit(k).alias("fragment"),
            F.filter("hashes", _between(low, low + (1 << (64 - FRAGMENT_BITS)) - 1)).alias("segment"),
        )
        for k, low in enumerate(edges)
    ]
    return sets.select("id", "n", F.array(*parts).alias("parts")).select("id", "n", cut).select("id", "n", "p.*")


def _between(low: int, high: int):
    return lambda h: (h >= F.lit(low)) & (h <= F.lit(high))


def links_among(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (x, y) that link: overlaps counted in each fragment, summed per pair.

    The segments of y, in stars the few centres, meet those of x by y and fragment.
    """
    segments = _segments(sets)
    left = pairs.join(segments.select(F.col("id").alias("x"), F.col("n").alias("n_x"), "fragment", F.col("segment").alias("s_x")), "x")
    right = segments.select(F.col("id").alias("y"), F.col("n").alias("n_y"), "fragment", F.col("segment").alias("s_y"))
    partial = left.join(right, ["y", "fragment"]).select(
        "x", "y", "n_x", "n_y", F.size(F.array_intersect("s_x", "s_y")).cast("long").alias("overlap")
    )
    total = partial.groupBy("x", "y").agg(F.sum("overlap").alias("overlap"), F.min("n_x").alias("n_x"), F.min("n_y").alias("n_y"))
    union = F.col("n_x") + F.col("n_y") - F.col("overlap")
    return total.filter(100 * F.col("overlap") >= rule.percent * union).select("x", "y", "overlap", union.alias("union"))


def _may_link(rule: Rule) -> Column:
    """Whether two sets can link that meet under an n-gram at these places of their orders.

    A link needs an overlap of percent / (100 + percent) of both sizes together. Then the first common n-gram comes
    early enough in both: behind it at least the rest of the overlap must follow.
    """
    least = F.ceil(rule.percent * (F.col("n") + F.col("n_y")) / F.lit(100 + rule.percent))
    return (F.col("place") <= F.col("n") - least + 1) & (F.col("place_y") <= F.col("n_y") - least + 1)


def prefixes(sets: DataFrame, rule: Rule) -> DataFrame:
    """hash, id, n, place: the first n-grams of each set, rare before frequent (equal counts by hash), those that another
    set holds too. Two linked sets share one of them."""
    rows = sets.select("id", "n", (rule.may_miss(F.col("n")) + 1).alias("length"), "hashes")
    each = rows.select("id", "n", "length", F.explode("hashes").alias("hash"))
    frequent = each.groupBy("hash").agg(F.count("*").alias("c")).filter("c > 1")
    shared = each.join(frequent, "hash")
    by_set = Window.partitionBy("id")
    # N-grams of one set only come first in the order: their number shifts the others.
    place = F.col("n") - F.count("*").over(by_set) + F.row_number().over(by_set.orderBy("c", "hash"))
    return shared.withColumn("place", place).filter(F.col("place") <= F.col("length")).select("hash", "id", "n", "place")


def _stars(prefix: DataFrame, rule: Rule) -> DataFrame:
    """For each set the one centre (smallest id under an n-gram) that it meets most often, if it is in another component."""
    centres = prefix.groupBy("hash").agg(
        F.min_by(F.struct("id", "n", "place", "component"), "id").alias("centre"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).filter("low < high")
    centres = centres.select(
        "hash", F.col("centre.id").alias("y"), F.col("centre.n").alias("n_y"), F.col("centre.place").alias("place_y"),
        F.col("centre.component").alias("c_y"),
    )
    met = prefix.join(centres, "hash").filter((F.col("component") != F.col("c_y")) & _may_link(rule))
    often = met.groupBy(F.col("id").alias("x"), "y").agg(F.count("*").alias("often"))
    return often.groupBy("x").agg(F.max_by("y", F.struct("often", -F.col("y"))).alias("y"))


def _remaining(prefix: DataFrame, rule: Rule) -> DataFrame:
    """Every pair under a common n-gram whose sets are in different components and may link."""
    open_hashes = prefix.groupBy("hash").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    rows = written(prefix.join(open_hashes.select("hash"), "hash", "left_semi"), "ngram-open")
    other = rows.select(
        "hash", F.col("id").alias("y"), F.col("n").alias("n_y"), F.col("place").alias("place_y"), F.col("component").alias("c_y")
    )
    met = rows.join(other, "hash").filter((F.col("id") < F.col("y")) & (F.col("component") != F.col("c_y")) & _may_link(rule))
    return met.select(F.col("id").alias("x"), "y").distinct()


def links_between_sets(sets: DataFrame, rule: Rule) -> DataFrame:
    """id and component of sets (id, n, hashes) with links; links inside a component may be left out, never between two."""
    prefix = written(prefixes(sets, rule).withColumn("component", F.col("id")), "ngram-prefix")
    links, labels = None, None
    for round_ in range(STAR_ROUNDS + 1):
        pairs = _stars(prefix, rule) if round_ < STAR_ROUNDS else _remaining(prefix, rule)
        found = written(links_among(written(pairs, "ngram-pairs"), sets, rule).select("x", "y"), "ngram-links")
        if found.isEmpty():
            if round_ < STAR_ROUNDS:
                continue
            break
        links = found if links is None else links.union(found)
        labels = components(links)
        if round_ < STAR_ROUNDS:
            renamed = labels.select("id", F.col("component").alias("label"))
            prefix = prefix.join(renamed, "id", "left").withColumn("component", F.coalesce("label", "component")).drop("label")
            prefix = written(prefix, "ngram-prefix")
    return labels


def _nodes(held: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """key, first (its smallest doc_id), n and node of each different set; and links between the sets of one id, if an id has several.

    The node of a set is its smallest id. Where another set has the same smallest id, the larger key gets a hash as its node.
    """
    firsts = held.groupBy("key").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"))
    several = held.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("doc_id")
    several = written(several, "ngram-several")
    if several.isEmpty():
        return firsts.withColumn("node", F.col("first")), None
    least = firsts.groupBy("first").agg(F.min("key").alias("least"))
    node = F.when(F.col("key") == F.col("least"), F.col("first")).otherwise(F.xxhash64("key", "first"))
    firsts = written(firsts.join(least, "first").select("key", "first", "n", node.alias("node")), "ngram-nodes")
    owned = held.join(several, "doc_id").select("doc_id", "key").distinct().join(firsts.select("key", "node"), "key")
    hubs = owned.groupBy("doc_id").agg(F.min("node").alias("hub"))
    same_id = owned.join(hubs, "doc_id").select(F.col("node").alias("x"), F.col("hub").alias("y"))
    return firsts, written(same_id.filter("x <> y").distinct(), "ngram-same-id")


def members_of(documents: DataFrame, rule: Rule, *more: str, ids_are_one: bool = True) -> DataFrame:
    """doc_id, n (set size), key (of the set), component (smallest id), keeper (where its smallest id has several sets, the key of
    the one that stands for the component; else the row's own key) and further columns
    `more` of every row of documents (doc_id, text). ids_are_one: all sets of one id are one node, else only near sets are together."""
    found = documents.select("doc_id", *more, hashed_sets(rule, "counted")(whole()).alias("s"))
    members = written(found.select("doc_id", *more, "s.n", "s.key", "s.hashes"), "ngram-members")
    held = members.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    firsts, same_id = _nodes(held)
    others = alone(members, rule)
    if same_id is not None:  # single n-grams are counted for an id, so ids with several sets go on in any case
        several = held.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
        others = others.join(several, "doc_id", "left_anti")
    others = written(others, "ngram-alone")
    chosen = firsts.select(F.col("first").alias("doc_id"), F.col("key").alias("wanted"), "node")
    chosen = written(chosen.join(others, "doc_id", "left_anti"), "ngram-chosen")
    # Few documents are left. Where their ids make a small Bloom filter, Spark applies it before it moves any text.
    documents.sparkSession.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", BLOOM_FROM)
    texts = documents.select("doc_id", whole().alias("text")).join(chosen, "doc_id")
    # Not deterministic for the optimizer: it would hash all texts before the join to compare keys in it.
    hashed = hashed_sets(rule, "all").asNondeterministic()
    sets = texts.select(F.col("node").alias("id"), "wanted", hashed(F.col("text")).alias("s"))
    sets = sets.filter(F.col("s.key") == F.col("wanted")).select("id", F.col("s.n").alias("n"), F.col("s.hashes").alias("hashes"))
    if not held.groupBy("doc_id").count().filter("count > 1").isEmpty():
        sets = sets.dropDuplicates(["id"])
    sets = written(sets, "ngram-sets")
    labels = links_between_sets(sets, rule)
    if same_id is not None and ids_are_one:
        near = same_id if labels is None else labels.select(F.col("id").alias("x"), F.col("component").alias("y")).union(same_id)
        labels = components(near)
    if labels is None:
        grouped = firsts.select("key", F.col("first").alias("component"), F.col("key").alias("keeper"))
    else:
        joined = firsts.join(labels.withColumnRenamed("id", "node"), "node", "left")
        grouped = joined.select("key", "first", F.coalesce("component", "node").alias("label"))
        if same_id is not None:
            # A label may be the hash of a set: the smallest id of all its sets stands for it.
            best = grouped.groupBy("label").agg(F.min(F.struct("first", "key")).alias("best"))
            grouped = grouped.join(best, "label").select("key", F.col("best.first").alias("component"), F.col("best.key").alias("keeper"))
        else:
            grouped = grouped.select("key", F.col("label").alias("component"), F.col("key").alias("keeper"))
    return members.select("doc_id", *more, "n", "key").join(grouped, "key", "left")


def classes(documents: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n (set size) and component of every row of documents (doc_id, text)."""
    found = members_of(documents, rule)
    own = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n", own.alias("component"))


def one_of_each(documents: DataFrame, rule: Rule) -> DataFrame:
    """The rows of documents without near copies: of each group of near sets stays the smallest id, of rows that repeat id and set one.

    Rows of one id with texts that are not near stay all; rows without id or without words stay."""
    print_of = F.xxhash64(whole())
    found = members_of(documents.select("doc_id", "text", print_of.alias("print__")), rule, "print__", ids_are_one=False)
    known = found.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    stands = (F.col("key") == F.col("keeper")) & (F.col("doc_id") == F.col("component"))
    rows = known.groupBy("doc_id", "key", "print__").agg(F.count("*").alias("times"), F.min(stands).alias("stands"))
    rows = written(rows, "ngram-rows")
    # Of rows with one id and one set the smallest print stays, once.
    least = rows.groupBy("doc_id", "key").agg(F.min("print__").alias("least"), F.count("*").alias("prints")).filter("prints > 1")
    doubled = rows.join(least, ["doc_id", "key"]).filter("print__ <> least")
    copies = rows.filter(~F.col("stands")).select("doc_id", "print__").union(doubled.select("doc_id", "print__")).distinct()
    kept = documents.withColumn("print__", print_of).join(copies, ["doc_id", "print__"], "left_anti")
    again = rows.filter(F.col("stands") & (F.col("times") > 1)).select("doc_id", "print__", F.lit(True).alias("again__"))
    if again.isEmpty():
        return kept.select(*documents.columns)
    marked = kept.join(again, ["doc_id", "print__"], "left")
    once = marked.filter("again__").dropDuplicates(["doc_id", "print__"])
    return marked.filter("again__ is null").select(*documents.columns).unionByName(once.select(*documents.columns))
