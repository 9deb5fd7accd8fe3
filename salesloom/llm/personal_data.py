"""Personal data (operator 3): fixed patterns as seeds, bootstrapped contextual extraction behind them; DataFrame functions only.

Seeds are the matches of four fixed kinds that pass their checks. Identifier-like tokens (runs with a digit) that overlap no
seed are the candidates. Every seed and candidate is an instance with lexical patterns: the word before it, the word behind
it and both together, whatever it looks like; and the same three with its character shape, which gain weight when instances of
that shape are accepted. So identifiers of a form that no seed has are found by their contexts. The patterns and instances form a graph:

* a pattern's confidence is the share of its distinct instances that are known, damped for patterns with little support;
* an instance's confidence is 1 - product(1 - confidence) over the sides (before, behind, both), each with its stronger pattern;
* instances above ACCEPT with evidence from enough sides become known, and the next round scores the patterns again.

The graph holds hashes of patterns and values; each round is two aggregations with partial sums, so a frequent word as
context is no hot spot, and its known set is written out. Discovered spans have the kind `other`.

The expressions start only where a run of their characters starts (or where the last match ended) and repeat without
backtracking, so that long texts take linear time and no recursion.

Defined cases: a null or empty text has no span; offsets are code points, end exclusive; failing matches are dropped without
another try; repeated rows (id and text equal) get equal results; extra columns are ignored; empty tables work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import whole, written

KINDS = ("email", "ip", "card", "phone")
OTHER = "other"

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a kind.
GATES = {"email": "@", "ip": ".", "card": "", "phone": "+"}

_TOKEN = "[A-Za-z0-9_@+/-]"
# Groups of digits, some in brackets, with one blank, dot or hyphen between them; or one run with a digit, dots inside it.
_GROUP = r"(?:\([0-9]{2,}+\)|[0-9]{2,}+)"
CANDIDATE = (
    rf"(?<![A-Za-z0-9_@+/.-])(?:{_GROUP}(?:[ .-]{_GROUP})++(?!{_TOKEN})"
    rf"|(?=[A-Za-z_@+/.-]*+[0-9])(?=[A-Za-z0-9_@+/.-]{{6}}){_TOKEN}++(?:\.{_TOKEN}++)*+)"
)

ROUNDS = 3
ACCEPT = 0.8
LEAST_KNOWN = 3
LEAST_PATTERNS = 2
CONTEXT_CHARS = 40


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    part = "^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"
    return (
        (kind == KINDS.index("email"))
        | ((kind == KINDS.index("ip")) & F.forall(F.split(match, r"\."), lambda p: p.rlike(part)))
        | ((kind == KINDS.index("card")) & count.between(13, 19) & F.call_function("luhn_check", digits))
        | ((kind == KINDS.index("phone")) & count.between(9, 15))
    )


def _matches(text: Column, pattern: str, kind: int, gate: Column) -> Column:
    """Matches of a pattern in order, each with the text between the last match and it, and the text behind."""
    between, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("b"), F.slice(between, 2, F.size(found)).alias("a")),
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            x["m"].alias("match"),
            F.length(x["b"]).alias("gap"),
            F.right(x["b"], F.lit(CONTEXT_CHARS)).alias("before"),
            F.left(x["a"], F.lit(CONTEXT_CHARS)).alias("behind"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,match:string,gap:int,before:string,behind:string>>")
    return F.when(gate, rows).otherwise(none)


def occurrences(documents: DataFrame) -> DataFrame:
    """Every match of the four kinds (valid or not) and every candidate (kind 4): doc_id, key, kind, start, end, match, before, behind."""
    text = F.col("text")
    digit = F.col("digit")
    rows = documents.select("doc_id", whole().alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("key"), text.rlike("[0-9]").alias("digit")
    ).filter(F.col("digit") | F.contains("text", F.lit("@")))
    lists = [
        _matches(text, PATTERNS[name], k, F.contains(text, F.lit(GATES[name])) & (digit if name != "email" else F.lit(True)))
        for k, name in enumerate(KINDS)
    ]
    lists.append(_matches(text, CANDIDATE, len(KINDS), digit))
    found = rows.select("doc_id", "key", F.concat(*lists).alias("found")).filter(F.size("found") > 0)
    found = found.dropDuplicates(["doc_id", "key"])
    each = found.select("doc_id", "key", F.posexplode("found").alias("k", "f")).select("doc_id", "key", "k", "f.*")
    so_far = Window.partitionBy("doc_id", "key", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    end = F.sum(F.col("gap").cast("long") + size).over(so_far)
    return each.select("doc_id", "key", "kind", (end - size).alias("start"), end.alias("end"), "match", "before", "behind")


def _instances(found: DataFrame) -> DataFrame:
    """Valid seeds, and candidates that overlap none of them."""
    # A candidate overlaps a seed if a seed that starts before its end reaches beyond its start.
    every = found.filter((F.col("kind") == len(KINDS)) | _valid(F.col("kind"), F.col("match")))
    seed = F.col("kind") < len(KINDS)
    document = Window.partitionBy("doc_id", "key")
    left = document.orderBy("start", F.when(seed, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    right = document.orderBy(F.col("start").desc(), F.when(seed, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(seed, F.col("end"))).over(left)
    next_start = F.min(F.when(seed, F.col("start"))).over(right)
    free = F.coalesce(reach <= F.col("start"), F.lit(True)) & F.coalesce(next_start >= F.col("end"), F.lit(True))
    return every.withColumn("free", free).filter(seed | F.col("free")).drop("free").withColumn("known", seed)


def _graph(instances: DataFrame) -> DataFrame:
    """Edges between patterns and values, without repetition: side, pattern, value (hashes) and whether the value is a seed."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("match", "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")
    shape = F.left(shape, F.lit(CONTEXT_CHARS))
    before = F.lower(F.regexp_extract("before", r"(\S+)\s*$", 1))
    behind = F.lower(F.regexp_extract("behind", r"^\s*(\S+)", 1))
    rows = instances.select(shape.alias("shape"), before.alias("before"), behind.alias("behind"), "match", "known")
    sides = (["before"], ["behind"], ["before", "behind"])
    pattern = F.explode(
        F.array(
            *[F.struct(F.lit(k).alias("side"), F.xxhash64(F.lit(k), *words).alias("pattern")) for k, words in enumerate(sides)],
            *[F.struct(F.lit(k).alias("side"), F.xxhash64(F.lit(k), *words, "shape").alias("pattern")) for k, words in enumerate(sides)],
        )
    )
    edges = rows.select(pattern.alias("p"), F.xxhash64("match").alias("value"), "known").select("p.*", "value", "known")
    return edges.groupBy("side", "pattern", "value").agg(F.max("known").alias("seed"))


def discovered(instances: DataFrame) -> DataFrame:
    """Hashes of the values that the rounds accept, beside the seeds."""
    edges = written(_graph(instances), "pii-graph")
    known = None
    for _ in range(ROUNDS):
        if known is None:
            marked = edges.withColumn("is_known", F.col("seed"))
        else:
            marked = edges.join(known.withColumn("accepted", F.lit(True)), "value", "left").withColumn(
                "is_known", F.col("seed") | F.coalesce("accepted", F.lit(False))
            )
        patterns = marked.groupBy("pattern").agg(F.sum(F.col("is_known").cast("long")).alias("hits"), F.count("*").alias("n"))
        patterns = patterns.filter((F.col("hits") >= LEAST_KNOWN) & (F.col("hits") < F.col("n"))).select(
            "pattern", (F.col("hits") / (F.col("n") + 1)).alias("confidence")
        )
        # With and without the shape a side is one piece of evidence: the stronger of the two counts.
        sides = edges.filter(~F.col("seed")).join(patterns, "pattern").groupBy("value", "side").agg(F.max("confidence").alias("confidence"))
        scored = sides.groupBy("value").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("confidence"), F.count("*").alias("patterns")
        )
        known = written(
            scored.filter((F.col("confidence") >= ACCEPT) & (F.col("patterns") >= LEAST_PATTERNS)).select("value"), "pii-known"
        )
    return known


def spans(documents: DataFrame) -> DataFrame:
    """doc_id, key, kind (number; 4: other), start, end of every base span and every discovered one."""
    found = written(_instances(occurrences(documents)), "pii-instances")
    new = found.filter(~F.col("known")).join(discovered(found), F.xxhash64("match") == F.col("value"), "left_semi")
    return found.filter("known").unionByName(new).select("doc_id", "key", "kind", "start", "end", "match")


def by_document(documents: DataFrame) -> DataFrame:
    """Every document with its spans as a sorted array of (kind, start, end); empty without any."""
    rows = documents.select("doc_id", F.xxhash64(whole()).alias("key"))
    lists = spans(documents).groupBy(F.col("doc_id").alias("found_id"), F.col("key").alias("found_key")).agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("spans")
    )
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key")), "left")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return joined.select("doc_id", "key", F.coalesce("spans", none).alias("spans"))


def written_spans(column: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in (*KINDS, OTHER)))
    return F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all columns stay.

    Overlapping spans count as one, of the kind that comes first. Pieces are cut from the text as 4-byte characters, so the
    time is linear in text and spans.
    """
    mark = "pii__"
    found = spans(documents)
    # Runs of overlapping spans: a span starts a run if no earlier one reaches beyond its start.
    order = Window.partitionBy("doc_id", "key").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("fresh", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("doc_id", "key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("kind").alias("kind"))
    cuts = runs.groupBy(F.col("doc_id").alias(f"{mark}id"), F.col("key").alias(f"{mark}key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias(f"{mark}cuts")
    )
    names = list(documents.columns)
    keyed = documents.withColumn(f"{mark}own", F.xxhash64(whole()))
    same = keyed["doc_id"].eqNullSafe(cuts[f"{mark}id"]) & (F.col(f"{mark}own") == F.col(f"{mark}key"))
    joined = keyed.join(cuts, same, "left")
    wide = F.encode("text", "UTF-32")
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS, OTHER)))
    list_of = F.col(f"{mark}cuts")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(list_of, lambda c: c["end"]))
    ends = F.concat(F.transform(list_of, lambda c: c["start"]), F.array(F.length("text").cast("long")))
    marks = F.concat(F.transform(list_of, lambda c: F.element_at(labels, c["kind"] + 1)), F.array(F.lit("")))
    held = joined.withColumn(f"{mark}wide", F.when(list_of.isNotNull(), wide))
    pieces = F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e"), marks.alias("m")),
        lambda p: F.concat(
            F.decode(F.substring(F.col(f"{mark}wide"), (4 * p["s"] + 1).cast("int"), (4 * (p["e"] - p["s"])).cast("int")), "UTF-32"),
            p["m"],
        ),
    )
    text = F.when(list_of.isNotNull(), F.array_join(pieces, "")).otherwise(F.col("text"))
    return held.withColumn(f"{mark}text", text).select(*(F.col(f"{mark}text").alias(c) if c == "text" else F.col(c) for c in names))
