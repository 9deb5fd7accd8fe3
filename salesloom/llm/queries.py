"""The queries of the ten operators: thin digests over the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import common, fertility, languages, licenses, masked_lm, merkle, mixing, multi_index, ngram_join, page_text, periodic, personal_data, pieces, toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree with it."""

    def register(build: Query) -> Query:
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return build(common.prepared(spark), folder)

        QUERIES[build.__name__] = call
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text")
    found = pieces.with_pieces(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("piece_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("piece_text"), 256).alias("decoded_sha256"),
        F.col("piece_disagreements").cast("long").alias("n_disagreements"),
    )


@query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the texts outside the held-out third."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = common.id_remainder("doc_id", 3) == 1
    model = languages.learn(documents.filter(~held_out))
    found = documents.select("doc_id", held_out.alias("held_out"), languages.predicted(spark, model, F.col("text")).alias("f"))
    return found.select("doc_id", "held_out", F.col("f.lang").alias("lang_pred"), F.col("f.score").alias("score"))


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out quarter."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text")
    held_out = common.id_remainder("doc_id", 4) == 2
    model = toxicity.learn(documents, common.table(spark, folder, "labels"), ~held_out)
    found = documents.select("doc_id", held_out.alias("held_out"), toxicity.scanned(spark, model, common.whole()).alias("f"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("f.score").alias("score"),
        (F.col("f.score") >= 0.3).cast("int").alias("predicted"),
        F.size("f.passages").cast("long").alias("n_passages"),
    )


@query()
def op10_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Base figures and fertility verdict of every document."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text", "lang")
    return fertility.verdicts(
        documents,
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    ).drop("group")


@query()
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence places and labels of every document."""
    found = licenses.scanned(common.table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.col("confidence").alias("score"),
        "n_detections",
    )


@query()
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = personal_data.by_document(common.table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(personal_data.KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(personal_data.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.written_spans(base), 256).alias("base_sha256"),
        personal_data.written_spans(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_other"),
    )


@query()
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose four-word sets are at least 85 % alike."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text")
    found = ngram_join.classes(documents, ngram_join.Rule(words=4, percent=85))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query()
def op4_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Summed conditional log-probability of every document under a network trained on all of them."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text")
    per_token = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return masked_lm.likelihoods(documents).withColumn("per_token", per_token)


@query()
def op6_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return multi_index.search(common.table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


# The share of words that a mixture for training should have of each domain of the labels table.
# Good clean text keeps its words, the others shrink or grow to their shares.
MIXTURE = {"q1t0": 0.94, "q0t0": 0.05, "q1t1": 0.01, "q0t1": 0.0}
ANCHOR = "q1t0"


@query()
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Posterior over domains, rate and copies of every document in the mixture."""
    documents = common.table(spark, folder, "documents").select("doc_id", "text")
    labelled = mixing.domains_of(common.table(spark, folder, "labels"))
    names, found = mixing.rates(documents, labelled, MIXTURE, ANCHOR)
    return found.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        *(F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(names)),
        "rate",
        mixing.copies_of(F.col("rate"), F.col("doc_id"), F.col("key")).alias("times"),
    )


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words in every document, its strongest one, and the text without their repetitions, as digests."""
    found = periodic.periodic(common.table(spark, folder, "documents"), prepare=periodic.with_period, digests_only=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")


# CRC-32 of the decimal digits of doc_id, bit by bit; leaves; levels of both trees; then proof and folding along each row's way.
MERKLE_SQL = """
WITH RECURSIVE rows_ AS (
    SELECT doc_id, lang, coalesce(lang IS NULL, false) AS no_lang,
        list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
            lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)::BIGINT[]), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)
        ) AS crc,
        coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
            || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
        n_chars, coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail
    FROM documents
), leaves AS (
    SELECT doc_id, lang, no_lang, sha256(head || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 7 = 0
            THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-') || tail) END AS changed
    FROM rows_
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY no_lang, lang ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY no_lang, lang) AS n,
        dense_rank() OVER (ORDER BY CASE WHEN no_lang THEN '' ELSE '=' || lang END) AS g
    FROM leaves
), tree AS (
    SELECT g, 0 AS level, pos, n AS nodes, leaf AS digest FROM placed
    UNION ALL
    SELECT l.g, l.level + 1, l.pos // 2, (l.nodes + 1) // 2, sha256(l.digest || coalesce(l.behind, ''))
    FROM (SELECT *, lead(digest) OVER (PARTITION BY g ORDER BY pos) AS behind FROM tree WHERE nodes > 1) l
    WHERE l.pos % 2 = 0
), subroots AS (
    SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE nodes = 1
), top_tree AS (
    SELECT 0 AS level, pos, n AS nodes, digest FROM subroots
    UNION ALL
    SELECT l.level + 1, l.pos // 2, (l.nodes + 1) // 2, sha256(l.digest || coalesce(l.behind, ''))
    FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS behind FROM top_tree WHERE nodes > 1) l
    WHERE l.pos % 2 = 0
), heights AS (SELECT g, max(level) AS height FROM tree GROUP BY g),
ways AS (
    SELECT p.doc_id, p.leaf, p.pos AS own, p.g, t.level, t.digest AS sibling, (p.pos >> t.level) % 2 = 1 AS is_right
    FROM placed p JOIN tree t ON t.g = p.g AND t.nodes > 1 AND (t.pos // 2) = (p.pos >> (t.level + 1)) AND t.pos <> (p.pos >> t.level)
    UNION ALL
    SELECT p.doc_id, p.leaf, p.pos, p.g, h.height + t.level, t.digest, (s.pos >> t.level) % 2 = 1
    FROM placed p JOIN heights h USING (g) JOIN subroots s USING (g)
    JOIN top_tree t ON t.nodes > 1 AND (t.pos // 2) = (s.pos >> (t.level + 1)) AND t.pos <> (s.pos >> t.level)
), top_height AS (SELECT max(level) AS height FROM top_tree),
steps AS (
    SELECT g, own, list(struct_pack(level := level, sibling := sibling, is_right := is_right)) AS found, string_agg(sibling, '' ORDER BY level) AS proof
    FROM ways GROUP BY g, own
), fold AS (
    SELECT p.g, p.pos, 0 AS level, h.height + t.height AS height, coalesce(p.changed, p.leaf) AS digest, coalesce(s.found, []) AS found
    FROM placed p JOIN heights h USING (g) CROSS JOIN top_height t LEFT JOIN steps s ON s.g = p.g AND s.own = p.pos
    UNION ALL
    SELECT f.g, f.pos, f.level + 1, f.height, CASE WHEN w.sibling IS NULL THEN sha256(f.digest)
        WHEN w.is_right THEN sha256(w.sibling || f.digest) ELSE sha256(f.digest || w.sibling) END, f.found
    FROM (SELECT *, list_filter(found, lambda x: x.level = level)[1] AS w FROM fold WHERE level < height) f
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(w.proof, '')) AS proof_sha256, f.digest AS folded_root,
    f.digest = r.digest AS verified
FROM placed p JOIN subroots s USING (g) JOIN top_tree r ON r.nodes = 1
JOIN fold f ON f.g = p.g AND f.pos = p.pos AND f.level = f.height LEFT JOIN steps w ON w.g = p.g AND w.own = p.pos
"""


@query(MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a leaf of one hash tree, with its proof and the root that its (partly tampered) leaf folds to."""
    documents = common.table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    n_chars = F.col("n_chars").cast("decimal(20,0)")

    def leaf(count):
        return merkle.hashed_fields(F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), count.cast("string"), F.col("text"))

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampered, leaf(n_chars + 1))
    found = merkle.manifest(documents, F.col("lang"), F.col("doc_id"), leaf(n_chars), changed)
    return found.withColumnRenamed("id", "doc_id")


@query()
def op13_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = common.table(spark, folder, "pages").select("page_id", "url", "html")
    return page_text.extracted(pages, page_text.learn(pages, F.col("url")))
