"""A corpus pipeline: toxic documents go, one of each group of near copies stays, personal data is masked, poor text is mixed
down to its share, and what remains is encoded.

STAGES lists the stages in order. Each takes (spark, docs, sf_dir) and returns a table; all but the last return the columns
of their input. Near copies are documents whose five-word sets are at least 80 % alike.

Defined cases: null and empty texts are not toxic, are nobody's copy, hold no personal data and encode to the end id; rows that repeat an
id and a text stay once, other texts of the same id stay like texts of other ids; extra columns pass through; empty tables work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import common, mixing, ngram_join, personal_data, pieces, toxicity

TOXIC_FROM = 0.3
NEAR = ngram_join.Rule(words=5, percent=80)
# Words of good clean text and of poor text; other domains of the labels keep what they have.
MIXTURE = {"q1t0": 0.95, "q0t0": 0.05}
ANCHOR = "q1t0"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit, learned from all labels."""
    common.prepared(spark)
    model = toxicity.learn(docs, common.table(spark, sf_dir, "labels"), F.lit(True))
    scored = docs.withColumn("tox__", toxicity.scanned(spark, model, common.whole()))
    return scored.filter(F.col("tox__.score") < TOXIC_FROM).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    common.prepared(spark)
    return ngram_join.one_of_each(docs, NEAR)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    common.prepared(spark)
    return personal_data.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say."""
    common.prepared(spark)
    labelled = mixing.domains_of(common.table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, MIXTURE, ANCHOR)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids and the text decoded from them."""
    common.prepared(spark)
    return pieces.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", without_toxic),
    ("near copies", without_near_copies),
    ("personal data", without_personal_data),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's table is written before the next reads it."""
    common.prepared(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
