"""The queries of the ten operations: columns, one row per document, and figures in their ranges."""

from __future__ import annotations

import hashlib

import public_tokenizers
import sentencepiece

from salesloom.llm.queries import QUERIES
from tests.conftest import DATA

COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op3_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_masked_lm": ["doc_id", "n_tokens", "log_likelihood", "per_token"],
    "op5_mixing": ["doc_id", "n_words", "rate", "times"],
    "op7_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op10_fertility": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


def test_one_row_per_document_with_the_columns(spark):
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())
    for name, columns in COLUMNS.items():
        found = QUERIES[name](spark, DATA)
        assert set(columns) <= set(found.columns), name
        assert sorted(r["doc_id"] for r in found.select("doc_id").collect()) == ids, name


def test_digests_are_those_of_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in QUERIES["op7_sentencepiece"](spark, DATA).collect():
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids) and r["n_disagreements"] == 0
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nearest_of_the_given_vectors(spark):
    found = QUERIES["op6_multi_index"](spark, DATA).collect()
    queries = spark.read.parquet(f"{DATA}/embeddings.parquet").filter("vec_id % 50 = 0").count()
    assert len(found) == 5 * queries
    assert {r["rank"] for r in found} == {1, 2, 3, 4, 5}
