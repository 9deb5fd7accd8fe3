from __future__ import annotations

import corpus_pipeline
from salesloom.llm import common
from salesloom.llm.queries import QUERIES
from tests.conftest import DATA


def test_stages_keep_the_columns_and_take_effect(spark):
    common.prepared(spark)
    data = DATA.replace("sf0.001", "sf0.01")
    docs = common.table(spark, data, "documents")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, data), "test-stage")
        counts.append(docs.count())
        assert docs.columns[: len(columns)] == columns, name
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2] and counts[4] < 1.1 * counts[3]
    sample = docs.limit(20).collect()
    assert all(r["piece_text"] == r["text"] and r["piece_disagreements"] == 0 for r in sample)
    assert "@" not in "".join(r["text"] for r in docs.select("text").collect() if "example.com" in r["text"])


def test_run_on_rows_with_every_defect(spark, folder):
    common.prepared(spark)
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0),
            (None, "no id a@b.c", "en", "s", 3), (5, "mail me at x@y.org", "en", "s", 3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "3", "4", "5", "None"]
    assert {r["text"] for r in found if r["doc_id"] in (5, None)} == {"mail me at [EMAIL]", "no id [EMAIL]"}
    assert all(r["piece_ids"][-1] == 2 for r in found)


def test_run_on_empty_tables(spark, folder):
    common.prepared(spark)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_queries_run_on_empty_tables(spark, folder):
    for name in ("documents", "labels", "embeddings"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, folder).count() == 0, name
