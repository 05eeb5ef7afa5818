"""The registered queries over the small tables, and the pipeline stage by stage."""

import os
from pathlib import Path

import pytest

import __spark_entry__
import corpus_pipeline
from refinery.llm import decontaminate, jaccard, private, quality
from refinery.llm.queries import ORACLES, QUERIES, table
from tools.check_oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

COLUMNS = {
    "op1_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op2_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op3_topk_search": ["query_id", "rank", "vec_id", "score"],
    "op4_private_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op7_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_quality": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    run = __spark_entry__.queries()[name]
    if name in ORACLES:
        assert compare(spark, connect(FOLDER), FOLDER, run, ORACLES[name]).startswith("ok")
        return
    out = run(spark, FOLDER)
    assert out.columns == COLUMNS.get(name, out.columns)
    rows = out.collect()
    if "doc_id" in out.columns and name not in ("op8_repeated_paragraphs", "op10_decontamination"):
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in table(spark, FOLDER, "documents").collect())


def test_held_out_labels_are_told(spark):
    rows = QUERIES["op9_quality"](spark, FOLDER).where("held_out").join(table(spark, FOLDER, "labels"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after.keys() <= before.keys()
        if name == "private":
            assert after == {i: private.mask(text) for i, text in before.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "near_copies":
            again = jaccard.jaccard_classes(docs, settings=jaccard.Settings(n=5, percent=80))
            assert again.where("doc_id <> component_id").count() == 0
        if name == "benchmark":
            assert decontaminate.leaks(docs, table(spark, FOLDER, "benchmark")).count() == 0
        if name == "quality":
            model = quality.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
            low = quality.with_quality(table(spark, FOLDER, "documents"), model).where("score < 0.3")
            assert before.keys() - after.keys() == {r["doc_id"] for r in low.collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"]: r["decoded_sha256"] for r in out.collect()} == {
        r["doc_id"]: r["sha"] for r in docs.selectExpr("doc_id", "sha2(text, 256) as sha").collect()
    }


def test_run_is_all_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
