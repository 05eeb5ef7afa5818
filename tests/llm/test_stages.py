"""The pipeline's stages on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import hashlib
import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from refinery.llm.queries import table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

STAGES = dict(corpus_pipeline.STAGES)
KEPT = [name for name, _ in corpus_pipeline.STAGES[:-1]]
CLASH = ["score", "node", "size", "key", "component_id", "hash", "ids", "_score", "_maybe", "label"]


@pytest.fixture(scope="module")
def docs(spark):
    given = table(spark, FOLDER, "documents").orderBy("doc_id").limit(30).collect()
    long = " ".join(f"word{k} reads on and on" for k in range(20_000))
    odd = [
        (100_001, None, None, None, None),
        (100_002, "", "en", "s", 0),
        (100_003, long, "en", "s", len(long)),
        (None, "a text without an id, mail x@y.org", "en", "s", 35),
        (None, None, None, None, None),
        (100_004, "a row that is there twice, mail a@b.org and more", "en", "s", 49),
        (100_004, "a row that is there twice, mail a@b.org and more", "en", "s", 49),
    ]
    frame = spark.createDataFrame([*map(tuple, given), *odd], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASH))


@pytest.mark.parametrize("name", KEPT)
def test_stage_keeps_columns_and_rows_it_does_not_reject(spark, docs, name):
    out = STAGES[name](spark, docs, FOLDER)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    before, after = (Counter(map(tuple, frame.drop("text", "n_chars").collect())) for frame in (docs, out))
    assert not after - before
    ids = Counter(r["doc_id"] for r in out.collect())
    if name == "near_copies":
        assert ids[100_004] == 1 and ids[None] == 2 and ids[100_001] == ids[100_002] == 1
    if name in ("benchmark", "private"):
        assert ids[100_004] == 2 and ids[None] == 2 and ids[100_003] == 1
    if name == "private":
        rows = {r["doc_id"]: r for r in out.collect()}
        assert rows[100_001]["text"] is None and rows[100_001]["n_chars"] is None and rows[100_002]["n_chars"] == 0
        assert rows[100_004]["text"].count("[EMAIL]") == 1
        assert all(r["n_chars"] == len(r["text"]) for r in out.where("text is not null").collect())


@pytest.mark.parametrize("name", STAGES)
def test_stage_of_an_empty_table(spark, docs, name):
    assert STAGES[name](spark, docs.where("false"), FOLDER).count() == 0


def test_last_stage(spark, docs):
    out = STAGES["encode"](spark, docs, FOLDER)
    rows = out.collect()
    assert len(rows) == docs.count()
    texts = Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in docs.collect())
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in rows) == texts
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (100_001, 100_002)} == {0}
