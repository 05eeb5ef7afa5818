"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from refinery.llm import bpe, decontaminate, jaccard, language_model, licenses, private, quality, repeats, secrets, topk
from refinery.llm.queries import PATTERN, RANKS

LONG = "the quick brown fox jumps over the lazy dog near a very old stone bridge while seven birds sing in a tall tree "
ROWS = [
    (1, "token = abcdef123 under the MIT License, mail x@y.org", "en"),
    (2, LONG + " ".join(f"word{k}" for k in range(20_000)), "en"),
    (3, "", None),
    (4, None, "en"),
    (None, "no id here", "en"),
    (5, LONG, None),
    (6, LONG, "de"),
    (6, LONG, "de"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    clash = ["a", "b", "key", "node", "size", "batch", "words", "score", "_row", "hash", "id", "component"]
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.select("*", *(F.lit(f"own {c}").alias(c) for c in clash))


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


WITH_COLUMN = {
    "secrets": lambda d: secrets.with_secrets(d),
    "licenses": lambda d: licenses.with_licenses(d),
    "private": lambda d: private.with_private_data(d),
    "ids": lambda d: bpe.with_ids(d, RANKS, PATTERN),
    "lm": lambda d: language_model.with_backoff_scores(d),
    "score": lambda d: quality.with_quality(d, quality.fit(quality.feature_rows(["a b", "c"]), quality.np.array([0.0, 1.0]))),
}


@pytest.mark.parametrize("into", WITH_COLUMN)
def test_adds_a_column_and_keeps_rows_and_columns(docs, none, into):
    out = WITH_COLUMN[into](docs)
    assert set(out.columns) == {*docs.columns, into}
    kept = [c for c in docs.columns if c != into]
    assert sorted(map(str, out.select(*kept).collect())) == sorted(map(str, docs.select(*kept).collect()))
    assert out.where(F.col(into).isNull()).count() == 0
    assert len({str(r[into]) for r in out.where("doc_id = 6").collect()}) == 1
    assert WITH_COLUMN[into](none).count() == 0
    # An own column of that name gives way.
    again = WITH_COLUMN[into](docs.withColumn(into, F.lit("old")))
    assert again.schema[into].dataType == out.schema[into].dataType


def test_round_trip(docs):
    coded = bpe.with_decoded(bpe.with_ids(docs, RANKS, PATTERN), RANKS, PATTERN)
    assert coded.where("coalesce(text, '') <> cast(decoded AS string)").count() == 0


def test_masked_keeps_null(docs):
    rows = dict(docs.select("doc_id", private.masked("text").alias("t")).where("doc_id < 5").collect())
    assert rows[4] is None and rows[3] == "" and rows[1].endswith("mail [EMAIL]")


def test_jaccard(docs, none):
    out = jaccard.jaccard_classes(docs)
    rows = sorted(map(tuple, out.collect()), key=str)
    by_id = {r[0]: r for r in rows}
    assert len(rows) == len(ROWS)
    assert by_id[3] == (3, 0, 3) and by_id[4] == (4, 0, 4)
    assert by_id[6][2] == by_id[5][2] == 5 and by_id[None][2] is None
    assert jaccard.jaccard_classes(none).count() == 0
    kept = jaccard.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None"]


def test_repeats(docs, none):
    out = repeats.repeated_paragraphs(docs)
    assert sorted(r["doc_id"] for r in out.collect()) == [5, 6, 6]
    assert out.where("keep").count() == 1
    assert repeats.repeated_paragraphs(none).count() == 0
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert {r["text"] for r in cut.where("doc_id = 6").collect()} == {""}


def test_leaks(spark, docs, none):
    items = spark.createDataFrame([(7, LONG), (8, None), (9, ""), (None, LONG), (10, "one two")], "item_id long, text string")
    items = items.withColumn("hash", F.lit(1)).withColumn("id", F.lit(2))
    out = decontaminate.leaks(docs, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in out.collect()) == [(2, 7), (5, 7), (6, 7)]
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(docs, items.where("false")).count() == 0
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "None"]


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert quality.accepted(docs, model).columns == docs.columns
    for frame, marks in ((none, labels), (docs, labels.where("false"))):
        empty = quality.train(frame, marks)
        assert {r["score"] for r in quality.with_quality(docs, empty).select("score").collect()} == {0.5}


def test_search(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0, 0.25]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, []), (9, [2.0]), (None, [1.0, 1.0]), (10, [1e300, 0.0]), (1, [1.0, 0.5]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("own"))
    out = topk.top_inner_products(vectors, vectors.where("vec_id IN (0, 8, 10)"), k=4)
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in out.collect()}
    assert [found[0, k] for k in range(1, 5)] == [
        (10, 2**63 - 1), (9, 2048 * 1024), (1, 1024 * 1024 + 512 * 512), (2, 1024 * 1024 + 512 * 512)
    ]
    assert [found[8, k] for k in range(1, 5)] == [(0, 0), (1, 0), (2, 0), (3, 0)]
    few = topk.top_inner_products(vectors.where("vec_id < 3"), vectors.where("vec_id = 0"), k=4)
    assert sorted((r["rank"], r["vec_id"]) for r in few.collect()) == [(1, 1), (2, 2)]
    assert topk.top_inner_products(vectors.where("false"), vectors, k=4).count() == 0
    assert topk.top_inner_products(vectors, vectors.where("false"), k=4).count() == 0
