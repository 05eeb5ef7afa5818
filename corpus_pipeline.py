"""A corpus made ready for training, stage by stage; each stage works on what the one before kept.

All stages but the last give the columns they get, other columns than those of documents included. An empty table stays
empty, rows that are alike are treated alike, and texts of any length are worked through whole. Each docstring says
what becomes of NULL and empty texts and of rows without id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import bpe, decontaminate, jaccard, private, quality
from refinery.llm.common import keep_on_disk
from refinery.llm.queries import PATTERN, RANKS, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. NULL and empty texts have the score of a text without words; a NULL id
    only keeps a row from training."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8.

    NULL and empty texts are nothing's copies, and rows without id stay; of rows with one id the first by text stays.
    """
    return jaccard.one_per_class(docs, settings=jaccard.Settings(n=5, percent=80))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go. NULL and empty texts hold none; rows without id stay."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; the number of characters follows. A NULL text stays NULL, and so does its number."""
    clean = docs.withColumn("text", private.masked(docs["text"]))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as token ids, with digests of the ids and of what they decode to. A NULL text counts as empty and has no ids."""
    coded = bpe.with_ids(docs.select("doc_id", "text"), RANKS, PATTERN).drop("text")
    return bpe.with_decoded(coded, RANKS, PATTERN).select(
        "doc_id",
        F.expr("cast(length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("benchmark", benchmark_stage),
    ("private", private_stage),
    ("encode", encode_stage),
]

# SQL has no gradient boosting and no byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep_on_disk(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
