"""Exact top-k search by inner product: term-at-a-time accumulation over blocks of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG = np.iinfo(np.int64)


def scaled(vector: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of each component; NULL for vectors that are, or hold, NULL or no finite number."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    lists = vectors.combine_chunks()
    lengths = np.asarray(lists.value_lengths(), dtype=np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.asarray(lists.flatten(), dtype=np.int64)
    return out


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Dense scores, a row per query: each term's postings are weighted and added, one term after the other."""
    terms = min(queries.shape[1], rows.shape[1])
    large = [int(np.abs(x[:, :terms].astype(float)).max(initial=0)) for x in (queries, rows)]
    exact = large[0] * large[1] * max(terms, 1) < LONG.max
    kind = np.int64 if exact else object  # Python's integers where 64 bits might not do
    scores = np.zeros((len(queries), len(rows)), dtype=kind)
    for term in range(terms):
        asked, held = np.flatnonzero(queries[:, term]), np.flatnonzero(rows[:, term])
        if not len(asked) or not len(held):
            continue
        weights = np.outer(queries[asked, term].astype(kind), rows[held, term].astype(kind))
        if len(asked) == len(queries) and len(held) == len(rows):
            scores += weights
        else:
            scores[np.ix_(asked, held)] += weights
    return scores if exact else np.clip(scores, LONG.min, LONG.max).astype(np.int64)


def best(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> Iterator[tuple]:
    """Per query the ids and scores of its k best rows, without its own; ties go to smaller ids."""
    for query, row in zip(query_ids, scores, strict=True):
        take = min(k + 1, len(row))  # one more, as its own row may be among them
        least = np.partition(row, len(row) - take)[len(row) - take]
        near = np.flatnonzero(row >= least)
        near = near[ids[near] != query]
        near = near[np.lexsort((ids[near], -row[near].astype(object) if row.min() == LONG.min else -row[near]))][:k]
        yield query, ids[near], row[near]


SCORED = "query_id long, vec_id long, score long"


def search_block(k: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        asked, held = queries.num_rows, rows.num_rows
        found = []
        if asked and held:
            ids = np.asarray(rows["id"], dtype=np.int64)
            scores = accumulate(matrix(queries["vector"]), matrix(rows["vector"]))
            found = list(best(np.asarray(queries["id"], dtype=np.int64), ids, scores, k))
        columns = [
            np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]).astype(np.int64),
            np.concatenate([i for _, i, _ in found] or [np.empty(0, np.int64)]),
            np.concatenate([s for _, _, s in found] or [np.empty(0, np.int64)]),
        ]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return search


def top_inner_products(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 10,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
    block_rows: int = 4096,
    query_rows: int = 512,
) -> DataFrame:
    """Each query's k best rows by integer inner product: query_id, rank, vec_id, score. Exact.

    Rows and queries are dealt into even blocks by a hash of their id, and every block of queries
    meets every block of rows in a group of its own, of bounded size: scores are accumulated
    there, the k best are selected, and those of all blocks are merged per query. Equal vectors
    make no difference to the blocks' sizes.

    Vectors that are NULL or hold NULL or a component that is not finite take no part, nor do rows
    without id. Components that a shorter vector lacks count as zero. An id that occurs more than
    once counts once, with the smallest of its vectors. Fewer than k other rows give fewer rows,
    empty tables none. Scores beyond 64 bits are cut to the nearest 64-bit number. Other columns
    are left out.
    """

    def ready(df: DataFrame) -> DataFrame:
        clean = df.select(F.col(id).cast("long").alias("id"), scaled(F.col(vector), scale).alias("vector"))
        return clean.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))

    rows, asked = ready(vectors), ready(queries)
    row_blocks = max(1, -(-rows.count() // block_rows))
    query_blocks = max(1, -(-asked.count() // query_rows))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        own_block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(own)
        return df.select("id", "vector", own_block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = dealt(asked, "query_block", query_blocks, "row_block", row_blocks)
    right = dealt(rows, "row_block", row_blocks, "query_block", query_blocks)
    keys = ("query_block", "row_block")
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search_block(k), SCORED)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
