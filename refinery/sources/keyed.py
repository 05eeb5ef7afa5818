"""Tables kept in buckets of keys, of which an update rewrites those it touches (M-2, M-3)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike
from refinery.operators.history import merge_history
from refinery.operators.incremental import upsert

BUCKET = "key_bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: its keys' hash. Rows of a key share one, and so do rows without."""
    return F.pmod(F.xxhash64(*[F.col(f"`{key}`") for key in keys]), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    marked = df.withColumn(BUCKET, key_bucket(keys, buckets))
    # Rebalancing brings a bucket's rows together, and splits a bucket that is much larger than others.
    writer = marked.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], *, buckets: int) -> None:
    """``df`` as a table in ``buckets`` folders by the hash of its keys; the number is part of the table.

    A bucket should come to some GB at most, as it is the least that an update reads and writes.
    """
    df.sparkSession.createDataFrame([], df.schema).withColumn(BUCKET, F.lit(0)).limit(0).write.mode("overwrite").parquet(path)
    _write(df, path, keys, buckets, "append")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def rewrite_touched(
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    *,
    buckets: int,
) -> list[int]:
    """Replaces the buckets that ``updates`` has keys of by what ``merge`` makes of their rows and the updates.

    Which buckets these are, at most ``buckets`` numbers, is looked up first; only their folders are read, and only they are
    written. The others keep their files. A bucket changes in one rename when the job commits, so a
    run that fails leaves the table as it was. Returns the buckets.
    """
    spark = updates.sparkSession
    touched = sorted(row[0] for row in updates.select(key_bucket(keys, buckets)).distinct().collect())
    if touched:
        stored = spark.read.parquet(path)
        merged = merge(stored.filter(F.col(BUCKET).isin(touched)).drop(BUCKET), updates)
        _write(merged, path, keys, buckets, "overwrite")
    return touched


def upsert_table(path: str, updates: DataFrame, keys: Sequence[str], order_by: ColumnLike, *, buckets: int, **options: Any) -> list[int]:
    """``operators.upsert`` into a table of ``write_keyed``, with the same outcome as over the whole table."""
    return rewrite_touched(path, updates, keys, lambda old, new: upsert(old, new, keys, order_by, **options), buckets=buckets)


def merge_history_table(
    path: str, changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, *, buckets: int, **options: Any
) -> list[int]:
    """``operators.merge_history`` into a history kept by ``write_keyed``."""
    return rewrite_touched(path, changes, keys, lambda old, new: merge_history(old, new, keys, tracked, ts, **options), buckets=buckets)
