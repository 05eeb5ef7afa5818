"""The latest row of each key, kept in a table as a stream brings rows (G1)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from refinery.functions._columns import ColumnLike
from refinery.operators.latest import latest_per_key
from refinery.sources.keyed import rewrite_touched, write_keyed


def merge_batch(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: ColumnLike,
    *,
    buckets: int,
    tie_break: Sequence[ColumnLike] | None = None,
) -> list[int]:
    """Merges rows into a table of ``write_keyed`` so that each key keeps its latest; makes the table if there is none.

    What is latest is settled by ``latest_per_key`` over stored and new rows, not by what came last, so rows may
    come in any order, and merging a batch again changes nothing. Only buckets with keys of the batch are read and rewritten.
    """
    spark = batch.sparkSession
    try:
        spark.read.parquet(path)
    except AnalysisException:
        write_keyed(batch.limit(0), path, keys, buckets=buckets)

    def latest(stored: DataFrame, new: DataFrame) -> DataFrame:
        return latest_per_key(stored.unionByName(new), keys, order_by, tie_break=tie_break)

    return rewrite_touched(path, batch, keys, latest, buckets=buckets)


def merge_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: ColumnLike,
    checkpoint: str,
    *,
    buckets: int,
    tie_break: Sequence[ColumnLike] | None = None,
    **trigger: Any,
) -> StreamingQuery:
    """Keeps the latest row of each key of a stream in a table; its end state is that of ``latest_per_key`` over all rows.

    No state is held in memory or in a state store: the table is the state. A micro-batch that fails
    half-way is merged again after a restart, to the same outcome. By default
    everything that has landed is merged and the query ends; larger micro-batches rewrite a bucket less often.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, path, keys, order_by, buckets=buckets, tie_break=tie_break)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
