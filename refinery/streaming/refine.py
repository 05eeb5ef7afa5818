"""Refining payloads as they land.

The pipelines are batch by nature, and most treat each payload row by itself; those run
unchanged on a stream, which then plays the part of the incremental read: the checkpoint
remembers which files are done. Pipelines that compare rows (distinct, latest, roll-ups)
would need unbounded state and are refused; they run as batches over what has landed.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from refinery.plans import registry


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json", **options: Any
) -> DataFrame:
    """Payload files of a folder as a stream. ``maxFilesPerTrigger`` bounds a micro-batch."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def refine_stream(stream: DataFrame, entity: str, **context: Any) -> DataFrame:
    if not registry.ENTITIES[entity].rowwise:
        raise ValueError(f"{entity} compares rows with each other; refine it in batches")
    return registry.refine(stream, entity, **context)


def write_stream(
    refined: DataFrame, path: str, checkpoint: str, *, partition_by: Sequence[str] = (), **trigger: Any
) -> StreamingQuery:
    """Appends to a parquet table, each file exactly once.

    ``checkpoint`` belongs to this one query and must outlive it, on storage that all
    executors share. By default everything that has landed is refined and the query ends.
    """
    return (
        refined.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
