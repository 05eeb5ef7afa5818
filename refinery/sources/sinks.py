"""Sinks: plain tables, dated snapshots (M-4), and payloads landed for re-use."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from refinery.functions.parsing import as_of_date
from refinery.session import work_folder


def write_table(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """A refined table as files. Partition columns should have few values, such as days."""
    df.write.mode(mode).partitionBy(*partition_by).format(fmt).save(path)


def write_snapshot(
    df: DataFrame, path: str, as_of: Column | str | dt.date | None = None, *, column: str = "snapshot_date"
) -> None:
    """The rows as the snapshot of one day, next to those of other days.

    Only that day's partition is replaced, so a run can be repeated without doubling rows. The
    day is settled first and the partition's own folder written, which spares the sort that a
    write by partition column would put before the files.
    """
    day = df.sparkSession.range(1).select(as_of_date(as_of).cast("string")).first()[0]
    df.drop(column).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={day}")


def land(df: DataFrame, path: str | None = None) -> DataFrame:
    """Writes a payload as parquet and gives back the written table.

    Worth it when several outputs are derived from a payload that is dear to produce (text to
    parse, a join): each then reads only its own columns. Unlike a cache, the table outlives
    lost executors. Without ``path`` it goes below the cluster's shared checkpoint folder.
    """
    spark = df.sparkSession
    target = path or work_folder(spark, "landed")
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)
