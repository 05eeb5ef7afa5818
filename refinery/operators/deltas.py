"""Stored roll-ups kept up to date by what changed (M-1)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions._columns import ColumnLike, as_column
from refinery.operators.differences import AFTER, INSERT
from refinery.operators.names import free_prefix

EXACT = (T.DecimalType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def additive_rollup(
    df: DataFrame, keys: Mapping[str, ColumnLike], sums: Mapping[str, ColumnLike], *, count_name: str = "rows"
) -> DataFrame:
    """Rows and sums per key, in types that can be taken off again: whole numbers and decimals.

    NULL counts as nothing in a sum. Floating-point measures are refused, since what was added to
    them cannot be taken off exactly; cast them to a decimal.
    """
    lines = df.select(*[as_column(c).alias(n) for n, c in {**keys, **sums}.items()])
    for name in sums:
        if not isinstance(lines.schema[name].dataType, EXACT):
            raise ValueError(f"{name} is {lines.schema[name].dataType.simpleString()}; cast it to a decimal")
    totals = [F.sum(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in sums]
    return lines.groupBy(*keys).agg(F.count("*").alias(count_name), *totals)


def rollup_deltas(
    difference: DataFrame,
    keys: Mapping[str, ColumnLike],
    sums: Mapping[str, ColumnLike],
    *,
    count_name: str = "rows",
    change_name: str = "change",
    copies_name: str = "copies",
) -> DataFrame:
    """What a ``snapshot_difference`` adds to an ``additive_rollup``: signed rows and sums per key.

    A run that looks back over rows it has read before gives a difference with what it read then, so that only
    what is new, gone or corrected counts. Reading the same rows again gives nothing.
    """
    mark = free_prefix([*difference.columns, *keys, *sums, count_name]) + "times"
    came = F.col(change_name).isin(INSERT, AFTER)
    signed = difference.withColumn(mark, F.when(came, F.col(copies_name)).otherwise(-F.col(copies_name)))
    lines = signed.select(*[as_column(c).alias(n) for n, c in {**keys, **sums}.items()], mark)
    for name in sums:
        if not isinstance(lines.schema[name].dataType, EXACT):
            raise ValueError(f"{name} is {lines.schema[name].dataType.simpleString()}; cast it to a decimal")
    totals = [F.sum(F.coalesce(F.col(n), F.lit(0)) * F.col(mark)).alias(n) for n in sums]
    return lines.groupBy(*keys).agg(F.sum(mark).alias(count_name), *totals)


def apply_deltas(rollup: DataFrame, deltas: DataFrame, keys: list[str], *, count_name: str = "rows") -> DataFrame:
    """The roll-up with the deltas added, equal to that of all rows. A key without rows left is gone.

    NULL keys count as equal. Both sides are added up in map tasks before they meet.
    """
    sums = [column for column in rollup.columns if column not in keys]
    parts = rollup.unionByName(deltas.select(*rollup.columns))
    added = parts.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(*[F.sum(f"`{c}`").alias(c) for c in sums])
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in rollup.schema.fields]
    return added.filter(F.col(count_name) != 0).select(*typed)
