"""The latest record per key (G1, H1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions._columns import ColumnLike, as_column
from refinery.operators.names import free_name


def orderable(type_: T.DataType) -> bool:
    """Whether Spark can sort values of this type."""
    if isinstance(type_, T.ArrayType):
        return orderable(type_.elementType)
    if isinstance(type_, T.StructType):
        return all(orderable(field.dataType) for field in type_.fields)
    return not isinstance(type_, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[ColumnLike],
    order_by: ColumnLike,
    *,
    tie_break: Sequence[ColumnLike] | None = None,
    null_keys: str = "collapse",
) -> DataFrame:
    """The row with the highest ``order_by`` of each key; NULL counts as lowest.

    Ties go to the smallest ``tie_break`` values, by default all columns in order, so that
    a task that is run again picks the same row.

    ``null_keys`` says what becomes of rows with a NULL in their key: ``collapse`` treats
    NULL as a key of its own (one row survives), ``keep`` keeps them all, ``drop`` none.

    Spark cuts each key to one row per map task before the shuffle (WindowGroupLimit), so a
    key that holds a third of all rows arrives as one row per task.
    """
    if null_keys not in ("collapse", "keep", "drop"):
        raise ValueError(f"null_keys must be 'collapse', 'keep' or 'drop', not {null_keys!r}")
    key_columns = [as_column(key) for key in keys]
    if tie_break is None:
        ties: list[Column] = [F.col(f"`{field.name}`") for field in df.schema if orderable(field.dataType)]
    else:
        ties = [as_column(column) for column in tie_break]

    ranked, loose = df, None
    if null_keys != "collapse":
        incomplete = reduce(or_, [key.isNull() for key in key_columns])
        ranked = df.filter(~incomplete)
        loose = df.filter(incomplete) if null_keys == "keep" else None

    order = Window.partitionBy(*key_columns).orderBy(
        as_column(order_by).desc_nulls_last(), *[tie.asc_nulls_last() for tie in ties]
    )
    rank = free_name(df, "_rank")
    latest = ranked.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)
    return latest if loose is None else latest.unionByName(loose)
