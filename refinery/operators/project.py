"""Projections and row filters (A6, B1-B9, C1, C4). All of them are narrow: no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column
from refinery.functions.parsing import as_of_date, is_recent


def project(df: DataFrame, columns: Mapping[str, ColumnLike]) -> DataFrame:
    """A closed column list: output name -> source column, dotted struct path, or expression.

    A closed list, rather than ``*``, is what lets the scan read only what is used.
    """
    return df.select(*[as_column(source).alias(name) for name, source in columns.items()])


def rekey(
    df: DataFrame,
    key: Column,
    *,
    name: str = "Id",
    first: Iterable[str] = (),
    drop: Iterable[str] = (),
) -> DataFrame:
    """A new key in front, then ``first``, then every other column but ``drop``.

    No column name appears twice. Names are compared as Spark does, without case: a source
    column that would clash with the key keeps its values under ``<column>_source``.
    """
    lead = list(first)
    taken = {column.lower() for column in [*lead, *drop]}
    rest = [column for column in df.columns if column.lower() not in taken]
    used = {column.lower() for column in [name, *lead]} | {column.lower() for column in rest}

    def kept(column: str) -> Column:
        source = F.col(f"`{column}`")
        if column.lower() != name.lower():
            return source
        renamed = f"{column}_source"
        if renamed.lower() in used:
            raise ValueError(f"{column} clashes with the key {name}, and {renamed} is taken; drop one")
        return source.alias(renamed)

    return df.select(key.alias(name), *[F.col(f"`{column}`") for column in lead], *map(kept, rest))


def require(df: DataFrame, *columns: ColumnLike) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    for column in columns:
        df = df.filter(as_column(column).isNotNull())
    return df


def recent(
    df: DataFrame, moment: ColumnLike, days: int, as_of: Column | str | dt.date | None = None
) -> DataFrame:
    """Rows whose moment ``is_recent``. The bound is a constant, so that on a stored column the
    filter reaches the scan."""
    return df.filter(is_recent(moment, days, as_of))


def stamp(
    df: DataFrame,
    as_of: Column | str | dt.date | None = None,
    *,
    date_name: str = "snapshot_date",
    added_name: str | None = "added_at",
    added_at: Column | None = None,
) -> DataFrame:
    """Load stamps: the day of the snapshot and the moment the rows were added."""
    stamps = {date_name: as_of_date(as_of)}
    if added_name:
        stamps[added_name] = F.current_timestamp() if added_at is None else added_at
    return df.withColumns(stamps)


def with_context(df: DataFrame, **values: Any) -> DataFrame:
    """Columns that ingestion knows and the payload does not: tenant, parent request, batch."""
    return df.withColumns(
        {name: value if isinstance(value, Column) else F.lit(value) for name, value in values.items()}
    )
