"""Unions and distinct rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def align(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns in that order, and no others."""
    return df.select(*columns)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; the first frame sets the order."""
    return reduce(DataFrame.unionByName, others, first)


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all(first, *others).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each whole row once; NULLs count as equal. Duplicates go within each map task first."""
    return df.distinct()
