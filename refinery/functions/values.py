"""Value rules: defaults, ranges, classes and lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column


def const(value: Any, type_: str | None = None) -> Column:
    """A constant column; give the type for a NULL, which has none of its own."""
    literal = F.lit(value)
    return literal.cast(type_) if type_ else literal


def blank_to_null(value: ColumnLike) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def clamp_to_null(value: ColumnLike, low: Any = None, high: Any = None) -> Column:
    """The value if it lies in ``[low, high]``, else NULL; a bound left out does not apply."""
    column = as_column(value)
    inside = column.isNotNull()
    if low is not None:
        inside = inside & (column >= low)
    if high is not None:
        inside = inside & (column <= high)
    return F.when(inside, column)


def preferred_date(candidates: Iterable[ColumnLike], fallback: ColumnLike, low: Any, high: Any) -> Column:
    """The first known candidate if it is a sane date, else the fallback."""
    first_known = F.coalesce(*[as_column(candidate) for candidate in candidates])
    return F.coalesce(clamp_to_null(first_known, low, high), as_column(fallback))


def prefix_class(value: ColumnLike, length: int, allowed: Iterable[str], default: str) -> Column:
    """The first ``length`` characters if they name a known class, else ``default``."""
    prefix = F.substring(as_column(value), 1, length)
    return F.when(prefix.isin(*allowed), prefix).otherwise(F.lit(default))


def time_of_day(value: ColumnLike) -> Column:
    """The ``HH:MM:SS`` head of a written time."""
    return F.substring(as_column(value), 1, 8)


def flag(predicate: Column) -> Column:
    """A predicate as a flag that is never NULL: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def nth(array: ColumnLike, index: int) -> Column:
    """Element ``index`` (from 0) of an array; NULL past the end."""
    return F.get(as_column(array), F.lit(index))


def lookup(value: ColumnLike, mapping: Mapping[Any, Any], default: Column | Any = None) -> Column:
    """Code to label by a fixed dictionary; unknown codes take ``default``.

    A CASE chain whatever the number of entries, so codes are compared as SQL compares them and a
    known code with the label None gives NULL, not the default. The dictionary travels inside the plan, so keep it small; a dictionary that is itself a
    table belongs in ``operators.lookup_join``.
    """
    column = as_column(value)
    other = default if isinstance(default, Column) else F.lit(default)
    if not mapping:
        return other
    entries = iter(mapping.items())
    code, label = next(entries)
    case = F.when(column == code, F.lit(label))
    for code, label in entries:
        case = case.when(column == code, F.lit(label))
    return case.otherwise(other)
