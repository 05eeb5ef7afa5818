"""Tolerant parsing of dates, times and numbers.

Raw values are text typed by people or written by other systems. Nothing here throws on a
bad value, whatever the ANSI setting: what cannot be read becomes NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column


def parse_date(value: ColumnLike) -> Column:
    """Text or timestamp to date; NULL where it is no date."""
    return as_column(value).try_cast("date")


def parse_timestamp(value: ColumnLike) -> Column:
    """Text to timestamp; an offset in the text is honoured, else the session zone counts."""
    return as_column(value).try_cast("timestamp")


def parse_int(value: ColumnLike) -> Column:
    """Text to int; a fraction is cut off ('8.0' and '8.7' are 8).

    Only text with a point takes the way through a decimal, which is slow on bad values.
    """
    number = as_column(value)
    fraction = number.try_cast("decimal(38,18)").try_cast("int")
    return F.when(F.contains(number.cast("string"), F.lit(".")), fraction).otherwise(number.try_cast("int"))


def written_date(value: ColumnLike) -> Column:
    """The calendar date as written, even if the text carries a time and an offset.

    ``2024-03-01T23:30:00-05:00`` is 1 March here, while its instant is 2 March in UTC.
    """
    return parse_date(value)


def instant_date(value: ColumnLike, zone: str | None = None) -> Column:
    """The calendar date of an instant, in ``zone`` (default: the session zone)."""
    instant = parse_timestamp(value)
    if zone is None:
        return instant.cast("date")
    wall_clock = instant.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(zone), wall_clock).cast("date")


def utc_to_local(value: ColumnLike, zone: str = "Europe/Amsterdam") -> Column:
    """A UTC time as the wall-clock time of ``zone``, daylight saving included."""
    return F.from_utc_timestamp(parse_timestamp(value), zone)


def cents_to_decimal(value: ColumnLike, precision: int = 8, scale: int = 2) -> Column:
    """Integer cents to an amount; NULL where the amount does not fit the target type."""
    cents = as_column(value).try_cast("decimal(10,0)")
    return (cents / 100).try_cast(f"decimal({precision},{scale})")


def is_recent(moment: ColumnLike, days: int, as_of: Column | str | dt.date | None = None) -> Column:
    """Does the moment lie after midnight, ``days`` days before ``as_of``?

    The bound is strict and there is no upper one: the future is recent.
    """
    return as_column(moment) > F.date_sub(as_of_date(as_of), days)


def as_of_date(as_of: Column | str | dt.date | None = None) -> Column:
    """The reference day of a run: given explicitly, else today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")
