"""Counts, sums and bucket pivots over lines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions._columns import ColumnLike, as_column
from refinery.operators.names import free_prefix
from refinery.operators.nested import explode_children
from refinery.operators.project import project

# The measure of the entries that match; the highest and the lowest pass over NULL.
_PICKS = {
    "max": lambda array, match, value: F.array_max(F.transform(array, lambda e: F.when(match(e), value(e)))),
    "min": lambda array, match, value: F.array_min(F.transform(array, lambda e: F.when(match(e), value(e)))),
    "first": lambda array, match, value: value(F.get(F.filter(array, match), F.lit(0))),
    "sum": lambda array, match, value: F.when(
        F.exists(array, lambda e: match(e) & value(e).isNotNull()),
        F.aggregate(F.filter(array, match), F.lit(0).cast("double"), lambda total, e: total + F.coalesce(value(e), F.lit(0))),
    ),
}
_AGGREGATES = {"max": F.max, "min": F.min, "sum": F.sum}


def count_children(
    df: DataFrame, key: ColumnLike, array: ColumnLike, *, key_name: str, count_name: str = "count"
) -> DataFrame:
    """Children per key, for keys that have any.

    Array sizes are added up, so nothing is exploded and one number per row is shuffled at
    most; parents that share a key are counted together.
    """
    size = free_prefix([key_name, count_name]) + "size"
    sizes = df.select(as_column(key).alias(key_name), F.size(F.coalesce(as_column(array), F.array())).alias(size))
    return (
        sizes.filter(F.col(size) > 0)
        .groupBy(key_name)
        .agg(F.sum(F.col(size).cast("bigint")).alias(count_name))
    )


# Numbers below 10^9 with up to six decimals have at most fifteen digits, which a double holds exactly.
_MILLION, _FIFTEEN_DIGITS = 1e6, 1e15


def line_sum(value: ColumnLike, type_: T.DataType) -> Column:
    """A sum that does not depend on the order of the rows, and rounds nothing before adding.

    Floating-point lines are added in their decimal digits; the total is given back as double. A value with up to
    six decimals, below 10^9, is added as two whole numbers, millionths and the rest, which costs little more than
    a plain sum. Others are added as decimals: the value to six digits, and what that leaves of it to thirty,
    each exactly. Values that no such decimal can hold (NaN, infinity, 1e22 and up) are added as they are, and so are
    all of these if the decimals run over. Other types use Spark's own sum.
    """
    column = as_column(value)
    if not isinstance(type_, (T.DoubleType, T.FloatType)):
        return F.sum(column)
    column = column.cast("double")
    millionths = F.rint(column * _MILLION)
    short = (F.abs(millionths) < _FIFTEEN_DIGITS) & (millionths / _MILLION == column)
    number = F.when(short, millionths.try_cast("bigint"))
    # Both stay below 10^9 a row, so that no group in reach runs over.
    whole = F.sum(F.call_function("div", number, F.lit(1_000_000).cast("bigint")))
    parts = F.sum(number % F.lit(1_000_000).cast("bigint"))
    digits = whole.try_cast("decimal(28,6)") + (parts.cast("decimal(20,0)") * F.lit(1e-6).cast("decimal(6,6)"))

    long = F.when(~short, column)
    near = long.try_cast("decimal(28,6)")

    def beyond_six_digits(scale: int) -> Column:
        cut = f"decimal(38,{scale})"
        return (long.try_cast(cut) - near.try_cast(cut)).try_cast("decimal(38,30)")

    # Numbers from 1e8 on have no digits beyond the fifteenth.
    rest = F.coalesce(beyond_six_digits(30), beyond_six_digits(15))
    long_high, low = F.try_sum(near), F.try_sum(rest)
    high = F.coalesce(F.try_add(long_high, digits), long_high, digits)
    # Added as decimals where both fit, so that the total is rounded once.
    joined = (high.try_cast("decimal(38,18)") + low.try_cast("decimal(38,18)")).cast("double")
    total = (
        F.when(low.isNull(), high.cast("double"))
        .when(high == 0, low.cast("double"))
        .otherwise(F.coalesce(joined, high.cast("double") + low.cast("double")))
    )
    ran_over = (F.count(near) > 0) & (long_high.isNull() | low.isNull())
    as_they_are = F.sum(F.when(near.isNotNull(), long))
    exact = F.when(ran_over, F.coalesce(as_they_are + digits.cast("double"), as_they_are)).otherwise(total)
    beyond = F.sum(F.when(near.isNull(), long))
    return F.coalesce(exact + beyond, exact, beyond)


def rollup_lines(
    df: DataFrame,
    keys: Mapping[str, ColumnLike],
    sums: Mapping[str, ColumnLike],
    *,
    arrays: Mapping[str, str] | None = None,
    require: Iterable[ColumnLike] = (),
) -> DataFrame:
    """Lines with equal keys made one, their measures summed.

    Lines come from ``arrays`` (see ``explode_children``), or are the rows of ``df``. NULL
    keys count as equal and sums pass over NULL. Spark adds up within each map task first,
    so a hot key ships one row per task.
    """
    columns = {**keys, **sums}
    if arrays:
        lines = explode_children(df, arrays, columns, require=require)
    else:
        lines = project(df, columns)
    totals = [line_sum(name, lines.schema[name].dataType).alias(name) for name in sums]
    return lines.groupBy(*keys).agg(*totals)


def bucket_columns(
    array: ColumnLike,
    bucket: str,
    measure: str,
    buckets: Mapping[Any, str],
    *,
    pick: str = "max",
    when: Column | None = None,
) -> dict[str, Column]:
    """One column per known bucket, from an array of ``{bucket, measure}`` in the same row.

    A bucket that is absent gives NULL, and so does every bucket where ``when`` fails. Where
    a bucket occurs more than once, ``pick`` (max, min, first, sum) says which measure counts, so
    the row is never multiplied; sums are doubles. Needs neither join nor shuffle.
    """
    source, chosen = as_column(array), _PICKS[pick]

    def column(value: Any) -> Column:
        measured = chosen(source, lambda entry: entry[bucket] == F.lit(value), lambda entry: entry[measure])
        return measured if when is None else F.when(when, measured)

    return {name: column(value) for value, name in buckets.items()}


def bucket_pivot(
    df: DataFrame,
    keys: Mapping[str, ColumnLike],
    bucket: ColumnLike,
    buckets: Mapping[Any, str],
    measure: ColumnLike,
    *,
    agg: str = "max",
) -> DataFrame:
    """One row per key and one column per known bucket, from a flat table of lines.

    The buckets are given, so no pass is needed to find them, and one shuffle serves all.
    """
    which, value, aggregate = as_column(bucket), as_column(measure), _AGGREGATES[agg]
    cells = [
        aggregate(F.when(which == F.lit(code), value)).alias(name) for code, name in buckets.items()
    ]
    return df.groupBy(*[as_column(source).alias(name) for name, source in keys.items()]).agg(*cells)
