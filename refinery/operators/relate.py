"""Relations between rows: children, parents, dimension labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column
from refinery.functions.values import flag
from refinery.operators.names import free_name


def distinct_keys(df: DataFrame, keys: Mapping[str, ColumnLike]) -> DataFrame:
    """The distinct keys of ``df``, to be joined on; output name -> column.

    A join right above a distinct would take over its partitioning. But adaptive execution
    splits a hot key only where both sides of a join come straight from a shuffle, so the
    distinct works on the keys boxed in one struct, and the join shuffles them once more: a
    small price, as only distinct keys travel.
    """
    boxed = df.select(F.struct(*[as_column(column).alias(name) for name, column in keys.items()]).alias("_keys"))
    return boxed.distinct().select(*[F.col("_keys").getField(name).alias(name) for name in keys])


def has_children(
    df: DataFrame, key: ColumnLike, array: ColumnLike, name: str, *, unique_key: bool = False
) -> DataFrame:
    """``df`` with a flag: does any row with this key have children in ``array``?

    A NULL key matches nothing, so its flag is false. With ``unique_key`` the caller vouches
    that no key occurs twice, and the flag is read from the row itself without a shuffle.
    Otherwise the keys that have children are made distinct and joined; only keys travel on
    that side, and adaptive execution splits a hot key, or the NULL key, on the other.
    """
    own = flag(as_column(key).isNotNull() & (F.size(as_column(array)) > 0))
    if unique_key:
        return df.withColumn(name, own)
    parent = free_name(df, "_parent")
    parents = distinct_keys(df.filter(own), {parent: key})
    joined = df.join(parents, as_column(key) == F.col(parent), "left")
    return joined.withColumn(name, F.col(parent).isNotNull()).drop(parent)


def with_parent(
    df: DataFrame,
    *,
    key: ColumnLike,
    parent_key: ColumnLike,
    name: ColumnLike,
    parent_key_name: str = "parent_key",
    parent_name: str = "parent_name",
    unique_key: bool = False,
) -> DataFrame:
    """``df`` with the key and name of each row's parent in the same table.

    A row without parent, or whose parent is not there, gets a NULL key and its own name, so
    it stands as a root. Repeated (key, name) pairs are looked up once; ``unique_key`` promises
    that no key repeats, which saves a shuffle. Whether the lookup side is broadcast is left to
    Spark, which knows its size; beyond the threshold it is a sort-merge join in which adaptive
    execution splits hot parents and the NULL parent.
    """
    above, title = free_name(df, "_key"), free_name(df, "_name")
    parents = df.select(as_column(key).alias(above), as_column(name).alias(title))
    parents = parents.filter(F.col(above).isNotNull())
    if not unique_key:
        parents = parents.distinct()
    joined = df.join(parents, as_column(parent_key) == F.col(above), "left")
    return joined.withColumns(
        {parent_key_name: F.col(above), parent_name: F.coalesce(F.col(title), as_column(name))}
    ).drop(above, title)


def lookup_join(
    df: DataFrame,
    dimension: DataFrame,
    *,
    on: ColumnLike,
    code: str,
    label: str,
    name: str,
    default: Column | None = None,
) -> DataFrame:
    """``df`` with the label of its code, from a dictionary that is a table.

    The dictionary must hold each code once. Unknown codes take ``default``.
    """
    known, said = free_name(df, "_code"), free_name(df, "_label")
    entries = dimension.select(F.col(code).alias(known), F.col(label).alias(said))
    joined = df.join(entries, as_column(on) == F.col(known), "left")
    found = F.col(said) if default is None else F.coalesce(F.col(said), default)
    return joined.withColumn(name, found).drop(known, said)
