"""What changed between two snapshots of a table, deletes included (M-1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.operators.history import of_keys
from refinery.operators.latest import orderable
from refinery.operators.names import free_prefix
from refinery.sources.sinks import land

INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_before", "update_after"


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits that tell rows apart, NULLs in different places too; equal for rows that are equal.

    Maps go in by their sorted entries, where their values can be sorted.
    """

    def plain(name: str) -> Column:
        kind, value = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, T.MapType):
            value = F.array_sort(F.map_entries(value)) if orderable(kind.valueType) else value
        # A hash passes over NULL inside of a nested value; as text it is there.
        nested = isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType))
        return F.to_json(value, {"ignoreNullFields": "false"}) if nested else value

    # So does the hash of several columns, therefore where a NULL stands is hashed as well.
    parts = [part for name in columns for part in (plain(name), F.col(f"`{name}`").isNull())]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def snapshot_difference(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    *,
    change_name: str = "change",
    copies_name: str = "copies",
) -> DataFrame:
    """The rows that two snapshots do not share, each with what became of it and how often it occurs more.

    ``change`` is ``insert`` or ``delete``, or for a key that has differing rows in both ``update_before`` and
    ``update_after``. Rows that are alike in all columns count each other out one by one, so a repeated row is a
    change by its ``copies``. A key with a NULL in it names nothing: its rows are inserts and deletes.
    Snapshots must have the same columns; values that differ only in type are cast to those of ``before``.

    Of most rows only key and digest travel, added up within each map task first. The rows that changed are then
    picked from their snapshot by key and digest, which costs in proportion to the change. Two rows with equal
    128-bit digests and keys count as alike.
    """
    if set(before.columns) != set(after.columns):
        raise ValueError(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    columns = before.columns
    after = after.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in before.schema.fields])
    mark = free_prefix([*columns, change_name, copies_name])
    digest, side, net, both, number = (f"{mark}{name}" for name in ("digest", "side", "net", "both", "n"))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn(digest, row_digest(df, columns))

    sides = [
        marked(df).select(*keys, digest, F.lit(sign).cast("bigint").alias(side)) for df, sign in ((before, -1), (after, 1))
    ]
    per_row = sides[0].unionByName(sides[1]).groupBy(*keys, digest).agg(F.sum(side).alias(net)).filter(F.col(net) != 0)
    open_rows = land(per_row)
    named = ~reduce(or_, [F.col(f"`{key}`").isNull() for key in keys])
    per_key = open_rows.filter(named).groupBy(*keys).agg((F.min(net) < 0) & (F.max(net) > 0))
    updated = per_key.toDF(*keys, both).filter(F.col(both))
    known = open_rows.join(updated, list(keys), "left").withColumn(both, F.coalesce(both, F.lit(False)))
    known = land(known)

    def picked(df: DataFrame, sign: int, alone: str, paired: str) -> DataFrame:
        wanted = known.filter(F.signum(net) == sign).select(
            F.struct(*keys, digest).alias(number), F.abs(net).alias(copies_name), F.when(F.col(both), paired).otherwise(alone).alias(change_name)
        )
        rows = marked(df)
        found = rows.join(wanted, F.struct(*[rows[f"`{k}`"] for k in keys], rows[digest]).eqNullSafe(wanted[number]))
        # Rows alike are there several times; one stands for all.
        return found.dropDuplicates([number]).select(*[F.col(f"`{c}`") for c in columns], change_name, copies_name)

    return picked(before, -1, DELETE, BEFORE).unionByName(picked(after, 1, INSERT, AFTER))


def apply_difference(
    before: DataFrame, difference: DataFrame, keys: Sequence[str], *, change_name: str = "change", copies_name: str = "copies"
) -> DataFrame:
    """The later snapshot, from the earlier one and what ``snapshot_difference`` gave.

    Rows of ``before`` that the difference takes away go, as many copies as it says; the others stay.
    """
    columns = before.columns
    mark = free_prefix([*columns, change_name, copies_name])
    digest, net = f"{mark}digest", f"{mark}net"
    gone = difference.filter(F.col(change_name).isin(DELETE, BEFORE))
    come = difference.filter(F.col(change_name).isin(INSERT, AFTER))
    added = come.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col(copies_name).cast("int"))).alias(net)).drop(net)
    away = gone.select(*keys, row_digest(gone, columns).alias(digest), (-F.col(copies_name)).alias(net))

    # Only rows of keys that lose some are counted; all else passes through.
    touched = of_keys(before, keys, gone)
    others = [c for c in columns if c not in keys]
    alike = touched.select("*", row_digest(touched, columns).alias(digest)).groupBy(*keys, digest)
    counted = alike.agg(F.count("*").alias(f"{mark}have"), *[F.first(f"`{c}`").alias(c) for c in others])
    key = [counted[f"`{k}`"].eqNullSafe(away[f"`{k}`"]) for k in keys]
    joined = counted.join(away, [*key, counted[digest] == away[digest]], "left")
    left = (F.col(f"{mark}have") + F.coalesce(away[net], F.lit(0))).cast("int")
    kept = joined.filter(left > 0).select(*[counted[f"`{c}`"] for c in columns], F.explode(F.array_repeat(F.lit(1), left)).alias(net)).drop(net)
    return of_keys(before, keys, gone, "left_anti").unionByName(kept).unionByName(added)
