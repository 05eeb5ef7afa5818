"""Fitting a frame to a declared schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared fields, in order: missing ones NULL, undeclared ones dropped.

    Goes into structs, arrays and maps, and JSON text declared as any of these is parsed. Values that
    do not fit the declared type become NULL; a map entry whose key does not fit is dropped, and of
    keys that become equal the last entry stands.
    """
    return df.select(
        *[
            _fitted(field_of(df.schema, wanted.name), lambda name: df[f"`{name}`"], wanted.dataType).alias(wanted.name)
            for wanted in schema.fields
        ]
    )


def narrowed(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """The schema cut down to the given dotted paths, which go through structs and arrays alike.

    A columnar scan with such a schema reads these leaves only, also where Spark's own pruning stops:
    at arrays whose elements are exploded. A path to a struct keeps all of it.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head.lower(), []).append(rest)
    known = {field.name.lower() for field in schema.fields}
    if unknown := wanted.keys() - known:
        raise ValueError(f"{sorted(unknown)} are not in {schema.simpleString()}")

    def cut(kind: T.DataType, below: list[str]) -> T.DataType:
        if "" in below:
            return kind
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(cut(kind.elementType, below), kind.containsNull)
        if not isinstance(kind, T.StructType):
            raise ValueError(f"{below} lead into {kind.simpleString()}")
        return narrowed(kind, below)

    return T.StructType(
        [
            T.StructField(field.name, cut(field.dataType, wanted[field.name.lower()]), field.nullable)
            for field in schema.fields
            if field.name.lower() in wanted
        ]
    )


def field_of(given: T.StructType, name: str) -> T.StructField | None:
    """The field of that name; one that differs in case only will do if there is no other."""
    exact = [field for field in given.fields if field.name == name]
    loose = [field for field in given.fields if field.name.lower() == name.lower()]
    return next(iter(exact or loose), None)


def _fitted(given: T.StructField | None, get, wanted: T.DataType) -> Column:
    if given is None:
        return F.lit(None).cast(wanted)
    return fit_value(get(given.name), given.dataType, wanted)


def fit_value(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A value of one type as one of another; NULL where it does not fit."""
    if given.simpleString() == wanted.simpleString():
        return value
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        fields = [
            _fitted(field_of(given, field.name), value.getField, field.dataType).alias(field.name)
            for field in wanted.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda item: fit_value(item, given.elementType, wanted.elementType))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda entry: F.struct(
                fit_value(entry["key"], given.keyType, wanted.keyType).alias("key"),
                fit_value(entry["value"], given.valueType, wanted.valueType).alias("value"),
            ),
        )
        known = F.filter(entries, lambda entry: entry["key"].isNotNull())
        if given.keyType == wanted.keyType:
            return F.map_from_entries(known)
        keys = F.transform(known, lambda entry: entry["key"])
        last = F.filter(
            known, lambda entry, at: ~F.array_contains(F.slice(keys, at + 2, F.size(keys) + 1), entry["key"])
        )
        return F.map_from_entries(last)
    if isinstance(given, (T.StructType, T.ArrayType, T.MapType)):
        # A record that is deeper than declared is kept as text.
        return F.to_json(value) if isinstance(wanted, T.StringType) else F.lit(None).cast(wanted)
    if isinstance(wanted, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(value, wanted) if isinstance(given, T.StringType) else F.lit(None).cast(wanted)
    return value.try_cast(wanted)
