"""Records that do not fit their schema, set aside cell by cell instead of losing what did not fit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.operators.names import free_name
from refinery.sources.conform import conform, field_of, fit_value
from refinery.sources.sinks import land

REJECT = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("value", T.StringType())]
)
REJECTS = T.ArrayType(REJECT, False)
BAD_VALUE, BAD_JSON, MISSING, CORRUPT = "does not fit", "is not JSON", "is missing", "is corrupt"


def _reject(path: Column, reason: str, value: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(reason).alias("reason"), value.cast("string").alias("value")).cast(REJECT)


def _one(test: Column, path: Column, reason: str, value: Column) -> Column:
    return F.when(test, F.array(_reject(path, reason, value))).otherwise(F.array().cast(REJECTS))


def _all(parts: Sequence[Column]) -> Column:
    return F.concat(*parts) if parts else F.array().cast(REJECTS)


def _text(value: Column, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(value) if nested else value.cast("string")


def _below(path: Column, name: str) -> Column:
    return F.concat(path, F.lit(f".{name}"))


def _field_rejects(given: T.StructField | None, get: Callable[[str], Column], wanted: T.StructField, path: Column) -> Column:
    if given is None:
        return _one(F.lit(not wanted.nullable), path, MISSING, F.lit(None))
    value = get(given.name)
    rejects = _rejects(value, given.dataType, wanted.dataType, path)
    return rejects if wanted.nullable else F.concat(rejects, _one(value.isNull(), path, MISSING, F.lit(None)))


def _rejects(value: Column, given: T.DataType, wanted: T.DataType, path: Column) -> Column:
    """REJECTS of a value: the cells of it that ``fit_value`` would make NULL though they are not."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    if given.simpleString() == wanted.simpleString() and _all_nullable(wanted):
        return F.array().cast(REJECTS)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        parts = [
            _field_rejects(field_of(given, field.name), value.getField, field, _below(path, field.name))
            for field in wanted.fields
        ]
        return F.when(value.isNotNull(), _all(parts)).otherwise(F.array().cast(REJECTS))
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        each = F.transform(
            value,
            lambda item, n: _rejects(item, given.elementType, wanted.elementType, F.concat(path, F.lit("["), n.cast("string"), F.lit("]"))),
        )
        return F.coalesce(F.flatten(each), F.array().cast(REJECTS))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):

        def entry_rejects(entry: Column) -> Column:
            inside = F.concat(path, F.lit("["), _text(entry["key"], given.keyType), F.lit("]"))
            return F.concat(
                _rejects(entry["key"], given.keyType, wanted.keyType, F.concat(inside, F.lit(" key"))),
                _rejects(entry["value"], given.valueType, wanted.valueType, inside),
            )

        return F.coalesce(F.flatten(F.transform(F.map_entries(value), entry_rejects)), F.array().cast(REJECTS))
    if isinstance(wanted, nested) and isinstance(given, T.StringType):
        broken = T.StructType([T.StructField("v", wanted), T.StructField("broken", T.StringType())])
        # Boxed, so that Spark reports a text that does not parse, and one with a field of the wrong kind.
        parsed = F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), broken, {"columnNameOfCorruptRecord": "broken"})
        return _one(value.isNotNull() & (parsed["broken"].isNotNull() | parsed["v"].isNull()), path, BAD_JSON, value)
    if isinstance(given, nested) and isinstance(wanted, T.StringType):
        return F.array().cast(REJECTS)
    reason = f"{BAD_VALUE} {wanted.simpleString()}"
    lost = value.isNotNull() & fit_value(value, given, wanted).isNull()
    return _one(lost, path, reason, _text(value, given))


def _all_nullable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(field.nullable and _all_nullable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _all_nullable(kind.elementType)
    return not isinstance(kind, T.MapType) or (_all_nullable(kind.keyType) and _all_nullable(kind.valueType))


def rejects(df: DataFrame, schema: T.StructType, *, corrupt: str | None = None) -> Column:
    """The cells of a row that ``conform`` would lose: ``array<struct<path,reason,value>>``, empty if there are none.

    A path goes through structs by names, through arrays by positions from 0, through maps by keys
    (``lines[2].nr``). Reasons: a value that does not fit its type, a text that is not the JSON it should be, a
    field that must not be NULL and is, and, with ``corrupt`` naming the column a reader keeps broken records in, a
    record that could not be read. Columns that the schema does not declare are no rejects.
    """
    parts = [
        _field_rejects(field_of(df.schema, field.name), lambda name: df[f"`{name}`"], field, F.lit(field.name))
        for field in schema.fields
    ]
    if corrupt is not None:
        parts.append(_one(df[f"`{corrupt}`"].isNotNull(), F.lit(""), CORRUPT, df[f"`{corrupt}`"]))
    return _all(parts)


@dataclass(frozen=True)
class Quarantine:
    """``kept``: rows that fit, as the schema has them. ``rejected``: the others as they came, with their rejects in
    a column. ``cells``: one row per reject, with the ``carried`` columns. ``counts``: rows, rejected rows and rejected cells."""

    kept: DataFrame
    rejected: DataFrame
    cells: DataFrame
    counts: dict[str, int]


def quarantine(
    df: DataFrame,
    schema: T.StructType,
    *,
    carried: Sequence[str] = (),
    corrupt: str | None = None,
    name: str = "rejects",
    landing: str | None = None,
) -> Quarantine:
    """``df`` fitted to ``schema``, with the rows of which anything would be lost set aside.

    Every row of ``df`` is in ``kept`` or in ``rejected``, once. Rows are judged in one pass, which writes them
    with their rejects to shared disk (``landing``, or below the checkpoint folder) and counts
    as it goes; what is read from the result is read from there. Nothing is shuffled.
    """
    mark = free_name(df, name)
    seen = Observation()
    judged = df.withColumn(mark, rejects(df, schema, corrupt=corrupt))
    bad = F.size(mark) > 0
    judged = judged.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(bad, 1)).alias("rejected"),
        F.coalesce(F.sum(F.size(mark)), F.lit(0)).alias("cells"),
    )
    stored = land(judged, landing)
    rejected = stored.filter(bad)
    cells = rejected.select(*[F.col(f"`{c}`") for c in carried], F.inline(mark))
    kept = conform(stored.filter(~bad).drop(mark), schema)
    return Quarantine(kept, rejected, cells, {key: int(count) for key, count in seen.get.items()})
