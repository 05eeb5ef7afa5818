"""Sources (A1, A2)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions._columns import ColumnLike, as_column


def read_entity(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "json",
    *,
    corrupt: str | None = None,
    **options: Any,
) -> DataFrame:
    """Nested records read with an explicit schema: no pass over the data to infer one.

    Fields the schema does not name are not parsed; fields it names and a record lacks are
    NULL. JSON is best kept as one record per line, so that large files can be split.

    ``corrupt`` names a column to keep the text of records in that break off or have a field of the
    wrong kind; it is NULL for all others (see ``quarantine``).
    """
    if corrupt is not None:
        declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        schema = T.StructType([*declared.fields, T.StructField(corrupt, T.StringType())])
        options = {"columnNameOfCorruptRecord": corrupt, **options}
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_table(spark: SparkSession, source: str, fmt: str | None = None, **options: Any) -> DataFrame:
    """A source that knows its own schema: files (by path), or a catalog table (by name).

    ``fmt='jdbc'`` reads a database table; give ``partitionColumn``, its bounds and
    ``numPartitions`` as options there, for else one task reads it all.
    """
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source, **options).load()
    if fmt is None and "/" not in source:
        return spark.read.options(**options).table(source)
    return spark.read.options(**options).format(fmt or "parquet").load(source)


def read_json_column(column: ColumnLike, schema: T.StructType | str) -> Column:
    """JSON text in a column as a struct of the given schema; NULL fields where it is broken."""
    return F.from_json(as_column(column), schema)
