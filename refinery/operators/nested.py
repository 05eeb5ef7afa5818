"""Child arrays to line tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike
from refinery.operators.project import project, require as require_columns


def explode_children(
    df: DataFrame,
    arrays: Mapping[str, str],
    columns: Mapping[str, ColumnLike],
    *,
    require: Iterable[ColumnLike] = (),
    where: Column | None = None,
    fields: Iterable[str] = (),
) -> DataFrame:
    """One row per child, with parent and child columns side by side.

    ``arrays`` maps an alias to the path of an array; a later path may start with an earlier
    alias, which walks arrays inside arrays: ``{"rule": "rules", "age": "rule.ages"}``.
    ``columns`` is the projection; it sees the parent's columns and the aliases.
    ``require`` names columns (parent's or children's) that must not be NULL; ``where`` is a
    further condition. Both apply after the explode, which Spark compiles with them, and that
    is quicker than to filter the array beforehand.

    Parents without children give no row. The inner explode lets Spark skip such parents
    below the generator, also when ``require`` asks for the child's id.

    ``fields``, for a single array, names the child fields in use. Spark reads whole child
    structs as soon as two fields of an exploded array are used; zipping only these fields
    together keeps the scan of a columnar source to them.
    """
    clash = {alias.lower() for alias in arrays} & {column.lower() for column in df.columns}
    if clash:
        raise ValueError(f"aliases {sorted(clash)} are columns already")
    wanted = list(fields)
    if wanted and len(arrays) != 1:
        raise ValueError("fields go with a single array")

    lines = df
    for alias, path in arrays.items():
        children = F.col(path)
        if wanted:
            children = F.arrays_zip(*[F.col(f"{path}.{field}").alias(field) for field in wanted])
        lines = lines.select("*", F.explode(children).alias(alias))
    known = require_columns(lines, *require)
    return project(known if where is None else known.filter(where), columns)
