"""Fixed-depth trees to adjacency lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions._columns import ColumnLike
from refinery.operators.names import free_prefix
from refinery.operators.project import project

_SEEN = ("node", "parent", "level")


def _depth(schema: T.StructType, groups: str) -> int:
    """How many levels of structs the field ``groups`` nests."""
    levels, names = 0, {field.name.lower(): field.dataType for field in schema.fields}
    while True:
        kind = names.get(groups.lower())
        if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
            return levels
        levels += 1
        names = {field.name.lower(): field.dataType for field in kind.elementType.fields}


def flatten_tree(
    df: DataFrame,
    columns: Mapping[str, ColumnLike],
    *,
    fields: Sequence[str],
    groups: str,
    depth: int | None = None,
    leaves: str | None = None,
    id_field: str = "id",
    orphans: bool = False,
) -> DataFrame:
    """One distinct row per node of the trees in ``df``, root rows included.

    Each row of ``df`` is a root. ``groups`` is the field with its child nodes, which nest as deep
    below the root as its type says; a ``depth`` that is given must not be less. ``leaves`` is a second field of children, found in the
    root and in every group, that do not nest further.

    ``columns`` is the projection. It sees the root row's own columns, ``node.<field>`` and
    ``parent.<field>`` for the ``fields`` that every node has (those of ``parent`` are NULL at
    the root), and ``level``, which is 0 for the root.

    A child without id gives no row. Its descendants are left out too, unless ``orphans``.

    The source is read once: level by level, every row so far is repeated for its children
    and once for itself. These are plain explodes, which Spark compiles, and the rows stay in
    their task. The one shuffle is that of the final distinct, which combines after it.
    """
    own = df.columns
    clash = {column.lower() for column in own} & set(_SEEN)
    if clash:
        raise ValueError(f"{sorted(clash)} are columns of the root already; rename them")
    nested = _depth(df.schema, groups)
    if depth is None:
        depth = nested
    elif depth < nested:
        raise ValueError(f"{groups} nests {nested} levels deep, not {depth}; deeper nodes would be lost")
    depth = min(depth, nested)
    mark = free_prefix(own)
    carried = list(dict.fromkeys([id_field, *fields]))
    arrays = {f"{mark}groups": groups, f"{mark}leaves": leaves} if leaves else {f"{mark}groups": groups}
    tree = df.selectExpr(
        "*",
        *[f"`{field}` as `{mark}node_{field}`" for field in carried],
        *[f"case when false then `{field}` end as `{mark}parent_{field}`" for field in carried],
        f"0 as {mark}level",
        *[f"`{field}` as {array}" for array, field in arrays.items()],
    )

    def descend(array: str, following: Mapping[str, str], known: str) -> DataFrame:
        """Every row once for itself and once for each child in ``array``; ``following`` says
        what becomes of the arrays."""
        both = f"concat(array(null), coalesce({array}, array()))"
        spread = tree.selectExpr("*", f"posexplode({both}) as ({mark}at, {mark}child)")
        return spread.filter(f"{mark}at = 0 or {known} is not null").selectExpr(
            *[f"`{column}`" for column in own],
            *[f"if({mark}at > 0, {mark}child.`{x}`, `{mark}node_{x}`) as `{mark}node_{x}`" for x in carried],
            *[f"if({mark}at > 0, `{mark}node_{x}`, `{mark}parent_{x}`) as `{mark}parent_{x}`" for x in carried],
            f"case when {mark}at > 0 then {mark}level + 1 else {mark}level end as {mark}level",
            *[f"{following[name]} as {name}" for name in arrays],
        )

    child_id = f"{mark}child.`{id_field}`"
    for level in range(depth + 1):
        if leaves:
            # A leaf has nothing below it; the row itself still has its groups.
            rest = {f"{mark}groups": f"case when {mark}at = 0 then {mark}groups end", f"{mark}leaves": "null"}
            tree = descend(f"{mark}leaves", rest, known=child_id)
        if level < depth:
            # A group brings its own arrays; the row itself is done.
            last = level + 1 == depth
            inner = {array: f"{mark}child.`{field}`" for array, field in arrays.items()}
            tree = descend(
                f"{mark}groups",
                {**inner, f"{mark}groups": "null"} if last else inner,
                known=f"{mark}child" if orphans else child_id,
            )

    def as_struct(kind: str) -> str:
        pairs = [f"'{field}', `{mark}{kind}_{field}`" for field in carried]
        return f"named_struct({', '.join(pairs)}) as {kind}"

    named = tree.filter(f"{mark}level = 0 or `{mark}node_{id_field}` is not null").selectExpr(
        *[f"`{column}`" for column in own], as_struct("node"), as_struct("parent"), f"{mark}level as level"
    )
    # Rows are spread by their whole value before the distinct, so that it works on one shuffle
    # partition at a time, which adaptive execution keeps small; combining within a map task would
    # hold every distinct row of that task's input split, and a split grows with its file.
    flat = project(named, columns)
    return flat.repartition(*[F.col(f"`{column}`") for column in flat.columns]).distinct()
