"""Roots, depths and paths in trees of any depth, from rows that name their parent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column
from refinery.sources.sinks import land


def ancestry(
    df: DataFrame,
    *,
    node: ColumnLike,
    parent: ColumnLike,
    path: bool = True,
    names: tuple[str, str, str, str, str] = ("node", "root", "depth", "path", "in_cycle"),
) -> DataFrame:
    """One row per node: its root, how far it is from it, the nodes from the root down to it, and whether there is none.

    A node without parent, or whose parent is no node, is a root. A node that lies on a cycle or leads to
    one has no root, depth or path. Rows without node are left out, repeated rows count once, and a node with
    two parents is refused. ``path=False`` spares the paths, which take space in proportion to depth.

    Depth is not known beforehand and costs rounds by its logarithm: every round each node that has not found its
    root jumps to where its ancestor stands, which doubles the distance (pointer doubling). What is found is
    written to shared disk and not touched again; the driver only sees whether anything is left. A
    parent of very many nodes is a hot key of a join whose sides come from a shuffle, which adaptive execution splits, and
    children of a root are done after one round.
    """
    edges = df.select(as_column(node).alias("node"), as_column(parent).alias("up")).filter("node is not null").distinct()
    edges = land(edges)
    if twice := edges.groupBy("node").count().filter("count > 1").first():
        raise ValueError(f"{twice['node']} has {twice['count']} parents")

    above = edges.select(F.col("node").alias("known"))
    start = edges.join(above, F.col("up") == F.col("known"), "left").select(
        "node",
        F.col("known").alias("up"),
        F.when(F.col("known").isNull(), F.col("node")).alias("root"),
        F.when(F.col("known").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
        *([F.array("node").alias("path")] if path else []),
        F.lit(False).alias("looped"),
    )
    state = land(start)
    done, active = [state.filter("up is null or looped")], state.filter("up is not null")
    most, reached = edges.count(), 1
    while not active.isEmpty():
        known = reduce(DataFrame.unionByName, [*done, active]).select(*[F.col(c).alias(f"b_{c}") for c in active.columns])
        # Beyond as many steps as there are nodes, and once a node comes twice on a path, there is a cycle.
        over = F.lit(reached > most) | F.col("b_looped")
        both = F.concat("b_path", "path") if path else None
        if path:
            over = over | (F.size(F.array_distinct(both)) < F.size(both))
        joined = active.join(known, F.col("up") == F.col("b_node")).select(
            "node",
            F.when(~over, F.col("b_up")).alias("up"),
            F.when(~over, F.col("b_root")).alias("root"),
            (F.col("depth") + F.col("b_depth")).alias("depth"),
            *([F.when(~over, both).alias("path")] if path else []),
            over.alias("looped"),
        )
        state = land(joined)
        done.append(state.filter("up is null"))
        active, reached = state.filter("up is not null"), reached * 2

    columns = {"node": "node", "root": "root", "depth": "depth", "path": "path", "in_cycle": "looped"}
    found = reduce(DataFrame.unionByName, done)
    return found.select(
        *[
            (F.when(~F.col("looped"), F.col("depth")) if column == "depth" else F.col(column)).alias(name)
            for name, column in zip(names, columns.values(), strict=True)
            if column != "path" or path
        ]
    )
