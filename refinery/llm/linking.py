"""From shared keys to components, without ever listing all pairs of a group.

Nodes that share a key may be linked; ``verify`` knows. First every node of a key meets the key's
leader, which connects most of a group with one pair per node. Then only nodes of different
components meet, so a group that the leaders have connected gives no more pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import keep_on_disk

Verify = Callable[[DataFrame], DataFrame]


def connected_components(edges: DataFrame, *, rounds: int | None = None) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b); a component is named by its smallest node.

    With ``rounds`` it stops after so many. Nodes of one label are then of one component, but a
    component may still have several labels.

    Every round gives each node the smallest label among its neighbours' and follows that label's
    own label, so paths shorten geometrically. Labels are written to shared disk round by round and
    never come to the driver; it only sees whether any has changed. A node with very many edges is a
    hot key of joins that adaptive execution splits, and is combined before it is shuffled.
    """
    turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.where("a <> b").select(F.inline(F.array(F.struct("a", "b"), turned)))
    both = keep_on_disk(both.distinct(), "edges")
    labels = keep_on_disk(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels"
    )
    done = 0
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        lower = labels.join(heard, "node").select(
            "node", F.least("component", "heard").alias("aim"), F.col("component").alias("was")
        )
        jump = labels.select(F.col("node").alias("aim"), F.col("component").alias("further"))
        labels = keep_on_disk(
            lower.join(jump, "aim", "left").select(
                "node",
                F.least("aim", F.coalesce("further", "aim")).alias("component"),
                (F.least("aim", F.coalesce("further", "aim")) < F.col("was")).alias("changed"),
            ),
            "labels",
        )
        done += 1
        if done == rounds or labels.where("changed").limit(1).count() == 0:
            return labels.select("node", "component")
        labels = labels.select("node", "component")


def shared_only(postings: DataFrame) -> DataFrame:
    """The postings whose key occurs more than once, on shared disk; the others are most of them as a rule."""
    shared = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return keep_on_disk(postings.join(shared, "key"), "postings")


def link_to_leaders(
    postings: DataFrame,
    verify: Verify,
    *,
    near: Column | None = None,
    turn: Column | None = None,
    leaders: int = 1,
) -> DataFrame:
    """The links (a, b) of nodes with the leaders of a key of theirs, ``leaders`` pairs per node and key.

    ``postings``, a written table, has columns key, node and others that ``near`` and ``turn`` speak
    of. ``near`` says whether two nodes of a key may be linked at all, with prefixes ``a_`` and ``b_``.
    ``turn`` orders the nodes of a key: the lowest leads; by default a hash, another one for each key
    and leader. If there is a column component, nodes of one component do not meet.
    ``verify`` takes pairs (a, b) and returns those that are linked.
    """
    extra = [name for name in postings.columns if name not in ("key", "node", "component")]
    turns = [F.xxhash64("node", "key", F.lit(k)) if turn is None else turn for k in range(leaders)]
    if "component" in postings.columns:
        near = (F.lit(True) if near is None else near) & (F.col("a_component") != F.col("b_component"))
        extra.append("component")
    if leaders == 1:
        leading = postings.groupBy("key").agg(
            F.min_by("node", turns[0]).alias("b"), *(F.min_by(name, turns[0]).alias(f"b_{name}") for name in extra)
        )
    else:
        one = F.struct(F.col("node").alias("b"), *(F.col(name).alias(f"b_{name}") for name in extra))
        chosen = postings.groupBy("key").agg(F.array_distinct(F.array(*(F.min_by(one, t) for t in turns))).alias("of"))
        leading = chosen.select("key", F.inline("of"))
    first = postings.select("key", F.col("node").alias("a"), *(F.col(name).alias(f"a_{name}") for name in extra))
    met = first.join(leading, "key").where("a <> b")
    met = met if near is None else met.where(near)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return keep_on_disk(verify(pairs).select("a", "b"), "links")


def still_open(postings: DataFrame, known: DataFrame) -> DataFrame:
    """The postings of keys whose nodes are in several components, with the node's component."""
    placed = postings.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_keys = (
        placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    )
    return keep_on_disk(placed.join(open_keys.select("key"), "key"), "placed")


# Between the steps a few rounds do: a component that still has several labels only gives more pairs.
ROUNDS = 2


def link_by_keys(
    postings: DataFrame,
    verify: Verify,
    *,
    near: Column,
    enough: Column,
    turn: Column | None = None,
    details: DataFrame | None = None,
    alike: Column | None = None,
) -> DataFrame:
    """Links (a, b) of nodes that share keys: by leaders first and then across components.

    Keys get a leader by ``turn`` first, and eight by chance where that leaves several components.

    See :func:`link_to_leaders`. ``enough`` says whether two nodes with ``shared`` keys in common must
    be verified; it sees the pair's first values. ``details``, by node, are what ``alike`` speaks of: a closer test of two
    nodes than ``near``, made while nodes of different components meet, so that pairs which fail it are never rows. Leaves out links between nodes that others connect
    already, so the components are those of all links.
    """
    extra = [name for name in postings.columns if name not in ("key", "node")]
    needed = list(extra)
    sure = link_to_leaders(postings, verify, near=near, turn=turn)
    placed = still_open(postings, connected_components(sure, rounds=ROUNDS))
    if turn is not None:
        sure = keep_on_disk(sure.union(link_to_leaders(placed, verify, near=near, leaders=8)), "links")
        placed = still_open(placed.drop("component"), connected_components(sure, rounds=ROUNDS))
    if details is not None:
        extra += [name for name in details.columns if name != "node"]
        placed = keep_on_disk(placed.join(details, "node"), "placed")
        near = near & alike
    sides = [
        placed.select(
            "key",
            F.col("node").alias(side),
            F.col("component").alias(f"{side}_component"),
            *(F.col(name).alias(f"{side}_{name}") for name in extra),
        )
        for side in ("a", "b")
    ]
    pairs = sides[0].join(sides[1], "key").where("a < b AND a_component <> b_component").where(near)
    counted = pairs.groupBy("a", "b").agg(
        F.count("*").alias("shared"), *(F.first(f"{s}_{name}").alias(f"{s}_{name}") for s in "ab" for name in needed)
    )
    more = verify(counted.where(enough).select("a", "b"))
    return sure.union(more.select("a", "b"))
