"""Operators against brute force on random frames, and against the joins they stand in for."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from refinery import operators as op
from tests.frames import rows

SEEDS = [1, 2, 3]


def maybe(draw, value, share=0.2):
    return None if draw.random() < share else value


@pytest.mark.parametrize("seed", SEEDS)
def test_tree_is_a_walk(spark, seed):
    draw = random.Random(seed)

    def leaf():
        return maybe(draw, (maybe(draw, draw.randrange(30)), "leaf"), 0.1)

    def group(level):
        below = [group(level + 1) for _ in range(draw.randrange(3))] if level < 3 else None
        inner = maybe(draw, below) if level < 3 else None
        fields = (maybe(draw, draw.randrange(30)), f"g{level}", inner, maybe(draw, [leaf() for _ in range(2)]))
        return maybe(draw, fields, 0.1)

    groups = "string"
    for _ in range(3):
        groups = f"array<struct<id: int, name: string, groups: {groups}, leaves: array<struct<id: int, name: string>>>>"
    data = [
        (n, "root", maybe(draw, [group(1) for _ in range(3)]), maybe(draw, [leaf() for _ in range(2)]))
        for n in range(40)
    ]
    df = spark.createDataFrame(
        data, f"id int, name string, groups {groups}, leaves array<struct<id: int, name: string>>"
    )

    node = {"id": "node.id", "name": "node.name", "level": "level", "up": "parent.id"}

    def walk(item, level, up, orphans):
        id_, name, inner, leaves = item
        if level == 0 or id_ is not None:
            yield id_, name, level, up
        elif not orphans:
            return
        for child in leaves or []:
            if child and child[0] is not None:
                yield child[0], child[1], level + 1, id_
        for child in inner or []:
            if child:
                yield from walk(child, level + 1, id_, orphans)

    for orphans in (True, False):
        expected = {found for root in data for found in walk(root, 0, None, orphans)}
        flat = op.flatten_tree(
            df, node, fields=["name"], groups="groups", leaves="leaves", depth=3, orphans=orphans
        )
        assert rows(flat) == dict.fromkeys(expected, 1)


@pytest.mark.parametrize("seed", SEEDS)
def test_buckets_are_left_joins(spark, seed):
    """With no bucket twice in a rule, the pivot is what one join per bucket gives."""
    draw = random.Random(seed)
    data = []
    for n in range(60):
        ages = [(bucket, maybe(draw, draw.randrange(9))) for bucket in (0, 2, 13) if draw.random() < 0.6]
        data.append((f"r{n}", maybe(draw, ages)))
    df = spark.createDataFrame(data, "id string, ages array<struct<from: int, persons: int>>")
    buckets = {0: "a", 2: "b", 13: "c"}

    joined = df.select("id")
    exploded = df.select("id", F.explode("ages").alias("age"))
    for value, name in buckets.items():
        side = exploded.filter(F.col("age.from") == value).select("id", F.col("age.persons").alias(name))
        joined = joined.join(side, "id", "left")
    pivot = op.project(df, {"id": "id", **op.bucket_columns("ages", "from", "persons", buckets)})
    assert rows(pivot) == rows(joined)

    lines = op.bucket_pivot(exploded, {"id": "id"}, "age.from", buckets, "age.persons")
    assert rows(lines) == rows(joined.join(exploded.select("id").distinct(), "id", "left_semi"))


@pytest.mark.parametrize("seed", SEEDS)
def test_children_flag_is_a_count(spark, seed):
    draw = random.Random(seed)
    data = [(maybe(draw, draw.randrange(40)), maybe(draw, [None] * draw.randrange(3))) for _ in range(120)]
    df = spark.createDataFrame(data, "id int, items array<string>")
    counts = {}
    for id_, items in data:
        counts[id_] = counts.get(id_, 0) + len(items or [])
    flagged = op.has_children(df, "id", "items", "has").select("id", "has")
    expected = [(id_, id_ is not None and counts[id_] > 0) for id_, _ in data]
    assert sorted(map(str, flagged.collect())) == sorted(f"Row(id={i}, has={h})" for i, h in expected)
    counted = op.count_children(df, "id", "items", key_name="id")
    assert rows(counted) == {(id_, n): 1 for id_, n in counts.items() if n}


@pytest.mark.parametrize("seed", SEEDS)
def test_history_is_a_replay(spark, seed):
    draw = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    data = [
        (maybe(draw, draw.randrange(4), 0.1), maybe(draw, draw.choice("xyz")),
         start + dt.timedelta(minutes=draw.randrange(20_000)), n)
        for n in range(400)
    ]
    # One key holds a third of all rows.
    data += [(99, draw.choice("xy"), start + dt.timedelta(minutes=draw.randrange(9_000)), 400 + n) for n in range(200)]
    df = spark.createDataFrame(data, "k int, s string, t timestamp_ntz, n int")

    expected = []
    for key in {row[0] for row in data}:
        runs = []
        for _, state, moment, _ in sorted((r for r in data if r[0] == key), key=lambda r: (r[2], r[3])):
            if not runs or runs[-1][0] != state:
                runs.append((state, moment))
        for (state, begin), (_, end) in zip(runs, [*runs[1:], (None, None)]):
            expected.append((key, state, begin, end, end is None))
    history = op.scd2(df, ["k"], ["s"], "t", tie_break=["n"])
    assert sorted(map(str, map(tuple, history.collect()))) == sorted(map(str, expected))


@pytest.mark.parametrize("seed", SEEDS)
def test_latest_is_a_maximum(spark, seed):
    draw = random.Random(seed)
    data = [(draw.randrange(20), draw.choice("ab"), draw.randrange(6), n) for n in range(300)]
    data += [(99, "a", draw.randrange(6), 300 + n) for n in range(150)]
    df = spark.createDataFrame(data, "k1 int, k2 string, t int, n int").repartition(5)
    best = {}
    for k1, k2, t, n in data:
        best[k1, k2] = max(best.get((k1, k2), (-1, 0)), (t, -n))
    latest = op.latest_per_key(df, ["k1", "k2"], "t", tie_break=["n"])
    assert rows(latest) == {(k1, k2, t, -n): 1 for (k1, k2), (t, n) in best.items()}


@pytest.mark.parametrize("seed", SEEDS)
def test_rollup_is_a_dictionary(spark, seed):
    draw = random.Random(seed)

    def line(_):
        return maybe(draw, draw.choice("pq")), draw.randrange(100) / 100

    data = [(n, maybe(draw, [line(_) for _ in range(draw.randrange(5))])) for n in range(100)]
    df = spark.createDataFrame(data, "id int, lines array<struct<kind: string, amount: double>>")
    cents = {}
    for id_, lines in data:
        for kind, amount in lines or []:
            cents[id_ % 7, kind] = cents.get((id_ % 7, kind), 0) + round(amount * 100)
    total = op.rollup_lines(
        df, {"k": F.col("id") % 7, "kind": "line.kind"}, {"amount": "line.amount"}, arrays={"line": "lines"}
    )
    assert rows(total) == {(k, kind, n / 100): 1 for (k, kind), n in cents.items()}
