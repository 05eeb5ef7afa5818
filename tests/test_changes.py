"""Late changes, snapshot differences, deep trees, quarantines and tables of which only touched parts are rewritten."""

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import operators as op
from refinery import sources
from tests.frames import nodes, rows

DAY = dt.datetime(2024, 1, 1)


def at(n):
    return DAY + dt.timedelta(days=n)


def changes(seed, n, keys=("a", "b", None), states=("x", "y", None)):
    rnd = random.Random(seed)
    return [(rnd.choice(keys), rnd.choice(states), at(rnd.randrange(30)), k) for k in range(n)]


SCHEMA = "k string, state string, ts timestamp, nr int"


def history_of(events):
    """Runs of unchanged states per key, by plain counting; events are (key, state, moment, order...)."""
    out = []
    for key in {e[0] for e in events}:
        mine = sorted((e for e in events if e[0] == key), key=lambda e: e[2:])
        starts = [e for n, e in enumerate(mine) if n == 0 or mine[n - 1][1] != e[1]]
        ends = [*(e[2] for e in starts[1:]), None]
        out += [(key, e[1], e[2], end, end is None) for e, end in zip(starts, ends, strict=True)]
    return Counter(out)


@pytest.mark.parametrize("seed", range(4))
def test_late_changes_with_the_log_equal_all_changes(spark, seed):
    old, late = changes(seed, 60), [(k, s, t, 1000 + n) for k, s, t, n in changes(100 + seed, 12, keys=("a", "new"))]
    log, new = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(late, SCHEMA)
    stored = op.scd2(log, ["k"], ["state"], "ts", tie_break=["nr"])
    merged = op.merge_history(stored, new, ["k"], ["state"], "ts", tie_break=["nr"], log=log, slices=5)
    assert merged.columns == ["k", "state", "valid_from", "valid_to", "is_current"]
    assert rows(merged) == history_of(old + late) == rows(op.scd2(log.union(new), ["k"], ["state"], "ts", tie_break=["nr"]))


@pytest.mark.parametrize("seed", range(4))
def test_late_changes_split_stored_runs(spark, seed):
    old, late = changes(seed, 40), changes(200 + seed, 9, keys=("a", None, "new"))
    stored = op.scd2(spark.createDataFrame(old, SCHEMA), ["k"], ["state"], "ts", tie_break=["nr"])
    merged = op.merge_history(stored, spark.createDataFrame(late, SCHEMA), ["k"], ["state"], "ts", tie_break=["nr"], slices=4)
    starts = [(r.k, r.state, r.valid_from, 0, n) for n, r in enumerate(stored.orderBy("valid_from", "valid_to").collect())]
    known = {(r[0], r[1], r[2]): r for r in starts}
    # Stored starts of one moment keep the order they had; each ends where the next begins.
    ordered = sorted(known.values(), key=lambda r: r[2])
    if len(ordered) == len({(r[0], r[2]) for r in ordered}):
        events = [(k, s, t, 0, n) for n, (k, s, t, *_) in enumerate(ordered)] + [(k, s, t, 1, n) for k, s, t, n in late]
        assert rows(merged) == history_of(events)
    untouched = {r for r in rows(stored) if r[0] == "b"}
    assert untouched == {r for r in rows(merged) if r[0] == "b"}


def test_one_late_change_in_the_middle(spark):
    stored = op.scd2(spark.createDataFrame([("a", "x", at(0), 0), ("a", "y", at(9), 0)], SCHEMA), ["k"], ["state"], "ts")
    one = [("a", "z", at(4), 0)]
    merged = op.merge_history(stored, spark.createDataFrame(one, SCHEMA), ["k"], ["state"], "ts")
    assert rows(merged) == {
        ("a", "x", at(0), at(4), False): 1, ("a", "z", at(4), at(9), False): 1, ("a", "y", at(9), None, True): 1
    }
    same = op.merge_history(stored, spark.createDataFrame([("a", "x", at(3), 0)], SCHEMA), ["k"], ["state"], "ts")
    assert rows(same) == rows(stored)
    joined = op.merge_history(stored, spark.createDataFrame([("a", "y", at(5), 0)], SCHEMA), ["k"], ["state"], "ts")
    assert rows(joined) == {("a", "x", at(0), at(5), False): 1, ("a", "y", at(5), None, True): 1}
    none = spark.createDataFrame([], SCHEMA)
    assert rows(op.merge_history(stored, none, ["k"], ["state"], "ts")) == rows(stored)
    assert rows(op.merge_history(stored.filter("false"), none.union(spark.createDataFrame(one, SCHEMA)), ["k"], ["state"], "ts")) == {
        ("a", "z", at(4), None, True): 1
    }


HELPERS = "slice same first next edge group carried change later at".split()


@pytest.mark.parametrize("role", ["k", "state", "ts", "nr"])
@pytest.mark.parametrize("name", HELPERS)
def test_history_keeps_columns_named_as_its_helpers(spark, role, name):
    events = changes(5, 15, keys=("a", "b"))
    for helper in (name, f"_{name}"):
        frame = spark.createDataFrame(events, SCHEMA).withColumnRenamed(role, helper)
        names = [helper if c == role else c for c in ("k", "state", "ts", "nr")]
        got = op.scd2(frame, [names[0]], [names[1]], names[2], tie_break=[names[3]], slices=3)
        assert rows(got) == history_of(events)
        if role != "k":
            break


def test_history_refuses_its_own_names(spark):
    frame = spark.createDataFrame([("a", "x", at(0))], "k string, valid_to string, ts timestamp")
    with pytest.raises(ValueError, match="valid_to"):
        op.scd2(frame, ["k"], ["valid_to"], "ts")


@pytest.mark.parametrize("name", ["_size", "size", "__size", "n"])
def test_count_children_takes_any_key_name(spark, name):
    frame = spark.createDataFrame([("a", [1, 2]), ("a", [3]), ("b", [])], "id string, c array<int>")
    assert rows(op.count_children(frame, "id", "c", key_name=name, count_name=f"_{name}")) == {("a", 3): 1}


def test_upsert_ranks_the_updates_once(spark, tmp_path):
    changes_ = spark.createDataFrame(changes(1, 30), SCHEMA)
    changes_.write.parquet(str(tmp_path / "u"))
    stored = spark.read.parquet(str(tmp_path / "u"))
    merged = op.upsert(stored, stored, ["k"], "ts")
    assert nodes(merged, "Window") == 1 + nodes(merged, "WindowGroupLimit")


# --- differences of snapshots ---------------------------------------------------------------

SNAP = "id int, name string, tags array<string>, m map<string,int>, change string"


def snapshot(seed):
    rnd = random.Random(seed)
    out = []
    for k in [*range(20), None, None]:
        for _ in range(rnd.choice([0, 1, 1, 1, 2, 3])):
            tags = rnd.choice([None, [], ["x", None], ["x"]])
            out.append((k, rnd.choice(["p", "q", None]), tags, rnd.choice([None, {"a": 1, "b": 2}, {"b": 2, "a": 1}]), "own"))
    return out


def plain(row):
    return (row[0], row[1], None if row[2] is None else tuple(row[2]), None if row[3] is None else tuple(sorted(row[3].items())), row[4])


def difference_of(before, after):
    old, new = Counter(map(plain, before)), Counter(map(plain, after))
    gone, come = old - new, new - old
    out = Counter()
    for one, other, alone, paired in ((gone, come, "delete", "update_before"), (come, gone, "insert", "update_after")):
        for row, n in one.items():
            both = row[0] is not None and any(r[0] == row[0] for r in other)
            out[(*row, paired if both else alone, n)] += 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_snapshot_difference_and_back(spark, seed):
    before, after = snapshot(seed), snapshot(seed) if seed == 3 else snapshot(seed + 50)
    old, new = spark.createDataFrame(before, SNAP).repartition(3), spark.createDataFrame(after, SNAP).repartition(2)
    diff = op.snapshot_difference(old, new, ["id"], change_name="what")
    got = Counter((*plain(r), r["what"], r["copies"]) for r in diff.collect())
    assert got == difference_of(before, after)
    assert (not got) == (seed == 3)
    flat = ["id", "name", "tags", "change"]
    small = op.snapshot_difference(old.select(*flat), new.select(*flat), ["id"], change_name="what")
    back = op.apply_difference(old.select(*flat), small, ["id"], change_name="what")
    assert Counter(map(str, back.collect())) == Counter(map(str, new.select(*flat).collect()))


def test_difference_tells_nulls_and_types_apart(spark):
    old = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "x", "y")], "id int, a string, b string")
    new = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "x", "y")], "id long, a string, b string")
    got = op.snapshot_difference(old, new, ["id"])
    assert {(r["id"], r["change"]) for r in got.collect()} == {(1, "update_before"), (1, "update_after")}
    assert got.schema["id"].dataType == T.IntegerType()
    with pytest.raises(ValueError, match="extra"):
        op.snapshot_difference(old, new.withColumn("extra", F.lit(1)), ["id"])
    assert op.snapshot_difference(old.filter("false"), old.filter("false"), ["id"]).count() == 0


# --- trees of any depth ---------------------------------------------------------------------


def climbed(pairs):
    """(node, root, depth, path, in_cycle) by walking up."""
    up = dict(pairs)
    out = []
    for node in up:
        walk, seen = [node], {node}
        while (above := up[walk[-1]]) in up and above not in seen:
            walk.append(above)
            seen.add(above)
        if up[walk[-1]] in seen:
            out.append((node, None, None, None, True))
        else:
            out.append((node, walk[-1], len(walk) - 1, walk[::-1], False))
    return out


TREES = {
    "chain": [(k, k - 1 if k else None) for k in range(1000)],
    "cycles": [(1, 1), (2, 3), (3, 2), (4, 3), (5, 4), (6, None), (7, 6), (8, 99), (9, 8), *((k, k + 1 if k < 29 else 20) for k in range(20, 30))],
    "star": [(0, None), *((k, 0) for k in range(1, 300))],
    "heap": [(k, k // 2 or None) for k in range(1, 400)],
    "empty": [],
}


@pytest.mark.parametrize("path", [True, False])
@pytest.mark.parametrize("name", TREES)
def test_ancestry(spark, name, path):
    pairs = TREES[name]
    frame = spark.createDataFrame([*pairs, *pairs[:3], (None, 1)], "id int, above int").withColumn("root", F.lit("own"))
    got = op.ancestry(frame, node="id", parent="above", path=path)
    want = climbed(pairs)
    if not path:
        want = [row[:3] + row[4:] for row in want]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_ancestry_refuses_two_parents(spark):
    with pytest.raises(ValueError, match="2 parents"):
        op.ancestry(spark.createDataFrame([(1, 2), (1, 3)], "id int, above int"), node="id", parent="above")


# --- quarantine -----------------------------------------------------------------------------

WANTED = (
    "id int not null, amount decimal(6,2), day date, inner struct<n: int, tags: array<int>>, lines array<struct<nr: int, name: string>>, "
    "m map<int, int>, doc struct<a: int>, list array<int>, text string"
)
GIVEN = (
    "id string, amount string, day string, inner struct<n: string, tags: array<string>>, lines array<struct<nr: string, name: string>>, "
    "m map<string, string>, doc string, list string, text struct<x: int>, extra string"
)


def test_quarantine(spark, tmp_path):
    good = ("1", "12.5", "2024-02-29", ("3", ["1", None]), [("1", "a"), None], {"1": "2"}, '{"a": 1}', "[1, 2]", (1,), "e")
    empty = ("2", None, None, None, None, None, None, None, None, None)
    bad = ("x", "12345678", "2024-02-30", ("y", ["1", "z"]), [("1", "a"), ("q", "b")], {"k": "v", "1": "w"}, '{"a": ', "[1", None, "e")
    wrong_kind = ("3", "1", None, None, None, None, '{"a": "no"}', '{"a": 1}', None, None)
    wanted = T.StructType.fromDDL(WANTED)
    frame = spark.createDataFrame([good, empty, bad, wrong_kind, (None, *empty[1:])], GIVEN)
    got = sources.quarantine(frame, wanted, carried=["extra"], landing=str(tmp_path / "q"))
    assert got.kept.columns == wanted.names and {r["id"] for r in got.kept.collect()} == {1, 2}
    assert got.counts == {"rows": 5, "rejected": 3, "cells": got.cells.count()}
    back = got.rejected.drop("rejects").union(frame.join(got.kept.selectExpr("cast(id as string) as kid"), F.col("id") == F.col("kid"), "left_semi"))
    assert Counter(map(str, back.collect())) == Counter(map(str, frame.collect()))
    cells = {(r["path"], r["value"]): r["reason"] for r in got.cells.filter("extra = 'e'").collect()}
    assert cells == {
        ("id", "x"): "does not fit int", ("amount", "12345678"): "does not fit decimal(6,2)", ("day", "2024-02-30"): "does not fit date",
        ("inner.n", "y"): "does not fit int", ("inner.tags[1]", "z"): "does not fit int",
        ("lines[1].nr", "q"): "does not fit int", ("m[k] key", "k"): "does not fit int", ("m[k]", "v"): "does not fit int",
        ("m[1]", "w"): "does not fit int", ("doc", '{"a": '): "is not JSON", ("list", "[1"): "is not JSON",
    }
    others = {(r["path"], r["value"], r["reason"]) for r in got.cells.filter("extra is null").collect()}
    assert others == {("doc", '{"a": "no"}', "is not JSON"), ("list", '{"a": 1}', "is not JSON"), ("id", None, "is missing")}
    assert sources.quarantine(frame.filter("false"), wanted).counts == {"rows": 0, "rejected": 0, "cells": 0}


def test_quarantine_of_records_that_break_off(spark, tmp_path):
    path = tmp_path / "r"
    path.mkdir()
    (path / "a.json").write_text('{"id": 1, "nr": 2}\n{"id": 2, "nr": "x"}\n{"id": 3, "n\n{"id": 4}\n')
    schema = T.StructType.fromDDL("id int, nr int")
    read = sources.read_entity(spark, str(path), schema, corrupt="rejects")
    got = sources.quarantine(read, schema, corrupt="rejects")
    assert rows(got.kept) == {(1, 2): 1, (4, None): 1}
    assert {r["value"] for r in got.cells.collect()} == {'{"id": 2, "nr": "x"}', '{"id": 3, "n'}
    assert got.rejected.count() == 2 and got.counts["rows"] == 4


# --- tables in buckets ----------------------------------------------------------------------


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.createDataFrame([(k, f"v{k}", 0) for k in range(200)] + [(None, "n", 0)], "id int, v string, ts int")
    sources.write_keyed(target, path, ["id"], buckets=16)
    assert rows(sources.read_keyed(spark, path)) == rows(target)
    before = files(path)
    updates = spark.createDataFrame([(3, "new", 2), (3, "older", 1), (1000, "added", 1)], "id int, v string, ts int")
    touched = sources.upsert_table(path, updates, ["id"], "ts", buckets=16)
    assert 1 <= len(touched) <= 2
    assert rows(sources.read_keyed(spark, path)) == rows(op.upsert(target, updates, ["id"], "ts"))
    after = files(path)
    kept = {name for name in before if not any(f"key_bucket={b}/" in name for b in touched)}
    assert kept and all(after.get(name) == before[name] for name in kept)
    assert not any(name in after for name in before.keys() - kept)
    assert sources.upsert_table(path, updates.filter("false"), ["id"], "ts", buckets=16) == []
    assert files(path) == after


def test_history_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "h")
    old = changes(9, 120, keys=[f"k{n}" for n in range(40)])
    log = spark.createDataFrame(old, SCHEMA)
    sources.write_keyed(op.scd2(log, ["k"], ["state"], "ts", tie_break=["nr"]), path, ["k"], buckets=8)
    before = files(path)
    late = [("k1", "z", at(3), 500), ("k999", "z", at(3), 501)]
    new = spark.createDataFrame(late, SCHEMA)
    touched = sources.merge_history_table(path, new, ["k"], ["state"], "ts", tie_break=["nr"], log=log, buckets=8)
    assert rows(sources.read_keyed(spark, path)) == history_of(old + late)
    kept = {name for name in before if not any(f"key_bucket={b}/" in name for b in touched)}
    assert kept and all(files(path).get(name) == before[name] for name in kept)


# --- foreign keys ---------------------------------------------------------------------------


@pytest.mark.parametrize("words", [1, 1 << 21, 0])
def test_orphans(spark, monkeypatch, words):
    from refinery.operators import references

    monkeypatch.setattr(references, "MOST_WORDS", words)
    rnd = random.Random(3)
    lines = [(n, rnd.choice([None, *range(300)]), f"o{rnd.randrange(4)}", "own") for n in range(2000)]
    children = spark.createDataFrame(lines, "n int, fk int, other string, rows string")
    parents = spark.createDataFrame([(k, f"o{k}") for k in [*range(0, 300, 2), 1, 1, None]], "id long, name string")
    relations = {"fk": op.Relation("fk", parents, "id"), "other": op.Relation("other", parents, "name")}
    known = {r[0] for r in parents.collect()}
    want = Counter(fk for _, fk, *_ in lines if fk is not None and fk not in known)
    assert {r["key"]: r["rows"] for r in op.orphans(children, relations["fk"]).collect()} == want
    report = {(r["relation"], r["key"]): r["rows"] for r in op.orphan_report(children, relations).collect()}
    others = Counter(o for _, _, o, _ in lines if o == "o3")
    assert report == {("fk", str(k)): n for k, n in want.items()} | {("other", k): n for k, n in others.items() if k not in {"o1"}} | (
        {} if not others else {("other", "o3"): others["o3"]}
    )
    got = op.orphan_rows(children, relations["fk"])
    assert got.columns == children.columns
    assert rows(got) == Counter(line for line in lines if line[1] in want)
    assert op.orphan_rows(children, op.Relation("fk", children, "fk")).count() == 0


def test_rows_with_parents_stay_where_they_are(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    spark.range(5000).selectExpr("id", "id % 1000 as fk").write.parquet(str(tmp_path / "c"))
    spark.range(999).selectExpr("id as key").write.parquet(str(tmp_path / "p"))
    children, parents = (spark.read.parquet(str(tmp_path / name)) for name in "cp")
    found = op.orphan_rows(children, op.Relation("fk", parents, "key"))
    assert nodes(found, "BroadcastHashJoin") == 1
    assert sorted(r["id"] for r in found.collect()) == [999, 1999, 2999, 3999, 4999]
    # Rows are shuffled behind the filter only: their exchange lies above the broadcast join.
    text = found._jdf.queryExecution().executedPlan().toString()
    own = next(line for line in text.splitlines() if "Exchange hashpartitioning(_own" in line)
    assert text.index(own) < text.index("BroadcastHashJoin")


# --- roll-ups and what changed --------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_deltas_keep_a_rollup_equal_to_that_of_all_rows(spark, seed):
    rnd = random.Random(seed)
    old = [(n, rnd.choice(["a", "b", None]), rnd.choice([None, 1.25, 2.5])) for n in range(60)]
    new = [(n, k if rnd.random() < 0.9 else "c", v if rnd.random() < 0.8 else 7.75) for n, k, v in old if rnd.random() < 0.9]
    new += [(100 + n, "a", 0.5) for n in range(5)]
    schema = "id int, k string, v double"
    before, after = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    sums = {"total": F.col("v").cast("decimal(18,2)")}
    stored = op.additive_rollup(before, {"k": "k"}, sums)
    deltas = op.rollup_deltas(op.snapshot_difference(before, after, ["id"]), {"k": "k"}, sums)
    assert rows(op.apply_deltas(stored, deltas, ["k"])) == rows(op.additive_rollup(after, {"k": "k"}, sums))
    nothing = op.rollup_deltas(op.snapshot_difference(after, after, ["id"]), {"k": "k"}, sums)
    assert rows(op.apply_deltas(stored, nothing, ["k"])) == rows(stored)
    with pytest.raises(ValueError, match="decimal"):
        op.additive_rollup(before, {"k": "k"}, {"total": "v"})
