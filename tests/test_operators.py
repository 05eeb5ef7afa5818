import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery import functions as fn
from refinery import operators as op
from refinery import sources
from tests.frames import rows

LINES = "id string, lines array<struct<nr: int, ages: array<struct<from: int, persons: int>>>>"


def orders(spark):
    return spark.createDataFrame(
        [
            ("a", [(1, [(0, 2), (2, 1)]), (2, []), None]),
            ("b", []),
            ("c", None),
            ("d", [(None, [(0, 5)])]),
        ],
        LINES,
    )


# --- projections ----------------------------------------------------------------------------


def test_rekey_never_repeats_a_column(spark):
    df = spark.createDataFrame([("n", 1, "x")], "tenant string, nr int, label string")
    keyed = op.rekey(df, fn.tenant_key("tenant", "nr"), first=["tenant"], drop=["nr"])
    assert keyed.columns == ["Id", "tenant", "label"]
    assert keyed.first() == ("n_1", "n", "x")


def test_rekey_keeps_a_clashing_column_under_another_name(spark, tmp_path):
    df = spark.createDataFrame([(7, "n")], "id int, tenant string")
    keyed = op.rekey(df, fn.tenant_key("tenant", "id"))
    assert keyed.columns == ["Id", "id_source", "tenant"]
    keyed.write.parquet(str(tmp_path / "keyed"))
    with pytest.raises(ValueError, match="taken"):
        op.rekey(df.withColumn("id_source", F.lit(1)), F.lit("k"))


def test_missing_struct_keeps_its_row(spark):
    df = spark.createDataFrame([("a", ("p",)), ("b", None)], "id string, person struct<name: string>")
    assert rows(op.project(df, {"name": "person.name", "key": "id"})) == {("p", "a"): 1, (None, "b"): 1}


def test_require_drops_rows_with_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert rows(op.require(df, "x", "y")) == {(1, "a"): 1}
    assert rows(op.require(df)) == rows(df)


def test_recent_bound_is_strict_and_open_above(spark):
    moments = ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-15 00:00:00", "2030-01-01 00:00:00", None]
    df = spark.createDataFrame([(m,) for m in moments], "m string").select(F.col("m").cast("timestamp"))
    kept = [row.m.year * 100 + row.m.day for row in op.recent(df, "m", 14, "2024-01-15").collect()]
    assert sorted(kept) == [202401, 202415, 203001]


def test_stamp_and_context(spark):
    df = spark.range(1)
    stamped = op.stamp(df, "2024-02-03", added_at=F.lit("x")).first()
    assert (stamped.snapshot_date, stamped.added_at) == (dt.date(2024, 2, 3), "x")
    assert op.stamp(df, added_name=None).columns == ["id", "snapshot_date"]
    tagged = op.with_context(df, tenant="t", double=F.col("id") * 2).first()
    assert (tagged.tenant, tagged.double) == ("t", 0)


# --- nested data ----------------------------------------------------------------------------


def test_explode_skips_missing_children(spark):
    columns = {"id": "id", "nr": "line.nr"}
    everything = op.explode_children(orders(spark), {"line": "lines"}, columns)
    assert rows(everything) == {("a", 1): 1, ("a", 2): 1, ("a", None): 1, ("d", None): 1}
    known = op.explode_children(orders(spark), {"line": "lines"}, columns, require=["line.nr"])
    assert rows(known) == {("a", 1): 1, ("a", 2): 1}


def test_explode_of_named_fields_gives_the_same_rows(spark):
    columns = {"id": "id", "nr": "line.nr"}
    pruned = op.explode_children(orders(spark), {"line": "lines"}, columns, fields=["nr"])
    assert rows(pruned) == rows(op.explode_children(orders(spark), {"line": "lines"}, columns))


def test_explode_two_levels(spark):
    ages = op.explode_children(
        orders(spark), {"line": "lines", "age": "line.ages"}, {"id": "id", "from": "age.from", "n": "age.persons"}
    )
    assert rows(ages) == {("a", 0, 2): 1, ("a", 2, 1): 1, ("d", 0, 5): 1}


def test_explode_refuses_unclear_calls(spark):
    with pytest.raises(ValueError, match="columns already"):
        op.explode_children(orders(spark), {"ID": "lines"}, {})
    with pytest.raises(ValueError, match="single array"):
        op.explode_children(orders(spark), {"line": "lines", "age": "line.ages"}, {}, fields=["nr"])


TREE = """id int, name string,
    groups array<struct<id: int, name: string,
                        groups: array<struct<id: int, name: string, leaves: array<struct<id: int, name: string>>>>,
                        leaves: array<struct<id: int, name: string>>>>,
    leaves array<struct<id: int, name: string>>"""

NODE = {"id": "node.id", "name": "node.name", "level": "level", "up": "parent.id"}


def test_tree_with_leaves_and_orphans(spark):
    groups = [
        (10, "g", [(100, "gg", [(1000, "leaf")]), (None, "nameless", [(1001, "orphan")])], None),
        (None, "nameless", [(101, "orphan group", None)], [(1002, "orphan")]),
        None,
        (11, "childless", [], []),
    ]
    leaves = [(2, "leaf"), None, (None, "x")]
    df = spark.createDataFrame([(1, "root", groups, leaves), (None, "bare", None, None)], TREE)
    shared = {(1, "root", 0, None), (None, "bare", 0, None), (10, "g", 1, 1), (11, "childless", 1, 1)}
    full = op.flatten_tree(df, NODE, fields=["name"], groups="groups", leaves="leaves", depth=2, orphans=True)
    assert set(rows(full)) == shared | {
        (2, "leaf", 1, 1),
        (100, "gg", 2, 10),
        (1000, "leaf", 3, 100),
        (1001, "orphan", 3, None),
        (101, "orphan group", 2, None),
        (1002, "orphan", 2, None),
    }
    strict = op.flatten_tree(df, NODE, fields=["name"], groups="groups", leaves="leaves", depth=2)
    assert set(rows(strict)) == shared | {(2, "leaf", 1, 1), (100, "gg", 2, 10), (1000, "leaf", 3, 100)}
    flat = op.flatten_tree(df, NODE, fields=["name"], groups="groups")
    assert set(rows(flat)) == shared | {(100, "gg", 2, 10)}
    with pytest.raises(ValueError, match="lost"):
        op.flatten_tree(df, NODE, fields=["name"], groups="groups", depth=1)
    with pytest.raises(ValueError, match="rename"):
        op.flatten_tree(df.withColumn("Level", F.lit(1)), NODE, fields=["name"], groups="groups")
    own = df.withColumn("_level", F.lit(7)).withColumn("_groups", F.lit(7)).withColumn("_at", F.lit(7))
    assert set(rows(op.flatten_tree(own, NODE, fields=["name"], groups="groups"))) == set(rows(flat))


def test_tree_node_reached_twice_is_one_row(spark):
    group = [(10, "g", None, None)]
    df = spark.createDataFrame([(1, "root", group + group, None), (1, "root", group, None)], TREE)
    assert rows(op.flatten_tree(df, NODE, fields=["name"], groups="groups", leaves="leaves", depth=2)) == {
        (1, "root", 0, None): 1,
        (10, "g", 1, 1): 1,
    }


def test_tree_distinct_holds_no_whole_input_split(spark):
    """The distinct aggregates after its shuffle only, so one task holds one partition's rows."""
    df = spark.createDataFrame([(1, "root", [(10, "g", None, None)], None)], TREE)
    flat = op.flatten_tree(df, NODE, fields=["name"], groups="groups", leaves="leaves", depth=2)
    plan = flat._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan.split("Exchange hashpartitioning", 1)[1]
    assert "HashAggregate" not in below_shuffle and "SortAggregate" not in below_shuffle
    assert rows(flat) == {(1, "root", 0, None): 1, (10, "g", 1, 1): 1}


# --- relations and aggregates ---------------------------------------------------------------


def test_children_flag_is_shared_by_equal_keys(spark):
    df = spark.createDataFrame(
        [("a", ["x"]), ("a", []), ("b", None), ("c", [None]), (None, ["x"])], "id string, plates array<string>"
    )
    shared = op.has_children(df, "id", "plates", "has").select("id", "has")
    assert rows(shared) == {("a", True): 2, ("b", False): 1, ("c", True): 1, (None, False): 1}
    own = op.has_children(df, "id", "plates", "has", unique_key=True).select("id", "has")
    assert rows(own) == {("a", True): 1, ("a", False): 1, ("b", False): 1, ("c", True): 1, (None, False): 1}


def test_child_counts_add_up_per_key(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), ("a", [None]), ("b", []), ("c", None), (None, ["z"])], "id string, plates array<string>"
    )
    assert rows(op.count_children(df, "id", "plates", key_name="key")) == {("a", 3): 1, (None, 1): 1}


def test_parent_lookup(spark):
    df = spark.createDataFrame(
        [("a", "top", None), ("b", "mid", "a"), ("c", "lost", "gone"), ("d", None, "b"), ("e", "low", "d")],
        "id string, name string, up string",
    )
    related = op.with_parent(df, key="id", parent_key="up", name="name").drop("up", "name")
    unique = op.with_parent(df, key="id", parent_key="up", name="name", unique_key=True).drop("up", "name")
    assert rows(unique) == rows(related)
    assert rows(related) == {
        ("a", None, "top"): 1,
        ("b", "a", "top"): 1,
        ("c", None, "lost"): 1,
        ("d", "b", "mid"): 1,
        ("e", "d", "low"): 1,
    }


def test_lookup_join_defaults(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "code string")
    labels = spark.createDataFrame([("x", "ex"), ("z", "zed")], "code string, label string")
    named = op.lookup_join(df, labels, on="code", code="code", label="label", name="title", default=F.lit("?"))
    assert rows(named) == {("x", "ex"): 1, ("y", "?"): 1, (None, "?"): 1}


def test_rollup_merges_equal_lines(spark):
    df = spark.createDataFrame(
        [("a", None, 1, 0.1), ("a", None, 2, 0.2), ("a", "k", None, None), ("b", None, 4, 1e30)],
        "k1 string, k2 string, n int, x double",
    )
    total = op.rollup_lines(df, {"k1": "k1", "k2": "k2"}, {"n": "n", "x": "x"})
    assert rows(total) == {("a", None, 3, 0.3): 1, ("a", "k", None, None): 1, ("b", None, 4, 1e30): 1}
    assert dict(total.dtypes) == {"k1": "string", "k2": "string", "n": "bigint", "x": "double"}


def test_line_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e15, -1e15, 12.345678] * 50
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([("k", value) for value in values], "k string, x double").repartition(parts)
        sums.add(op.rollup_lines(df, {"k": "k"}, {"x": "x"}).first().x)
    assert sums == {647.2839}


def test_line_sum_keeps_values_no_decimal_holds(spark):
    def total(*values):
        df = spark.createDataFrame([("k", value) for value in values], "k string, x double")
        return op.rollup_lines(df, {"k": "k"}, {"x": "x"}).first().x

    assert total(1e25, 1e25, 1.5) == 2e25
    assert total(1.5, float("inf")) == float("inf")
    assert total(1.5, float("nan")) != total(1.5)


def test_buckets_in_a_row(spark):
    df = spark.createDataFrame(
        [("a", [(0, 1), (2, 5), (2, 3), (99, 9)]), ("b", []), ("c", None), (None, [(0, 1)]), ("d", [(0, None), None])],
        "id string, ages array<struct<from: int, persons: int>>",
    )

    def pivot(pick):
        columns = op.bucket_columns(
            "ages", "from", "persons", {0: "young", 2: "older"}, pick=pick, when=F.col("id").isNotNull()
        )
        return rows(op.project(df, {"id": "id", **columns}))

    rest = {("b", None, None): 1, ("c", None, None): 1, (None, None, None): 1, ("d", None, None): 1}
    assert pivot("max") == {("a", 1, 5): 1, **rest}
    assert pivot("min") == {("a", 1, 3): 1, **rest}
    assert pivot("first") == {("a", 1, 5): 1, **rest}


def test_bucket_pivot_of_lines(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 2, 5), ("a", 2, 3), ("b", 99, 7), (None, 0, 2)], "id string, from int, persons int"
    )
    known = {0: "young", 2: "older"}
    assert rows(op.bucket_pivot(df, {"id": "id"}, "from", known, "persons")) == {
        ("a", 1, 5): 1,
        ("b", None, None): 1,
        (None, 2, None): 1,
    }
    assert rows(op.bucket_pivot(df, {"id": "id"}, "from", known, "persons", agg="sum"))[("a", 1, 8)] == 1


# --- latest, sets ---------------------------------------------------------------------------


def test_latest_breaks_ties_and_puts_null_last(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "q"), ("b", 0, "p"), ("c", None, "r")],
        "k string, t int, v string",
    )
    expected = {("a", 3, "y"): 1, ("b", 0, "p"): 1, ("c", None, "r"): 1}
    assert rows(op.latest_per_key(df, ["k"], "t")) == expected
    last = op.latest_per_key(df, ["k"], "t", tie_break=[F.col("v")])
    assert rows(last) == expected


def test_latest_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 2)], "k string, t int")
    latest = {mode: rows(op.latest_per_key(df, ["k"], "t", null_keys=mode)) for mode in ("collapse", "keep", "drop")}
    assert latest == {
        "collapse": {(None, 2): 1, ("a", 2): 1},
        "keep": {(None, 1): 1, (None, 2): 1, ("a", 2): 1},
        "drop": {("a", 2): 1},
    }
    with pytest.raises(ValueError):
        op.latest_per_key(df, ["k"], "t", null_keys="other")


def test_unions_match_columns_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    assert rows(op.union_all(left, right)) == {(1, "a"): 2, (2, "b"): 1}
    assert rows(op.union_distinct(left, right, right)) == {(1, "a"): 1, (2, "b"): 1}
    assert op.align(right, ["n", "s"]).columns == ["n", "s"]


def test_distinct_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", None), ("a", None)], "s string, n int")
    assert rows(op.distinct_rows(df)) == {(None, 1): 1, ("a", None): 1}


# --- incremental loads ----------------------------------------------------------------------


def test_incremental_and_watermark(spark):
    df = spark.range(10).select(F.col("id").alias("n"))
    assert sorted(row.n for row in op.incremental(df, "n", 7).collect()) == [8, 9]
    assert sorted(row.n for row in op.incremental(df, "n", 7, lookback=2).collect()) == [6, 7, 8, 9]
    assert op.incremental(df, "n", None).count() == 10
    assert op.next_watermark(df, "n").first().watermark == 9
    assert op.next_watermark(df.where("n < 5"), "n", low=7).first().watermark == 7
    assert op.next_watermark(df.where("false"), "n", low=7).first().watermark == 7
    assert op.next_watermark(df, "n", low=7).first().watermark == 9


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    updates = spark.createDataFrame([("a", 2), ("a", 3), ("c", 5), (None, 7), (None, 8)], "k string, v int")
    assert rows(op.upsert(target, updates, ["k"], "v")) == {
        ("a", 3): 1,
        ("b", 1): 1,
        ("c", 5): 1,
        (None, 1): 1,
        (None, 7): 1,
        (None, 8): 1,
    }
    once = op.upsert(target, updates, ["k"], "v", null_keys="drop")
    assert rows(op.upsert(once, updates, ["k"], "v", null_keys="drop")) == rows(once)
    with pytest.raises(ValueError, match="null_keys"):
        op.upsert(target, updates, ["k"], "v", null_keys="collapse")


def test_helper_columns_give_way(spark):
    df = spark.createDataFrame([(1, None, "a", 5), (2, 1, "b", 6)], "id int, up int, name string, v int")
    own = df.selectExpr("*", *(f"'own' as {n}" for n in ("_rank", "_parent", "_key", "_name", "_code", "_label")))
    latest = op.latest_per_key(own, ["id"], "v")
    assert latest.columns == own.columns and latest.where("_rank = 'own'").count() == 2
    flagged = op.has_children(own.withColumn("kids", F.array("v")), "id", "kids", "has")
    assert flagged.where("has and _parent = 'own'").count() == 2
    related = op.with_parent(own, key="id", parent_key="up", name="name")
    assert {(r.id, r.parent_key, r.parent_name, r._key, r._name) for r in related.collect()} == {
        (1, None, "a", "own", "own"), (2, 1, "a", "own", "own")
    }
    labelled = op.lookup_join(own, df, on="up", code="id", label="name", name="title")
    assert {(r.id, r.title, r._code, r._label) for r in labelled.collect()} == {(1, None, "own", "own"), (2, "a", "own", "own")}


def test_lines_are_not_rounded_before_they_are_added(spark):
    small = spark.range(1000).selectExpr("1 as k", "1e-7 as v")
    assert op.rollup_lines(small, {"k": "k"}, {"v": "v"}).first().v == 1e-4
    three = spark.range(3).selectExpr("1 as k", "0.1234567D as v")
    assert op.rollup_lines(three, {"k": "k"}, {"v": "v"}).first().v == 0.3703701
    huge = spark.range(4).selectExpr("1 as k", "if(id = 3, 0.5D, 1e30D) as v")
    assert op.rollup_lines(huge, {"k": "k"}, {"v": "v"}).first().v == pytest.approx(3e30)
    odd = spark.createDataFrame([(1, float("nan")), (1, 1.0), (2, None), (3, 2.5), (3, None)], "k int, v double")
    found = {r.k: r.v for r in op.rollup_lines(odd, {"k": "k"}, {"v": "v"}).collect()}
    assert str(found[1]) == "nan" and found[2] is None and found[3] == 2.5


def test_buckets_can_be_added(spark):
    df = spark.createDataFrame([(1, [(0, 2), (0, 3), (1, None)]), (2, None)], "id int, a array<struct<b: int, n: int>>")
    sums = op.bucket_columns("a", "b", "n", {0: "zero", 1: "one"}, pick="sum")
    assert rows(df.select("id", *(c.alias(n) for n, c in sums.items()))) == {(1, 5.0, None): 1, (2, None, None): 1}


def test_conform_fits_maps_and_json(spark):
    df = spark.sql("select map('1', 2, 'x', 3) as m, '{\"a\": 5}' as s, 'junk' as t, map('a', map(1, 2)) as deep")
    wanted = "m map<bigint, bigint>, s struct<a: int>, t struct<a: int>, deep map<string, map<bigint, double>>"
    fitted = sources.conform(df, StructType.fromDDL(wanted))
    row = fitted.first()
    assert fitted.schema["m"].dataType.simpleString() == "map<bigint,bigint>"
    assert row.m == {1: 2} and row.s.a == 5 and row.deep == {"a": {1: 2.0}}
    assert row.t is None or row.t.a is None


def test_history_spans_slices(spark):
    def at(day, hour=0):
        return dt.datetime(2024, 1, day, hour)

    changes = [
        # Unchanged over a slice border, changed inside a slice, and back after silent slices.
        ("a", "x", at(1, 1)), ("a", "x", at(1, 9)), ("a", "x", at(2)), ("a", "y", at(2, 5)), ("a", "y", at(3)),
        ("a", "y", at(4)), ("a", "x", at(9)),
        # NULL is a state of its own, and a NULL key a key of its own.
        ("b", None, at(1)), ("b", None, at(2)), ("b", "x", at(3)),
        (None, "x", at(1)), (None, "x", at(2)),
    ]
    df = spark.createDataFrame(changes, "k string, s string, t timestamp_ntz")
    expected = {
        ("a", "x", at(1, 1), at(2, 5), False): 1,
        ("a", "y", at(2, 5), at(9), False): 1,
        ("a", "x", at(9), None, True): 1,
        ("b", None, at(1), at(3), False): 1,
        ("b", "x", at(3), None, True): 1,
        (None, "x", at(1), None, True): 1,
    }
    for slices in (None, 1, 3, 12):
        assert rows(op.scd2(df, ["k"], ["s"], "t", slices=slices)) == expected


def test_history_of_a_hot_key_in_one_instant(spark):
    """A third of all rows share a key and a second; the slices must not share that fate."""
    df = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, -1, id) as k",
        "cast(id div 60 % 2 as string) as s",
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, if(id % 3 = 0, 0, id) / 1000) as t",
        "id as n",
    )
    runs = op.scd2(df, ["k"], ["s"], "t", tie_break=["n"], slices=30)
    assert runs.where("k = -1").count() == 500
    assert runs.where("is_current").count() == 20_001
    rows_of_slice = df.repartitionByRange(30, "k", "t", "n").groupBy(F.spark_partition_id()).count()
    assert rows_of_slice.agg(F.max("count")).first()[0] < 3_000


# --- sources and sinks ----------------------------------------------------------------------


def test_conform_fits_nested_records(spark):
    df = spark.createDataFrame(
        [("1", ("x", 2), [("n", 1.5), None], 9), ("bad", None, None, 8)],
        "id string, s struct<a: string, b: int>, l array<struct<p: string, q: double>>, extra int",
    )
    wanted = StructType.fromDDL(
        "ID int, s struct<b: string, c: date>, l array<struct<q: int, r: string>>, missing array<string>"
    )
    fitted = sources.conform(df, wanted)
    assert [row.asDict(recursive=True) for row in fitted.collect()] == [
        {"ID": 1, "s": {"b": "2", "c": None}, "l": [{"q": 1, "r": None}, None], "missing": None},
        {"ID": None, "s": None, "l": None, "missing": None},
    ]
    assert fitted.schema.simpleString() == wanted.simpleString()


def test_conform_keeps_too_deep_records_as_text(spark):
    df = spark.createDataFrame([([(1,)],)], "deep array<struct<a: int>>")
    assert sources.conform(df, StructType.fromDDL("deep string")).first().deep == '[{"a":1}]'


def test_json_by_schema(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text('{"id": 1, "more": {"a": "x"}, "odd": true}\n{"id": 2}\n')
    read = sources.read_entity(spark, str(path), "id int, more struct<a: string>, gone string")
    assert [row.asDict(recursive=True) for row in read.orderBy("id").collect()] == [
        {"id": 1, "more": {"a": "x"}, "gone": None},
        {"id": 2, "more": None, "gone": None},
    ]


def test_tables_by_path_and_name(spark, tmp_path):
    df = spark.range(3)
    sources.write_table(df.withColumn("day", F.lit("d")), str(tmp_path / "t"), partition_by=["day"])
    assert sources.read_table(spark, str(tmp_path / "t")).count() == 3
    df.createOrReplaceTempView("three")
    assert sources.read_table(spark, "three").count() == 3


def test_snapshot_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    sources.write_snapshot(spark.range(3), path, "2024-01-01")
    sources.write_snapshot(spark.range(5), path, "2024-01-02")
    sources.write_snapshot(spark.range(4), path, "2024-01-02")
    written = spark.read.parquet(path).groupBy("snapshot_date").count()
    assert rows(written) == {(dt.date(2024, 1, 1), 3): 1, (dt.date(2024, 1, 2), 4): 1}
