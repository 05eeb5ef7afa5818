"""The plans the operators promise: scans, shuffles, what the scan reads, how skew is met."""

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from refinery import functions as fn
from refinery import operators as op
from refinery import sources
from refinery.plans import registry
from tests.frames import nodes, plan

SCHEMA = """id string, tenant string, moment timestamp_ntz,
    plates array<string>,
    lines array<struct<nr: int, label: string, amount: double, remark: string,
                       ages: array<struct<from: int, persons: int>>>>"""


@pytest.fixture(scope="module")
def payload(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("payload") / "rows")
    rows = [
        (f"o{n}", "t", None, ["x"] * (n % 3), [(i, "l", 1.5, "r", [(0, 1), (2, 2)]) for i in range(n % 4)])
        for n in range(50)
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(autouse=True)
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


def shape(df):
    return nodes(df, "FileScan"), nodes(df, "Exchange")


def read_schema(df):
    """The columns the first scan reads, untruncated."""
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.requiredSchema().simpleString()


def test_projections_do_not_shuffle(payload):
    assert shape(op.project(payload, {"Id": fn.tenant_key("tenant", "id")})) == (1, 0)
    assert shape(op.rekey(payload, fn.tenant_key("tenant", "id"), drop=["id"])) == (1, 0)


def test_only_projected_columns_are_read(payload):
    assert read_schema(op.project(payload, {"Id": fn.tenant_key("tenant", "id")})) == "struct<id:string,tenant:string>"


def test_date_window_reaches_the_scan(payload):
    text = plan(op.recent(payload, "moment", 14, "2024-01-15"))
    assert re.search(r"PushedFilters: \[IsNotNull\(moment\), GreaterThan\(moment,2024-01-01T00:00", text)
    assert "GreaterThan(moment" in plan(op.incremental(payload, "moment", "2024-01-01"))


def test_required_child_ids_use_an_inner_explode(payload):
    lines = op.explode_children(payload, {"line": "lines"}, {"id": "id", "nr": "line.nr"}, require=["line.nr"])
    text = plan(lines)
    assert "explode(lines" in text and "outer=true" not in text and "true, [line" not in text
    assert "size(lines" in text
    assert shape(lines) == (1, 0)


def test_named_child_fields_narrow_the_scan(payload):
    columns = {"id": "id", "nr": "line.nr", "amount": "line.amount"}
    whole = op.explode_children(payload, {"line": "lines"}, columns)
    narrow = op.explode_children(payload, {"line": "lines"}, columns, fields=["nr", "amount"])
    assert "remark" in read_schema(whole)
    assert read_schema(narrow) == "struct<id:string,lines:array<struct<nr:int,amount:double>>>"


def test_tree_reads_its_source_once(spark, tmp_path):
    path = str(tmp_path / "tree")
    leaf = "array<struct<id: int>>"
    schema = f"id int, groups array<struct<id: int, groups: array<struct<id: int, leaves: {leaf}>>, leaves: {leaf}>>"
    spark.createDataFrame([], schema).write.parquet(path)
    tree = spark.read.parquet(path).withColumn("leaves", F.lit(None).cast(leaf))
    flat = op.flatten_tree(
        tree, {"id": "node.id", "up": "parent.id"}, fields=[], groups="groups", leaves="leaves", depth=2
    )
    assert shape(flat) == (1, 1)
    assert nodes(flat, "Generate") <= 5


def test_buckets_in_a_row_need_no_shuffle(payload):
    columns = op.bucket_columns("line.ages", "from", "persons", {0: "a", 2: "b"})
    assert shape(op.explode_children(payload, {"line": "lines"}, {"id": "id", **columns})) == (1, 0)


def test_pivot_of_lines_shuffles_once(payload):
    lines = payload.select("id", F.explode("lines").alias("line"))
    assert shape(op.bucket_pivot(lines, {"id": "id"}, "line.nr", {0: "a", 1: "b"}, "line.amount")) == (1, 1)


def test_unique_keys_save_the_join(payload):
    assert shape(op.has_children(payload, "id", "plates", "has", unique_key=True)) == (1, 0)
    shared = op.has_children(payload, "id", "plates", "has")
    assert shape(shared) == (2, 3)


def test_unique_parents_are_not_made_distinct(payload):
    columns = {"key": "id", "parent_key": "tenant", "name": "id"}
    assert shape(op.with_parent(payload, **columns)) == (2, 3)
    assert shape(op.with_parent(payload, **columns, unique_key=True)) == (2, 2)


def test_rollup_and_latest_work_before_they_shuffle(payload):
    lines = op.rollup_lines(payload, {"t": "tenant"}, {"a": "line.amount"}, arrays={"line": "lines"})
    assert shape(lines) == (1, 1)
    assert nodes(lines, "HashAggregate") == 2
    latest = op.latest_per_key(payload, ["tenant"], "moment")
    assert shape(latest) == (1, 1)
    assert nodes(latest, "WindowGroupLimit") == 2


def test_history_shuffles_rows_once_and_starts_once(spark, tmp_path):
    path = str(tmp_path / "changes")
    spark.range(1000).selectExpr(
        "id % 5 as k", "id % 3 as s", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id) as t"
    ).write.parquet(path)
    assert shape(op.scd2(spark.read.parquet(path), ["k"], ["s"], "t")) == (1, 3)


@pytest.mark.parametrize("hot", ["key", "null"])
def test_hot_keys_are_split(spark, conf, tmp_path, hot):
    """A third of all rows share a key, or have none: the join must run it in several tasks."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "30KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "6")
    path = str(tmp_path / "rows")
    value = "'hot'" if hot == "key" else "null"
    spark.range(60_000).repartition(12).selectExpr(
        f"case when id % 3 = 0 then {value} else cast(id as string) end as k",
        "case when id % 3 = 0 then 'hot' else cast(id div 7 as string) end as up",
        "uuid() as filler",
        "array_repeat('x', cast(id % 2 as int)) as items",
    ).write.parquet(path)
    df = spark.read.parquet(path)

    def split(frame):
        frame.write.format("noop").mode("overwrite").save()
        frame.collect()
        return "skew=true" in plan(frame)

    assert split(op.has_children(df, "k", "items", "has"))
    assert split(op.with_parent(df, key="filler", parent_key="k", name="filler"))
    updates = spark.read.parquet(path).filter("up <> 'x'")
    assert split(op.upsert(df, updates.withColumn("filler", F.lit("new")), ["k"], "up"))
    labels = df.filter("k <> 'hot'").selectExpr("k as code", "filler as label")
    assert split(op.lookup_join(df, labels, on="k", code="code", label="label", name="label"))


def test_pipelines_stay_in_the_jvm_and_off_the_driver(spark):
    """No pipeline plans Python workers, cross joins, single partitions or a collected side."""
    for name in registry.ENTITIES:
        try:
            schema = registry.schema_for(name)
        except KeyError:
            continue
        df = spark.createDataFrame([], schema).withColumns({"VestigingId": F.lit("v"), "Resort": F.lit("r")})
        text = plan(registry.refine(df, name))
        for word in ("Python", "Cartesian", "BroadcastNestedLoop", "SinglePartition", "Arrow"):
            assert word not in text, (name, word)


@pytest.mark.parametrize("name", [name for name, entity in registry.ENTITIES.items() if entity.reads])
def test_landed_entities_scan_no_more_than_they_use(spark, conf, tmp_path, name):
    conf("spark.sql.adaptive.enabled", "false")
    full = registry.schema_for(name)
    payload = spark.createDataFrame([], full).withColumn("VestigingId", F.lit(1))
    landed = registry.refine_all(payload, [name], landing=str(tmp_path / "landed"), keep=["VestigingId"])[name]
    narrow = registry.schema_for(name, narrow=True)
    scanned = read_schema(landed)
    for unused in ("remarks", "salesPoint", "priceIncludedVAT", "vat_percentage", "journal"):
        assert unused not in scanned
    assert len(narrow.simpleString()) < len(full.simpleString())
    # Each declared path is needed: without it the entity cannot be refined. (An own id would be mistaken for "Id".)
    for path in set(registry.ENTITIES[name].reads) - {"id"}:
        others = [other for other in registry.ENTITIES[name].reads if other != path]
        frame = spark.createDataFrame([], sources.narrowed(full, others)).withColumn("VestigingId", F.lit(1))
        with pytest.raises(AnalysisException):
            registry.refine(frame, name)


def test_narrowed_refuses_unknown_paths():
    with pytest.raises(ValueError, match="not in"):
        sources.narrowed(registry.schema_for("tomm.booking"), ["id", "nothing.here"])
