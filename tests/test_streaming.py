import json

import pytest

from refinery import streaming
from refinery.plans import registry
from tests.frames import rows


def test_rowwise_pipelines_run_on_a_stream(spark, tmp_path):
    raw, table, checkpoint = (tmp_path / name for name in ("raw", "table", "checkpoint"))
    raw.mkdir()

    def land(number):
        record = {"id": f"b{number}", "guests": [{"id": f"g{number}"}, {"id": None}]}
        (raw / f"{number}.json").write_text(json.dumps(record) + "\n")

    def run():
        stream = streaming.read_stream(spark, str(raw), registry.schema_for("tomm.guest"))
        guests = streaming.refine_stream(stream, "tomm.guest")
        streaming.write_stream(guests, str(table), str(checkpoint)).awaitTermination(60)
        return rows(spark.read.parquet(str(table)).select("Id", "FK_Boeking_Id"))

    land(1)
    assert run() == {("g1", "b1"): 1}
    land(2)
    assert run() == {("g1", "b1"): 1, ("g2", "b2"): 1}
    assert run() == {("g1", "b1"): 1, ("g2", "b2"): 1}


def test_every_rowwise_pipeline_accepts_a_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    for name, entity in registry.ENTITIES.items():
        try:
            schema = registry.schema_for(name)
        except KeyError:
            continue
        stream = streaming.read_stream(spark, str(tmp_path), schema).withColumns(
            {"VestigingId": F.lit("v"), "Resort": F.lit("r")}
        )
        if entity.rowwise:
            assert streaming.refine_stream(stream, name).isStreaming
        else:
            with pytest.raises(ValueError, match="batches"):
                streaming.refine_stream(stream, name)


def test_the_latest_of_a_stream_equals_the_latest_of_all_rows(spark, tmp_path):
    import random

    from refinery import operators as op
    from refinery import sources

    raw, table = tmp_path / "raw", str(tmp_path / "table")
    raw.mkdir()
    rnd = random.Random(4)
    schema = "k string, ts int, v string"
    everything = []

    def land(number):
        batch = [{"k": rnd.choice(["a", "b", "c", None]), "ts": rnd.randrange(6), "v": rnd.choice("xyz")} for _ in range(8)]
        everything.extend(batch)
        (raw / f"{number}.json").write_text("".join(json.dumps(row) + "\n" for row in batch))

    def run(checkpoint):
        stream = streaming.read_stream(spark, str(raw), schema, maxFilesPerTrigger=1)
        streaming.merge_stream(stream, table, ["k"], "ts", str(tmp_path / checkpoint), buckets=4).awaitTermination(120)
        return rows(sources.read_keyed(spark, table))

    def latest():
        return rows(op.latest_per_key(spark.createDataFrame([(r["k"], r["ts"], r["v"]) for r in everything], schema), ["k"], "ts"))

    land(1)
    land(2)
    assert run("first") == latest()
    land(3)
    assert run("first") == latest()
    # Without its checkpoint the query starts over: all batches are merged again and change nothing.
    assert run("second") == latest()
