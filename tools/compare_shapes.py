"""Times the operators' plan shapes against the plainer ones they replace, on stored payloads.

    python tools/compare_shapes.py [folder]

Each pair gives the same rows. Payloads are written once as parquet and read back, as raw
tables would be.
"""

from __future__ import annotations

import sys
import tempfile
import time
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from refinery import operators as op  # noqa: E402
from refinery.plans import registry  # noqa: E402
from refinery.plans.queries import nested_entities as nested  # noqa: E402
from refinery.plans.queries.query import table  # noqa: E402
from refinery.session import build_session  # noqa: E402
from refinery.sources import read_entity  # noqa: E402


def seconds(frame: DataFrame) -> float:
    best = float("inf")
    for _ in range(3):
        start = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def level_union(points: DataFrame) -> DataFrame:
    """A tree as one explode per level, all levels in a union."""
    levels, current = [points.select("VestigingId", "id", "name", F.lit(None).cast("string").alias("up"))], points
    for _ in range(4):
        current = current.select("VestigingId", F.col("id").alias("up"), F.explode("salesPoints").alias("p"))
        current = current.select("VestigingId", "up", "p.*").filter("id is not null")
        levels.append(current.select("VestigingId", "id", "name", "up"))
    return reduce(DataFrame.union, levels).distinct()


def bucket_joins(rules: DataFrame) -> DataFrame:
    """One left join per age bucket."""
    lines = rules.select("id", F.explode("booking_rules").alias("r"))
    ages = lines.select("id", F.col("r.id").alias("rule"), F.explode("r.age_categories").alias("a"))
    result = lines.select("id", F.col("r.id").alias("rule"), F.col("r.accommodation").alias("accommodation"))
    for bucket in (0, 2, 13, 21):
        side = ages.filter(F.col("a.from") == bucket).select("id", "rule", F.col("a.persons").alias(f"n{bucket}"))
        result = result.join(side, ["id", "rule"], "left")
    return result


def bucket_columns(rules: DataFrame) -> DataFrame:
    ages = op.bucket_columns("r.age_categories", "from", "persons", {n: f"n{n}" for n in (0, 2, 13, 21)})
    columns = {"id": "id", "rule": "r.id", "accommodation": "r.accommodation"}
    return op.explode_children(rules, {"r": "booking_rules"}, {**columns, **ages})


def counted_flag(bookings: DataFrame) -> DataFrame:
    """Children counted by an explode, joined back for a flag."""
    counts = bookings.select("id", F.explode("license_plates")).groupBy("id").count()
    joined = bookings.join(counts, "id", "left")
    return joined.withColumn("flag", F.coalesce(F.col("count"), F.lit(0)) > 0).drop("count", "license_plates")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "shapes",
        "local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions="8",
    )
    spark.sparkContext.setLogLevel("ERROR")
    home = tempfile.mkdtemp(prefix="shapes-")

    def stored(name: str, frame: DataFrame) -> DataFrame:
        frame.write.parquet(f"{home}/{name}")
        return spark.read.parquet(f"{home}/{name}")

    points = stored("points", nested.point_payload(spark, folder))
    points.write.json(f"{home}/points-json")
    text_points = read_entity(spark, f"{home}/points-json", points.schema)
    orders = table(spark, folder, "orders")
    rules = stored(
        "rules",
        orders.selectExpr("cast(o_orderkey as string) as id", f"{nested.RULES.array(nested.AGES)} as booking_rules"),
    )
    rules.write.json(f"{home}/rules-json")
    text_rules = read_entity(spark, f"{home}/rules-json", rules.schema)
    plates = stored(
        "plates",
        orders.selectExpr(
            "o_orderkey as id",
            "o_totalprice",
            "o_orderdate",
            "array_repeat('x', cast(o_orderkey % 3 as int)) as license_plates",
        ),
    )

    def flagged(unique: bool) -> DataFrame:
        with_flag = op.has_children(plates, "id", "license_plates", "flag", unique_key=unique)
        return with_flag.drop("license_plates")

    pairs = {
        "tree": (level_union(points), registry.refine(points, "eijsink.salespoints")),
        "tree, from JSON": (level_union(text_points), registry.refine(text_points, "eijsink.salespoints")),
        "age buckets": (bucket_joins(rules), bucket_columns(rules)),
        "age buckets, from JSON": (bucket_joins(text_rules), bucket_columns(text_rules)),
        "child flag, ids repeat": (counted_flag(plates), flagged(unique=False)),
        "child flag, ids unique": (counted_flag(plates), flagged(unique=True)),
    }
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name, (plain, ours) in pairs.items():
            times = f"plain {seconds(plain):6.2f}s  ours {seconds(ours):6.2f}s"
            print(f"broadcast up to {limit:5} {name:24} {times}", flush=True)


if __name__ == "__main__":
    main()
