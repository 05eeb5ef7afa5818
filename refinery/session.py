"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution is what keeps skewed joins and oversized shuffles in hand, and a UTC
# session makes instants print the same everywhere. ANSI mode stays at Spark's default: the
# parsing functions are tolerant by themselves.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Adaptive execution merges shuffle partitions but never cuts them finer, so it starts from many.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # Beyond 8000 bytes of bytecode the JVM interprets a method instead of compiling it, which
    # makes wide projections several times slower; Spark then generates smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "refinery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a cluster
    a machine-local folder would not be readable by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="refinery-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
