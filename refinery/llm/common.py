"""What several operators share: text columns through Arrow, span arrays, tables on shared disk."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.session import work_folder

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
)


def per_text(function: Callable[[str], object], ddl: str, arrow: pa.DataType) -> Callable[[Column], Column]:
    """A column function that applies ``function`` to each text, in Arrow batches; NULL counts as empty.

    A batch has ten thousand rows, so its texts become Python's some hundred at a time.
    """

    def batch(texts: pa.Array) -> pa.Array:
        slices = (texts.slice(at, 256).to_pylist() for at in range(0, len(texts), 256))
        done = (pa.array([function(text or "") for text in part], type=arrow) for part in slices)
        return pa.concat_arrays([pa.array([], type=arrow), *done])

    # Spark reads the kind of function from the annotations, which have to be types here.
    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, ddl)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, one row at least."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch[column]).fill_null(0)), dtype=np.int64)
    at = 0
    while at < len(batch):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_bytes(spark, most: int) -> Iterator[None]:
    """While inside, Arrow batches sent to Python hold about ``most`` bytes at most, one row at least; rows are
    only dealt into more batches. The session's setting comes back after."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


_cached: list = [None, None]


def worker_cache(key: object, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept in the worker for the next task that asks with the same key. One at a time."""
    if _cached[0] != key:
        release_worker_cache()
        _cached[:] = [key, build()]
    return _cached[1]


def release_worker_cache() -> None:
    """Lets go of it: workers serve one operator after the other, and memory is shared with the executor."""
    _cached[:] = [None, None]


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def join_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def keep_on_disk(df: DataFrame, name: str, *, compression: str = "snappy") -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back.

    Cuts the lineage, is computed once however often it is used, and outlives lost executors.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    _paths[kept] = path
    return kept


def empty(*tables: DataFrame) -> None:
    """Frees the disk of tables of :func:`keep_on_disk` that nothing reads any more: all that was made of them is written."""
    for table in tables:
        nothing = table.sparkSession.createDataFrame([], table.schema)
        nothing.write.mode("overwrite").parquet(_paths[table])
