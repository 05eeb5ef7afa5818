"""Taking rows out by their ids, without a shuffle of the rows that stay."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import free_name, keep_on_disk
from refinery.llm.hashing import hash_filter, in_filter


def _split(docs: DataFrame, ids: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose id is surely not among ``ids``, and the others; by a filter of fixed size."""
    table = docs.sparkSession.sparkContext.broadcast(hash_filter(ids.select(F.xxhash64(ids.columns[0]))))

    def among(hashes: pa.Array) -> pa.Array:
        return pa.array(in_filter(table.value, np.asarray(hashes, dtype=np.int64).view(np.uint64)))

    among.__annotations__ = {"hashes": pa.Array, "return": pa.Array}
    maybe = F.arrow_udf(among, "boolean")(F.xxhash64(docs[id].cast("long")))
    name = free_name(docs, "_maybe")
    marked = docs.withColumn(name, maybe)
    return marked.where(~F.col(name)).drop(name), marked.where(F.col(name)).drop(name)


def without_ids(docs: DataFrame, ids: DataFrame, *, id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids``. Rows without id stay."""
    ids = keep_on_disk(ids.select(F.col(ids.columns[0]).cast("long").alias(free_name(docs, "_gone"))), "ids")
    sure, rest = _split(docs, ids, id)
    return sure.unionByName(rest.join(ids, rest[id].cast("long") == ids[ids.columns[0]], "left_anti"))


def first_of_ids(docs: DataFrame, ids: DataFrame, *, id: str, order: str) -> DataFrame:
    """``docs`` with one row only for each of ``ids``: the first by ``order`` and then by all columns' hash."""
    ids = keep_on_disk(ids.select(F.col(ids.columns[0]).cast("long").alias(free_name(docs, "_once"))), "ids")
    sure, rest = _split(docs, ids, id)
    key, number = ids[ids.columns[0]], free_name(docs, "_number")
    once = rest.join(ids, rest[id].cast("long") == key)
    window = Window.partitionBy(ids.columns[0]).orderBy(F.col(order), F.xxhash64(*(rest[c] for c in docs.columns)))
    once = once.withColumn(number, F.row_number().over(window)).where(F.col(number) == 1).select(*docs.columns)
    others = rest.join(ids, rest[id].cast("long") == key, "left_anti")
    return sure.unionByName(others).unionByName(once)
