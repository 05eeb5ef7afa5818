"""Foreign keys without a row to point to."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column
from refinery.operators.names import free_prefix
from refinery.sources.sinks import land


@dataclass(frozen=True)
class Relation:
    """``foreign`` of one table refers to ``key`` of ``parents``."""

    foreign: ColumnLike
    parents: DataFrame
    key: ColumnLike


# A filter has this many bits for each key, of which three in one word are set. Up to so many
# words it is sent to all tasks: 16 MB.
BITS_PER_KEY, MOST_WORDS = 16, 1 << 21


def orphans(children: DataFrame, relation: Relation, *, key_name: str = "key", rows_name: str = "rows") -> DataFrame:
    """The foreign keys that no parent has, and how many rows hold each. NULL refers to nothing, so it is none.

    Rows are counted by key in their map tasks first, so a key of very many rows travels once per
    task; what is joined with the parents are distinct keys.
    """
    used = children.select(as_column(relation.foreign).alias(key_name)).filter(F.col(key_name).isNotNull())
    counted = used.groupBy(key_name).agg(F.count("*").alias(rows_name))
    mark = free_prefix([key_name, rows_name]) + "parent"
    return counted.join(relation.parents.select(as_column(relation.key).alias(mark)), F.col(key_name) == F.col(mark), "left_anti")


def orphan_report(children: DataFrame, relations: Mapping[str, Relation]) -> DataFrame:
    """(relation, key, rows) of all relations of a table, keys as text."""
    reports = [
        orphans(children, relation).select(F.lit(name).alias("relation"), F.col("key").cast("string").alias("key"), "rows")
        for name, relation in relations.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def _word_and_mask(value: Column, words: int) -> tuple[Column, Column]:
    """The word of a key in a filter of so many words (a power of two), and its three bits there."""
    hashed = F.xxhash64(value)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(hashed, at).bitwiseAND(63).cast("int")) for at in (0, 6, 12)]
    return F.shiftrightunsigned(hashed, 20).bitwiseAND(words - 1), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def orphan_rows(children: DataFrame, relation: Relation) -> DataFrame:
    """The rows of ``children`` whose foreign key no parent has, with their columns.

    Keys are settled first (see ``orphans``). A filter of these keys, sized by how many there are and broadcast below 16 MB,
    leaves other rows where they are; those that pass are joined with the keys exactly. Beyond that size
    all rows are joined, as there is then nothing few to look for.
    """
    mark = free_prefix(children.columns)
    key, rows, word, mask, bits, own = (f"{mark}{name}" for name in ("key", "rows", "word", "mask", "bits", "own"))
    lost = land(orphans(children, relation, key_name=key, rows_name=rows).select(key))
    words = 1 << max(0, (lost.count() * BITS_PER_KEY // 64).bit_length())
    marked = children.withColumn(own, as_column(relation.foreign)).filter(F.col(own).isNotNull())
    if words <= MOST_WORDS:
        at, set_ = _word_and_mask(F.col(key), words)
        table = lost.groupBy(at.alias(word)).agg(F.bit_or(set_).alias(bits))
        at, set_ = _word_and_mask(F.col(own).cast(lost.schema[key].dataType), words)
        marked = marked.withColumns({mask: set_, f"{word}_": at})
        # At most 16 MB, by the count above.
        marked = marked.join(F.broadcast(table), F.col(f"{word}_") == F.col(word))
        marked = marked.filter(F.col(bits).bitwiseAND(F.col(mask)) == F.col(mask))
    # Keys are distinct, so each row is found once; a semi-join would be moved below the filter.
    found = marked.join(lost, F.col(own) == F.col(key))
    return found.select(*[F.col(f"`{column}`") for column in children.columns])
