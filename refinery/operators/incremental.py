"""Incremental loads: watermarks, upserts and history (M-1, M-2, M-3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike
from refinery.operators.latest import latest_per_key
from refinery.operators.names import free_prefix
from refinery.operators.relate import distinct_keys

# What a history adds to the keys and tracked columns.
HISTORY = ("valid_from", "valid_to", "is_current")


def incremental(df: DataFrame, column: str, low: Any, lookback: Any = None) -> DataFrame:
    """Rows above the watermark ``low``, moved back by ``lookback`` to catch late arrivals.

    ``low`` is the value kept from the last run (None on the first); it is compared in the
    column's own type, so that the filter reaches the scan.
    """
    if low is None:
        return df
    bound = low if lookback is None else low - lookback
    text_or_number = bound if isinstance(bound, (int, float)) else str(bound)
    return df.filter(F.col(column) > F.lit(text_or_number).cast(df.schema[column].dataType))


def next_watermark(df: DataFrame, column: str, name: str = "watermark", *, low: Any = None) -> DataFrame:
    """The highest value of the column, as a frame of one row to be kept for the next run.

    ``low`` is the value kept from the last run: it stays if nothing newer has come.
    """
    highest = F.max(column)
    if low is not None:
        kept = F.lit(low if isinstance(low, (int, float)) else str(low)).cast(df.schema[column].dataType)
        highest = F.coalesce(F.greatest(highest, kept), kept)
    return df.agg(highest.alias(name))


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: ColumnLike,
    *,
    tie_break: Sequence[ColumnLike] | None = None,
    null_keys: str = "keep",
) -> DataFrame:
    """The target with the newest update of each key put in the place of its old rows.

    A key with a NULL in it matches nothing, so rows of the target without key stay. Those of the
    updates are appended, and again on every repeated run; ``null_keys="drop"`` leaves them out,
    which makes a run repeatable. The updates are cut to the newest of each key once; what the target
    is joined with are their distinct keys, for which only key columns are read (see ``distinct_keys`` for hot ones).
    """
    if null_keys not in ("keep", "drop"):
        raise ValueError(f"null_keys must be 'keep' or 'drop', not {null_keys!r}")
    newest = latest_per_key(updates, keys, order_by, tie_break=tie_break, null_keys=null_keys)
    changed = distinct_keys(updates, {key: key for key in keys})
    return target.join(changed, list(keys), "left_anti").select(*target.columns).unionByName(newest)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    *,
    tie_break: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """The history of each key: one row per run of unchanged ``tracked`` values.

    Adds ``valid_from``, ``valid_to`` (start of the next run; NULL for the last) and
    ``is_current``. Rows are ordered by ``ts``, then ``tie_break``, which should leave no ties
    between different values.

    A key is never handled as one group. All rows are put in order by key and time and cut into
    ``slices`` of about equal size (by default as many as the session shuffles into), so a slice is
    no larger for a key that holds a third of all rows, even within an instant of ``tie_break``
    values. The starts of runs are found slice by slice; only the first and the last start of each
    slice then meet those of the key's other slices.
    """
    order = [ts, *tie_break]
    columns = list(dict.fromkeys([*keys, *tracked, *order]))
    if clash := {name.lower() for name in [*keys, *tracked]} & set(HISTORY):
        raise ValueError(f"{sorted(clash)} are what a history adds; rename them")
    mark = free_prefix(columns)
    slice_, same, first, next_, edge, group, carried, change, later, at = (
        f"{mark}{name}" for name in "slice same first next edge group carried change later at".split()
    )

    def unchanged(window: WindowSpec) -> Column:
        """Is there a row before, with the same values?"""
        values = [F.col(column).eqNullSafe(F.lag(column).over(window)) for column in tracked]
        return reduce(and_, values, F.lag(F.lit(True)).over(window).isNotNull())

    in_slice = Window.partitionBy(*keys, slice_).orderBy(*order)
    in_order = changes.select(*columns).repartitionByRange(*([slices] if slices else []), *keys, *order)
    # Only the moment is needed of the next start, but starts of one moment have to stay apart.
    starts = (
        in_order.withColumn(slice_, F.spark_partition_id())
        .withColumn(same, unchanged(in_slice))
        .filter(~F.col(same))
        .withColumn(at, F.struct(*[F.col(column).alias(f"o{n}") for n, column in enumerate(order)]))
        .withColumns({first: F.row_number().over(in_slice) == 1, next_: F.lead(at).over(in_slice)})
    )

    # A slice's first start is none if the slice before ended in the same state, and the next
    # change may lie some slices on. The starts in between stay in groups of their own slice.
    on_edge = F.col(first) | F.col(next_).isNull()
    grouped = starts.withColumns({edge: on_edge, group: F.when(~on_edge, F.col(slice_))})
    across = Window.partitionBy(*keys, edge, group).orderBy(*order)
    backwards = Window.partitionBy(*keys, edge, group).orderBy(*[F.col(column).desc() for column in order])
    begins = F.when(F.col(first), F.when(F.col(carried), F.col(next_)).otherwise(F.col(at)))
    following = F.last(change, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, -1))
    end = F.coalesce(next_, later)
    return (
        grouped.withColumn(carried, F.col(first) & unchanged(across))
        .withColumn(change, begins)
        .withColumn(later, following)
        .filter(~F.col(carried))
        .select(
            *keys,
            *tracked,
            F.col(ts).alias(HISTORY[0]),
            end.getField("o0").alias(HISTORY[1]),
            end.isNull().alias(HISTORY[2]),
        )
    )
