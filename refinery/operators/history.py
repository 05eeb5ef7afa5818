"""Late changes into an existing history (M-2, M-3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.operators.incremental import HISTORY, scd2
from refinery.operators.names import free_name, free_prefix
from refinery.operators.relate import distinct_keys


def same_keys(df: DataFrame, keys: Sequence[str], other: Sequence[str]) -> Column:
    """The condition that the keys of ``df`` equal the columns ``other``, a NULL being equal to a NULL."""
    return reduce(and_, [df[f"`{key}`"].eqNullSafe(F.col(f"`{name}`")) for key, name in zip(keys, other, strict=True)])


def of_keys(df: DataFrame, keys: Sequence[str], some: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose key is one of ``some``, or with ``left_anti`` those whose key is not.

    Only the distinct keys of ``some`` travel, and adaptive execution splits a hot key of ``df``.
    """
    mark = free_prefix([*df.columns, *keys], "_k")
    wanted = distinct_keys(some, {f"{mark}{n}": F.col(f"`{key}`") for n, key in enumerate(keys)})
    return df.join(wanted, same_keys(df, keys, wanted.columns), how)


def rewritten_history(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    *,
    tie_break: Sequence[str] = (),
    log: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """The history, as ``scd2`` gives it, of those keys that have changes; see ``merge_history``."""
    columns = list(dict.fromkeys([*keys, *tracked, ts, *tie_break]))
    if log is not None:
        events, order = of_keys(log, keys, changes).select(*columns).unionByName(changes.select(*columns)), [*tie_break]
        return scd2(events, keys, tracked, ts, tie_break=order, slices=slices)
    late = free_name(changes.select(*columns), "_late")
    known = {key: F.col(f"`{key}`") for key in [*keys, *tracked]} | {ts: F.col(HISTORY[0])}
    missing = [F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in tie_break if c not in known]
    stored = of_keys(history, keys, changes).select(
        *[column.cast(changes.schema[name].dataType).alias(name) for name, column in known.items()], *missing, F.lit(0).alias(late)
    )
    events = stored.unionByName(changes.select(*columns, F.lit(1).alias(late)))
    return scd2(events, keys, tracked, ts, tie_break=[late, *tie_break], slices=slices)


def merge_history(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    *,
    tie_break: Sequence[str] = (),
    log: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``history`` with further changes worked in, however late they are; other keys' rows stay as they are.

    ``history`` has the columns that ``scd2`` gives. A change that falls into a stored run splits it: the
    run ends there, and the change holds until the next start. A change without effect is none, and
    a run that begins with what the one before it says is joined to it. Stored starts come before
    changes of the same moment, these in the order of ``tie_break``. A NULL key is a key like others.

    A history does not tell which changes came while nothing changed. With ``log``, the changes it was made from,
    these count too, and the outcome is that of ``scd2`` over all changes; of the log only
    the rows of keys with changes are read into the merge.

    Starts and changes are put in order by key and time and cut into slices of equal size (see ``scd2``), so no key is one
    group. Nothing of the keys without changes is sorted or rewritten; ``sources.merge_history_table``
    leaves their files alone as well.
    """
    names = [*keys, *tracked, *HISTORY]
    untouched = of_keys(history, keys, changes, "left_anti").select(*names)
    rows = rewritten_history(history, changes, keys, tracked, ts, tie_break=tie_break, log=log, slices=slices)
    return untouched.unionByName(rows.select(*names))
