"""Keys and names put together from several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refinery.functions._columns import ColumnLike, as_column
from refinery.functions.values import blank_to_null


def tenant_key(*parts: ColumnLike, separator: str = "_", on_null: str = "null") -> Column:
    """A tenant-qualified key: the parts as text, joined by ``separator``.

    A missing part makes the whole key NULL, so that half-known keys never match each other;
    ``on_null='skip'`` leaves the part out instead.
    """
    texts = [as_column(part).cast("string") for part in parts]
    if on_null == "skip":
        return F.concat_ws(separator, *texts)
    if on_null != "null":
        raise ValueError(f"on_null must be 'null' or 'skip', not {on_null!r}")
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit(separator), text]
    return F.concat(*spaced)


def foreign_key(*parts: ColumnLike, separator: str = "_") -> Column:
    """The key of a related record; built by the same rule, so that joins on it line up."""
    return tenant_key(*parts, separator=separator)


def full_name(*parts: ColumnLike) -> Column:
    """Name parts with single spaces between; missing or blank parts leave no gap.

    A name without any part is the empty string, not NULL.
    """
    return F.concat_ws(" ", *[blank_to_null(part) for part in parts])
