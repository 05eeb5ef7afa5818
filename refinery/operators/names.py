"""Names for helper columns that no column of a frame has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def free_prefix(names: Iterable[str], wish: str = "_") -> str:
    """``wish``, lengthened until none of the names starts with it."""
    known = [name.lower() for name in names]
    while any(name.startswith(wish) for name in known):
        wish += "_"
    return wish
