from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Entity:
    """How one refined table comes from a payload.

    ``payload`` names the payload where it is not the entity's own name. ``rowwise`` says
    that each payload row is refined by itself (no shuffle), so a stream can be refined too.
    ``reads`` names the declared fields in use, by dotted paths, for entities that explode arrays
    of wide structs; a scan can then leave out the rest. Empty: all of them.
    """

    refine: Callable[..., DataFrame]
    payload: str | None = None
    rowwise: bool = True
    reads: tuple[str, ...] = ()
