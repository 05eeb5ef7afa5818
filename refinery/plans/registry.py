"""The registry of entity pipelines: schemas, dispatch, one payload to many tables (A3-A5)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from refinery.plans.entities import dip, dyflexis, eijsink, hubspot, renh, taxi, ticketcounter, tomm
from refinery.plans.entities.entity import Entity
from refinery.sources import conform, land, narrowed

SOURCES = {
    "dip": dip,
    "dyflexis": dyflexis,
    "eijsink": eijsink,
    "hubspot": hubspot,
    "renh": renh,
    "taxi": taxi,
    "ticketcounter": ticketcounter,
    "tomm": tomm,
}

SCHEMAS: dict[str, str] = {
    f"{source}.{payload}": ddl for source, module in SOURCES.items() for payload, ddl in module.SCHEMAS.items()
}
ENTITIES: dict[str, Entity] = {
    f"{source}.{name}": entity for source, module in SOURCES.items() for name, entity in module.ENTITIES.items()
}


def schema_for(payload: str, *, narrow: bool = False) -> T.StructType:
    """The declared schema of ``source.payload``, or of the payload of an entity.

    Spark parses the declaration, so a session must be active. ``narrow`` leaves out what the entity
    does not use.
    """
    name = payload if payload in SCHEMAS or payload not in ENTITIES else payload_of(payload)
    if name not in SCHEMAS:
        raise KeyError(f"{payload} declares no schema; it is read with the schema of its source")
    schema = T.StructType.fromDDL(SCHEMAS[name])
    reads = ENTITIES[payload].reads if narrow and payload in ENTITIES else ()
    return narrowed(schema, reads) if reads else schema


def payload_of(entity: str) -> str:
    """The payload ``source.entity`` is refined from."""
    source, name = entity.split(".", 1)
    return f"{source}.{ENTITIES[entity].payload or name}"


def register(name: str, refine: Callable[..., DataFrame], *, payload: str | None = None, rowwise: bool = False) -> None:
    """Adds a pipeline of the user's own: any function from frame to frame."""
    ENTITIES[name] = Entity(refine, payload, rowwise)


def refine(df: DataFrame, entity: str, **context: Any) -> DataFrame:
    """The refined table ``source.entity`` of its payload. Lazy, like any transform."""
    return df.transform(ENTITIES[entity].refine, **context)


def refine_all(
    df: DataFrame,
    entities: Iterable[str],
    *,
    context: dict[str, dict[str, Any]] | None = None,
    landing: str | None = None,
    keep: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Several refined tables of one payload.

    From a columnar payload each output reads its own columns, and no more is needed. If the
    payload is dear to read (JSON text, a join), give a ``landing`` path: it is then brought
    to its declared schema, written once as parquet, and the outputs read that. ``keep``
    names the columns that ingestion added and the schema does not list. Each output then scans no
    more of the landed structs than it uses.
    """
    names = list(entities)
    payloads = {payload_of(name) for name in names}
    if len(payloads) != 1:
        raise ValueError(f"{names} come from different payloads: {sorted(payloads)}")
    if landing is not None:
        (payload,) = payloads
        if payload in SCHEMAS:
            added = [df.schema[column] for column in keep]
            df = conform(df, T.StructType([*schema_for(payload).fields, *added]))
        df = land(df, landing)

    def scanned(name: str) -> DataFrame:
        reads = ENTITIES[name].reads
        if landing is None or not reads:
            return df
        declared = {path.split(".")[0].lower() for path in schema_for(name).fieldNames()}
        added = [field for field in df.schema.fields if field.name.lower() not in declared]
        schema = T.StructType([*narrowed(df.schema, reads).fields, *added])
        return df.sparkSession.read.schema(schema).parquet(landing)

    return {name: refine(scanned(name), name, **(context or {}).get(name, {})) for name in names}
