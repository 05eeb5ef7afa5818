"""Reading raw records, fitting them to a schema, and writing refined tables."""

from refinery.sources.conform import conform, narrowed
from refinery.sources.keyed import merge_history_table, read_keyed, rewrite_touched, upsert_table, write_keyed
from refinery.sources.quarantine import Quarantine, quarantine, rejects
from refinery.sources.readers import read_entity, read_json_column, read_table
from refinery.sources.sinks import land, write_snapshot, write_table

__all__ = [
    "Quarantine",
    "conform",
    "land",
    "merge_history_table",
    "narrowed",
    "quarantine",
    "read_entity",
    "read_json_column",
    "read_keyed",
    "read_table",
    "rejects",
    "rewrite_touched",
    "upsert_table",
    "write_keyed",
    "write_snapshot",
    "write_table",
]
