"""Column builders: keys, tolerant parsing, and value rules."""

from refinery.functions.keys import foreign_key, full_name, tenant_key
from refinery.functions.parsing import (
    as_of_date,
    cents_to_decimal,
    instant_date,
    is_recent,
    parse_date,
    parse_int,
    parse_timestamp,
    utc_to_local,
    written_date,
)
from refinery.functions.values import (
    blank_to_null,
    clamp_to_null,
    const,
    flag,
    lookup,
    nth,
    prefix_class,
    preferred_date,
    time_of_day,
)

__all__ = [
    "as_of_date",
    "blank_to_null",
    "cents_to_decimal",
    "clamp_to_null",
    "const",
    "flag",
    "foreign_key",
    "full_name",
    "instant_date",
    "is_recent",
    "lookup",
    "nth",
    "parse_date",
    "parse_int",
    "parse_timestamp",
    "preferred_date",
    "prefix_class",
    "tenant_key",
    "time_of_day",
    "utc_to_local",
    "written_date",
]
