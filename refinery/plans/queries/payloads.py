"""Raw payloads made from the given tables, row by row, in the layouts the entities read.

Flat payloads follow one rule, written in SQL that both engines run, so that the oracle sees
the same input: every field gets a value of its own, every ninth one is NULL. Nested payloads
are Spark SQL; their oracles say the same over plain rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from refinery.plans.queries.query import table
from refinery.plans.registry import SCHEMAS


@dataclass(frozen=True)
class Base:
    """A given table: its key, its numbers, an expression for a day, and its time column."""

    table: str
    key: str
    whole: tuple[str, ...]
    real: tuple[str, ...]
    day: str
    time: str | None = None


LINES = Base(
    "lineitem",
    "l_orderkey",
    ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    "cast(l_shipdate as date)",
    "l_shipdate",
)
ORDERS = Base(
    "orders",
    "o_orderkey",
    ("o_orderkey", "o_custkey"),
    ("o_totalprice",),
    "cast(o_orderdate as date)",
    "o_orderdate",
)
EVENTS = Base("events", "event_id", ("event_id", "user_id"), ("value",), "cast(ts as date)", "ts")
PARTS = Base(
    "part", "p_partkey", ("p_partkey", "p_size"), ("p_retailprice",), "date '2020-01-01' + p_size"
)
CUSTOMERS = Base(
    "customer", "c_custkey", ("c_custkey", "c_nationkey"), ("c_acctbal",), "date '2020-01-01' + c_nationkey"
)

SIMPLE_FIELD = re.compile(r"^\s*(\w+)\s+(string|int|bigint|double|boolean|timestamp)\s*$")


def simple_fields(ddl: str) -> dict[str, str]:
    """The fields of a DDL text that are no structs or arrays, with their types."""
    depth, fields, current = 0, [], ""
    for character in ddl:
        depth += {"<": 1, ">": -1}.get(character, 0)
        if character == "," and depth == 0:
            fields.append(current)
            current = ""
        else:
            current += character
    matches = [SIMPLE_FIELD.match(text) for text in [*fields, current]]
    return {match[1]: match[2] for match in matches if match}


@dataclass(frozen=True)
class FlatPayload:
    base: Base
    fields: Mapping[str, str]

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        source = table(spark, folder, self.base.table)
        return source.selectExpr(*[f"{value} as {name}" for name, value in self.fields.items()])

    def sql(self) -> str:
        """The payload as the body of a common table expression."""
        columns = ", ".join(f"{value} AS {name}" for name, value in self.fields.items())
        return f"SELECT {columns} FROM {self.base.table}"

    def oracle(self, select: str) -> str:
        return f"WITH payload AS ({self.sql()}) {select}"


def flat(
    base: Base,
    ddl: str,
    *,
    days: Iterable[str] = (),
    moments: Iterable[str] = (),
    **own: str,
) -> FlatPayload:
    """``days`` and ``moments`` are text fields with a date or time, one in seven unreadable;
    ``own`` gives single fields an expression of their own."""
    ddl = SCHEMAS.get(ddl, ddl)
    fields = {}
    for i, (name, kind) in enumerate(simple_fields(ddl).items()):
        whole, real = base.whole[i % len(base.whole)], base.real[i % len(base.real)]
        day = f"cast({base.day} as string)"
        if name in days:
            value = f"case when ({base.key} + {i}) % 7 = 0 then 'unknown' else {day} end"
        elif name in moments:
            clock = f"lpad(cast(({base.key} + {i}) % 24 as string), 2, '0')"
            value = (
                f"case when ({base.key} + {i}) % 7 = 0 then 'unknown' else {day} || 'T' || {clock} || ':30:00' end"
            )
        elif kind == "string":
            value = f"'{name} ' || cast({whole} as string)"
        elif kind in ("int", "bigint"):
            value = f"cast({whole} % 1000 + {i} as {kind})"
        elif kind == "double":
            value = f"{real} + {i}"
        elif kind == "boolean":
            value = f"({whole} + {i}) % 2 = 0"
        else:
            value = base.time
        fields[name] = f"case when ({base.key} + {i}) % 9 = 0 then null else {value} end"
    return FlatPayload(base, {**fields, **own})


def branch(base: Base) -> str:
    """The branch a record was fetched for; missing now and then."""
    return f"case when {base.key} % 31 = 0 then null else 'V' || cast({base.key} % 7 as string) end"


# Children are made from the parent's row and the child's number ``i``. Their fields are SQL
# for both engines; a dictionary in place of a text is a struct.
Fields = Mapping[str, "str | Fields"]


@dataclass(frozen=True)
class Children:
    """Up to ``most`` children per row, ``count`` of them; no array at all where ``missing``."""

    fields: Fields
    count: str
    most: int = 3
    missing: str = "false"

    def array(self, more: Fields | None = None) -> str:
        """The array, in Spark SQL; ``more`` adds fields that only Spark sees."""
        items = numbered(struct({**self.fields, **(more or {})}), "i", self.most, self.count)
        return f"case when not ({self.missing}) then {items} end"

    def rows(self, base: str, keep: str) -> str:
        """The children as rows, in the oracle's SQL; nested fields get dotted names."""
        columns = ", ".join(f'{value} AS "{name}"' for name, value in dotted(self.fields).items())
        return f"""SELECT {keep}, {columns} FROM {base}, unnest(range(1, {self.most + 1})) AS t(i)
                   WHERE i <= {self.count} AND NOT ({self.missing})"""


def struct(fields: Fields) -> str:
    """A struct in Spark SQL."""
    parts = [f"'{name}', {value if isinstance(value, str) else struct(value)}" for name, value in fields.items()]
    return f"named_struct({', '.join(parts)})"


def dotted(fields: Fields, prefix: str = "") -> dict[str, str]:
    flat_fields: dict[str, str] = {}
    for name, value in fields.items():
        path = f"{prefix}{name}"
        flat_fields |= {path: value} if isinstance(value, str) else dotted(value, f"{path}.")
    return flat_fields


def numbered(item: str, variable: str, most: int, count: str) -> str:
    """The first ``count`` of the items for 1 to ``most``, in Spark SQL.

    The items are spelled out rather than made by a lambda, since Spark compiles plain
    expressions and interprets lambdas.
    """
    items = [re.sub(rf"\b{variable}\b", str(number), item) for number in range(1, most + 1)]
    too_many = f"raise_error(concat('more than {most} items: ', {count}))"
    return f"slice(array({', '.join(items)}), 1, if({count} > {most}, cast({too_many} as int), cast({count} as int)))"
