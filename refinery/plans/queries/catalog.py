"""All registered queries, in one dictionary."""

from __future__ import annotations

from refinery.plans.queries import flat_entities, nested_entities, operators
from refinery.plans.queries.query import Query

QUERIES: dict[str, Query] = {
    **operators.CATALOG.queries,
    **flat_entities.CATALOG.queries,
    **nested_entities.CATALOG.queries,
}
