"""Every registered query against its SQL in DuckDB, over the whole small tables."""

import os
from pathlib import Path

import pytest

from __spark_entry__ import entry
from refinery.plans.queries.catalog import QUERIES
from tools.check_oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, QUERIES[name].run, QUERIES[name].oracle).startswith("ok")


def test_every_query_has_an_oracle_and_every_entity_a_query():
    from refinery.plans.registry import ENTITIES

    assert all(query.oracle for query in QUERIES.values())
    assert {name.replace(".", "_") for name in ENTITIES} <= set(QUERIES)


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["order_id", "label", "weight", "price", "nr"]
    assert frame.count() > 0
