"""Every registered query against its SQL twin, at the smallest scale."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import TABLES, canonical  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query_equals_its_twin(spark, duck, key):
    got = contract.queries()[key](spark, SF_DIR).toPandas()
    want = duck.execute(contract.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("key", sorted(contract.queries().keys() - contract.oracle_sql().keys()))
def test_query_without_twin_gives_rows(spark, key):
    assert contract.queries()[key](spark, SF_DIR).count() > 0


def test_entry_is_the_flagship(spark):
    assert contract.entry(spark).count() > 0
    assert contract.entry(spark).schema == contract.entry(spark).schema
