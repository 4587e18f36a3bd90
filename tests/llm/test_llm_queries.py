"""The registered queries and the pipeline on the driver's smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


def keys():
    return sorted(k for k in contract.queries() if k.startswith("op") and k[2].isdigit())


def test_every_operator_has_a_query():
    assert {k[2:].split("_")[0] for k in keys()} == {str(n) for n in range(1, 14)} and "pipeline" in contract.queries()


@pytest.mark.parametrize("key", [k for k in keys() if k[:4] not in ("op11", "op12")])
def test_rows(spark, key):
    name = "pages" if key.startswith("op6") else "documents"
    want = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/{name}.parquet'").fetchall()[0][0]
    got = contract.queries()[key](spark, SF_DIR).count()
    assert got >= want if key.startswith("op8") else got == want


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.settle(stage(spark, docs, SF_DIR), "stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= rows
            rows = docs.count()
    assert docs.select("doc_id").distinct().count() == rows
    assert contract.queries()["pipeline"](spark, SF_DIR).count() == docs.count()


def test_stages_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, SF_DIR), "stage")
    assert docs.count() == 0
