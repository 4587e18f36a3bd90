"""A third of all rows under one key: results stay whole and plans stay distributed."""

from __future__ import annotations

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.operators import aggregates, loads, pairs, ranking, setops
from corridor.plans import gold
from corridor.session import settle

ROWS = 9_000


@pytest.fixture(scope="module")
def hot(spark):
    table = spark.range(ROWS).selectExpr(
        "CASE WHEN id < 3000 THEN 'hot' ELSE concat('k', id) END AS k",
        "CASE WHEN id < 3000 THEN 7.0D ELSE CAST(id AS DOUBLE) END AS v",
    )
    return settle(table, "hot")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_percent_rank_with_a_hot_value(spark, hot):
    ranked = ranking.percent_rank(hot, F.col("v"), "pr")
    assert ranked.count() == ROWS
    assert ranked.filter("k = 'hot'").select("pr").distinct().collect()[0][0] == 0.0
    assert ranked.filter("k <> 'hot'").agg(F.min("pr")).first()[0] == 3000 / (ROWS - 1)


def test_band_with_a_hot_value(spark, hot):
    assert ranking.percent_rank_band(hot, F.col("v"), 0.05, 0.95, 8).count() == 5550
    assert ranking.percent_rank_band(hot, F.col("v"), 0.0, 0.2, 8).count() == 3000


def test_upsert_with_a_hot_target_key_and_hot_nulls(spark, hot):
    target = hot.select(F.when(F.col("k") != "hot", F.col("k")).alias("k"), "v")
    source = spark.createDataFrame([("k5000", -1.0), (None, -2.0)], "k string, v double")
    merged = loads.upsert(target, source, ["k"])
    assert merged.count() == ROWS + 1
    assert rows(merged.filter("v < 0")) == [(None, -2.0), ("k5000", -1.0)]
    assert loads.upsert(hot, spark.createDataFrame([("hot", 0.0)], "k string, v double"), ["k"]).filter("v = 0").count() == 3000


def test_sums_fold_before_the_shuffle(spark, hot):
    od = hot.select(F.col("k").alias("origin_id"), F.col("k").alias("destination_id"), F.col("v").alias("travels"))
    for df in (aggregates.od_totals(od), setops.except_distinct(hot, hot.limit(1))):
        text = plan(df)
        assert re.search(r"HashAggregate.*partial_(sum|max)", text)


def test_distances_need_no_nested_loop(spark):
    zones = spark.range(600).select(
        F.col("id").cast("string").alias("distrito_id"),
        F.struct(F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y")).alias("centroide"),
    )
    found = pairs.pair_distances(settle(zones, "zones"))
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert found.count() == 600 * 599
    assert found.rdd.getNumPartitions() == 9


def test_report_orders_without_one_task(spark):
    gaps = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS gap_ratio", "'a' AS origin_id", "'b' AS destination_id")
    assert "rangepartitioning" in plan(gold.worst_first(gaps))
    assert "TakeOrderedAndProject" in plan(gold.worst_served(gaps, 3))
