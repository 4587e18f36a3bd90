from __future__ import annotations

import statistics
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from corridor.operators import aggregates, filters, joins, pairs, ranking, setops
from corridor.plans import silver


def test_null_handling_of_filters(spark):
    table = spark.createDataFrame([("a", "NA"), ("b", None), (None, "x")], "p string, q string")
    assert rows(filters.not_literally(table, "q")) == [(None, "x"), ("b", None)]
    assert rows(filters.all_present(table, ["p"])) == [("a", "NA"), ("b", None)]


RELATION = "seccion_ine string, distrito_ine string, municipio_ine string, distrito_mitma string, " \
    "municipio_mitma string, gau_mitma string"


def relation(spark):
    return spark.createDataFrame(
        [
            ("s1", "D1", "m", "z1", "M", None),
            ("s2", "D2", "m", "z1", "M", "NA"),
            ("s3", "D3", "m", "z2", "M", "G"),
            ("s4", "D3", "m", "z3", "M", "G"),
            ("s5", "D3", "m", "z3", "M", "G"),
            ("s6", "D9", None, "z9", "M", "G"),
        ],
        RELATION,
    )


def test_recoding_fans_out_and_drops(spark):
    kept = silver.relation(relation(spark))
    assert kept.count() == 5
    mapping = silver.district_map(kept)
    assert mapping.count() == 4
    day = date(2023, 5, 8)
    bronze = spark.createDataFrame(
        [
            (day, "01", "z1", "z2", 2.0, 1.0),
            (day, "1", "z1", "z3", 3.0, 1.0),
            (day, "02", "z3", "z2", 4.0, 1.0),
            (day, "01", "z9", "z2", 8.0, 1.0),
        ],
        "date date, period string, origin string, destination string, travels double, travels_km double",
    )
    assert rows(silver.trips(bronze, mapping).drop("travels_km")) == [
        (day, 1, "D1", "D3", 5.0),
        (day, 1, "D2", "D3", 5.0),
        (day, 2, "D3", "D3", 4.0),
    ]
    assert rows(silver.od_totals(bronze, mapping)) == rows(aggregates.od_totals(silver.trips(bronze, mapping)))


def test_raw_periods_stay_apart(spark):
    raw = spark.createDataFrame(
        [("20230508", "01", "a", "b", "1", "1"), ("20230508", "1", "a", "b", "2", "1")],
        "date string, period string, origin string, destination string, travels string, travels_km string",
    )
    found = aggregates.by_od_hour_raw(raw).select("period", "travels")
    assert rows(found) == [(1, 1.0), (1, 2.0)]


def test_demographics(spark):
    stamp = "2023-01-01T00:00:00.000+01:00"
    population = spark.createDataFrame(
        [("s1", stamp, 100.0), ("s2", stamp, 300.0), ("s3", stamp, 0.0), ("s3", "2022" + stamp[4:], 5.0)],
        "codigo string, fecha string, valor double",
    )
    income = spark.createDataFrame(
        [("s1", stamp, 10.0), ("s2", stamp, 20.0), ("s3", stamp, 7.0)], "codigo string, fecha string, valor double"
    )
    sections = spark.createDataFrame([("s1", "D1"), ("s2", "D1"), ("s3", "D2"), ("s3", "D2")], "seccion_ine string, distrito_ine string")
    assert rows(silver.demographics(population, income, sections)) == [
        ("D1", 2023, 7000.0, 17.5, 400),
        ("D2", 2023, 0.0, None, 0),
    ]


ZONES = [("A", 0.0, 0.0), ("B", 3000.0, 4000.0), ("C", 100.0, 0.0)]


def zones(spark, data=ZONES):
    flat = spark.createDataFrame(data, "distrito_id string, x double, y double")
    return flat.select("distrito_id", F.struct("x", "y").alias("centroide"))


def test_pair_distances(spark):
    found = {(a, b): d for a, b, d in pairs.pair_distances(zones(spark)).collect()}
    assert len(found) == 6
    assert found["A", "B"] == found["B", "A"] == 5000.0
    assert found["C", "A"] == 100.0


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_pairs_do_not_depend_on_blocks(spark, blocks):
    table = spark.range(40).selectExpr("lpad(id, 3, '0') AS k", "id AS n")
    found = pairs.unordered_pairs(table, "k", ["n"], blocks)
    assert found.count() == 40 * 39 // 2
    assert found.filter("a_k >= b_k OR a_n >= b_n").count() == 0
    assert found.distinct().count() == 40 * 39 // 2


def test_measuring_pairs_equals_joining_the_table(spark):
    doubled = zones(spark, [*ZONES, ("B", 10.0, 10.0)])
    od = spark.createDataFrame(
        [("A", "B", 1.0), ("B", "A", 2.0), ("A", "A", 3.0), ("B", "B", 4.0), ("C", "X", 5.0), ("C", "A", 6.0)],
        "origin_id string, destination_id string, actual_trips double",
    )
    by_table = joins.listed_distances(od, pairs.pair_distances(doubled))
    measured = pairs.with_distances(od, doubled)
    assert rows(measured) == rows(by_table.select(*measured.columns))
    assert measured.count() == 5


def test_zone_listed_twice_counts_twice_unless_semi(spark):
    trips = spark.createDataFrame([("A", "B", 1), ("A", "C", 2)], "origin_id string, destination_id string, n int")
    listed = spark.createDataFrame([("A",), ("B",), ("B",)], "distrito_id string")
    assert joins.both_ends_in_zones(trips, listed).count() == 2
    assert rows(joins.both_ends_in_zones(trips, listed, semi=True)) == [("A", "B", 1)]


def test_mirror_keeps_other_columns(spark):
    half = spark.createDataFrame([("a", "b", 1.5)], "p string, q string, d double")
    assert rows(setops.mirrored(half, "p", "q")) == [("a", "b", 1.5), ("b", "a", 1.5)]


def ranked_input(spark):
    return spark.range(3000).selectExpr(
        "id",
        "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 5.5 ELSE CAST(pmod(hash(id), 400) AS DOUBLE) / 8 END AS v",
    )


@pytest.mark.parametrize("ranges", [1, 2, 13, None])
def test_percent_rank_equals_the_window(spark, ranges, monkeypatch):
    table = ranked_input(spark)
    want = table.withColumn("pr", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())))
    ranks = ranking.value_ranks(table, F.col("v"), ranges)
    per_value = {r["value"]: (r["rank"] - 1) / (r["total"] - 1) for r in ranks.collect()}
    assert all(per_value[r["v"]] == r["pr"] for r in want.collect())
    if ranges is None:
        monkeypatch.setattr(ranking, "VALUES_PER_RANGE", 30)
        assert rows(ranking.percent_rank(table, F.col("v"), "pr")) == rows(want)


@pytest.mark.parametrize("ranges", [1, 2, 13, 64])
@pytest.mark.parametrize("band", [(0.05, 0.95), (0.0, 1.0), (0.3, 0.31), (0.9, 1.0), (0.35, 0.5)])
def test_band_equals_the_window(spark, ranges, band):
    table = ranked_input(spark)
    pr = F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last()))
    want = table.withColumn("pr", pr).filter(F.col("pr").between(*band)).select("id")
    got = ranking.percent_rank_band(table, F.col("v"), *band, ranges).select("id")
    assert {r[0] for r in got.collect()} == {r[0] for r in want.collect()}


def test_ranges_stay_small_code_at_their_most(spark):
    table = spark.range(5000).select((F.col("id") * 7 % 5000).cast("double").alias("v"))
    cuts = [float(5 * i) for i in range(1, ranking.MOST_RANGES)]
    placed = table.select("v", ranking._range_of("v", cuts).alias("r"))
    assert placed.filter(F.least(F.floor(F.col("v") / 5), F.lit(len(cuts))) != F.col("r")).count() == 0
    ranked = ranking.percent_rank(table, F.col("v"), "pr")
    assert ranked.filter(F.abs(F.col("pr") - F.col("v") / 4999) > 1e-12).count() == 0


def test_percent_rank_of_one_row_and_none(spark):
    one = spark.createDataFrame([(1, 2.0)], "id int, v double")
    assert rows(ranking.percent_rank(one, F.col("v"), "pr")) == [(1, 2.0, 0.0)]
    assert ranking.percent_rank_band(one.limit(0), F.col("v"), 0.0, 1.0).count() == 0


def test_exact_median(spark):
    table = spark.range(2001).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 2 END AS g",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE pmod(hash(id), 1000) / 10.0D END AS v",
    )
    groups: dict = {}
    for row in table.collect():
        if row["v"] is not None:
            groups.setdefault(row["g"], []).append(row["v"])
    found = {r["g"]: r["m"] for r in aggregates.exact_median(table, ["g"], "v", "m").collect()}
    assert found.keys() == groups.keys()
    for group, values in groups.items():
        assert abs(found[group] - statistics.median(values)) < 1e-12


def weekly(spark):
    return spark.createDataFrame(
        [
            (date(2023, 5, 8), "a", "b", 1.25),
            (date(2023, 5, 14), "a", "b", 1.25),
            (date(2023, 5, 15), "a", "b", 3.5),
            (date(2023, 5, 21), "c", "d", 2.0),
            (date(2023, 5, 22), "c", "d", 9.0),
        ],
        "date date, origin_id string, destination_id string, travels double",
    )


def test_weekly_partials_round_half_even(spark):
    partials = aggregates.weekly_partials(weekly(spark), "2023-05-08", "2023-05-21")
    assert rows(partials) == [(0, "a", "b", 2), (1, "a", "b", 4), (1, "c", "d", 2)]
    assert rows(aggregates.from_partials(partials)) == [("a", "b", 6), ("c", "d", 2)]
    exact = aggregates.weekly_partials(weekly(spark), "2023-05-08", "2023-05-21", exact=True)
    assert rows(aggregates.from_partials(exact)) == [("a", "b", 6.0), ("c", "d", 2.0)]
    direct = aggregates.od_totals(filters.between_days(weekly(spark), "2023-05-08", "2023-05-21"))
    assert rows(aggregates.from_partials(exact)) == rows(direct)


def test_calendar_join_keeps_unknown_days(spark):
    patterns = spark.createDataFrame([(date(2023, 5, 1), 0), (date(2023, 5, 2), 1)], "date date, pattern_type int")
    calendar = spark.createDataFrame([(date(2023, 5, 1), True)], "date date, is_holiday boolean")
    assert rows(joins.with_calendar(patterns, calendar)) == [
        (date(2023, 5, 1), 0, True),
        (date(2023, 5, 2), 1, None),
    ]


def test_mean_gap_by_zone_with_doubled_outline(spark):
    gaps = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", 4.0)], "origin_id string, gap_ratio double")
    outlines = spark.createDataFrame([("a", "P1"), ("a", "P1"), ("b", "P2"), ("b", "P3")], "distrito_id string, geometria string")
    assert rows(aggregates.mean_gap_by_zone(gaps, outlines)) == [("a", 1.5, "P1"), ("b", 4.0, "P2"), ("b", 4.0, "P3")]


def test_median_states_merge_to_any_range_and_replace_a_day(spark):
    def trips(day, values):
        return [(date(2023, 5, day), 7, v) for v in values]

    # a Monday, a Tuesday, a Saturday
    table = spark.createDataFrame(
        trips(1, [float(v) for v in range(5000)])
        + trips(2, [float(v) for v in range(5000, 10000)] + [None])
        + trips(6, [3.0, 3.0, 3.0])
        + [(date(2023, 5, 7), 9, None)],
        "date date, period int, travels double",
    )
    states = aggregates.median_states(table)
    medians = aggregates.medians_from_states(states)
    found = {(r["period"], r["day_type"]): r for r in aggregates.median_rank_errors(table, medians).collect()}
    week = found[7, "Weekday"]
    assert week["n"] == 10000 and week["total_trips"] == sum(range(10000))
    assert abs(week["median_trips_per_hour"] - 5000) <= 10000 * aggregates.MOST_RANK_ERROR
    # the counted error is that of the value itself
    assert abs(week["rank_error"] - abs(week["median_trips_per_hour"] - 5000) / 10000) <= 0.0002
    assert (found[7, "Weekend"]["median_trips_per_hour"], found[7, "Weekend"]["rank_error"]) == (3.0, 0.0)
    assert (found[9, "Weekend"]["n"], found[9, "Weekend"]["median_trips_per_hour"]) == (0, None)
    one = aggregates.medians_from_states(states, "2023-05-02", "2023-05-02").collect()
    assert len(one) == 1 and abs(one[0]["median_trips_per_hour"] - 7500) <= 5000 * aggregates.MOST_RANK_ERROR
    late = spark.createDataFrame(trips(2, [1.0]), table.schema)
    renewed = states.filter("date <> DATE'2023-05-02'").unionByName(aggregates.median_states(late))
    again = {(r["period"], r["day_type"]): r["n"] for r in aggregates.medians_from_states(renewed).collect()}
    assert again[7, "Weekday"] == 5001
    assert aggregates.medians_from_states(states.limit(0)).count() == 0
