from __future__ import annotations

from datetime import date
from math import isclose

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.functions import scalars as s
from corridor.functions import spatial, wkt


def one(spark, column, **values):
    data = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return data.select(column.alias("out")).first()["out"]


def each(spark, values, kind, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row["out"] for row in frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_rounding(spark):
    assert each(spark, [0.5, 1.5, 2.5, -0.5, -1.5, 2.4, None], "double", s.rounded_int) == [0, 2, 2, 0, -2, 2, None]
    assert each(spark, [2.5, 3.5], "double", s.rounded_bigint) == [2, 4]
    assert each(spark, [1.005, 2.675, 0.125, -2.5], "double", lambda v: s.rounded(v, 2)) == [1.0, 2.68, 0.13, -2.5]
    with pytest.raises(Exception, match="(?i)overflow"):
        each(spark, [3e9], "double", s.rounded_int)


def test_ratio_and_floors(spark):
    assert each(spark, [0.0, 2.0, None], "double", lambda v: s.ratio(F.lit(1.0), v)) == [None, 0.5, None]
    assert each(spark, [100.0, 900.0, None], "double", lambda v: s.at_least(v, 500.0)) == [500.0, 900.0, 500.0]
    assert each(spark, [0.05, 0.2, None], "double", lambda v: s.raised_to(v, 0.1)) == [0.1, 0.2, None]


def test_dates(spark):
    days = each(spark, ["2023-05-06", "2023-05-07", "2023-05-08"], "string", lambda v: s.weekday_from_sunday(s.iso_date(v)))
    assert days == [6, 0, 1]
    assert each(spark, ["20230131", "20230132", None], "string", lambda v: s.compact_date(v, True)) == [
        date(2023, 1, 31),
        None,
        None,
    ]
    with pytest.raises(Exception, match="2023-13-01"):
        each(spark, ["2023-13-01"], "string", s.iso_date)
    stamped = each(spark, ["2023-01-01T00:00:00.000+01:00"], "string", s.timestamp_text_date)
    assert stamped == [date(2023, 1, 1)]
    types = each(spark, ["2023-05-06", "2023-05-08"], "string", lambda v: s.day_type(s.iso_date(v)))
    assert types == ["Weekend", "Weekday"]


def test_casts_and_items(spark):
    assert each(spark, ["1.5", ".", None], "string", s.number_or_null) == [1.5, None, None]
    assert each(spark, ["0", "1"], "string", s.flag) == [False, True]
    assert each(spark, [0, 1], "int", s.flag) == [False, True]
    assert each(spark, [["a"], [], None], "array<string>", lambda v: s.item(v, 1)) == ["a", None, None]
    assert each(spark, [["a"]], "array<string>", lambda v: s.item(v, 3)) == [None]


GOLDEN = [
    (40.0, -3.0, 500000.0, 4427757.2),
    (40.9, -1.7, 609498.4, 4528469.6),
    (40.9, 0.9, 828527.8, 4534983.0),
    (37.8, 0.9, 843403.9, 4190794.5),
    (37.8, -1.7, 614448.3, 4184420.8),
]


def test_projection(spark):
    points = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(GOLDEN)], "i int, lat double, lon double")
    for row in spatial.transform_points(points).collect():
        _, _, east, north = GOLDEN[row["i"]]
        assert abs(row["x"] - east) < 1 and abs(row["y"] - north) < 1


def test_study_area_reads_latitude_first(spark):
    area = spatial.study_area(spark, "POLYGON((40.9 -1.7, 40.9 0.9, 37.8 0.9, 37.8 -1.7, 40.9 -1.7))")
    assert [round(x) for x, _ in area[0]] == [609498, 828528, 843404, 614448, 609498]
    swapped = spatial.study_area(spark, "POLYGON((-1.7 40.9, 0.9 40.9, 0.9 37.8, -1.7 40.9))", lat_first=False)
    assert swapped[0][:3] == area[0][:3]


CASES = {
    "square": (
        "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0))",
        {(5, 5): True, (15, 5): False, (0, 5): False, (5, 10): False, (0, 0): False, (10, 10): False, (-1, 5): False},
    ),
    "diamond": (
        "POLYGON((0 5, 5 0, 10 5, 5 10, 0 5))",
        {(1, 5): True, (-1, 5): False, (5, 5): True, (2.5, 2.5): False, (2, 2): False, (-5, 10): False, (-5, 0): False},
    ),
    "notch": (
        "POLYGON((0 0, 10 0, 10 10, 6 10, 6 4, 4 4, 4 10, 0 10, 0 0))",
        {(5, 5): False, (2, 8): True, (8, 8): True, (5, 2): True, (5, 4): False, (-1, 4): False, (1, 4): True},
    ),
    "hole": (
        "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))",
        {(5, 5): False, (2, 5): True, (4, 5): False, (7, 4): True, (3, 6): True},
    ),
    "parts": (
        "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))",
        {(0.5, 0.5): True, (5.5, 5.5): True, (3, 3): False},
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_within(spark, case):
    text, expected = CASES[case]
    points = spark.createDataFrame([(float(x), float(y), text) for x, y in expected], "x double, y double, geom string")
    area = spatial.study_area(spark, text, geographic=False)
    fixed = points.select("x", "y", spatial.within_area(F.col("x"), F.col("y"), area).alias("inside"))
    assert {(r["x"], r["y"]): r["inside"] for r in fixed.collect()} == expected
    by_column = points.select(
        "x", "y", spatial.within_rings(F.col("x"), F.col("y"), wkt.rings(F.col("geom"))).alias("inside")
    )
    assert {(r["x"], r["y"]): r["inside"] for r in by_column.collect()} == expected


def test_spheroid_known_distances(spark):
    points = spark.createDataFrame(
        [(0, 0.0, 0.0, 1.0, 0.0, 111319.491), (1, 0.0, 0.0, 0.0, 1.0, 110574.389), (2, -3.7, 40.4, -3.7, 40.4, 0.0),
         (3, -3.0, 90.0, 5.0, -90.0 + 90.0, 10001965.729)],
        "i int, lon1 double, lat1 double, lon2 double, lat2 double, want double",
    )
    ends = [F.col(name) for name in ("lon1", "lat1", "lon2", "lat2")]
    for row in points.select("want", spatial.spheroid_distance(*ends).alias("got")).collect():
        assert abs(row["got"] - row["want"]) < 0.001
    sphere = points.filter("i = 1").select(spatial.haversine_distance(*ends).alias("got")).first()["got"]
    assert isclose(sphere, 111195.08, abs_tol=0.01)
    with pytest.raises(Exception, match="not a longitude"):
        points.select(spatial.spheroid_distance(F.lit(500000.0), *ends[1:])).collect()


def test_spheroid_antipodal_distances(spark):
    # published values of nearly antipodal pairs, and half a meridian
    points = spark.createDataFrame(
        [(0.0, 0.0, 179.5, 0.5, 19936288.579), (0.0, 0.0, 179.7, 0.5, 19944127.421), (0.0, -30.0, 179.8, 29.9, 19989832.828),
         (0.0, 0.0, 180.0, 0.0, 20003931.459), (0.0, 90.0, 7.0, -90.0, 20003931.459), (10.0, 30.0, -170.0, -30.0, 20003931.459),
         (179.9, 0.0, -179.9, 0.0, 22263.898), (0.0, 0.0, 179.3, 0.0, 19959584.699),
         (None, 0.0, 180.0, 0.0, None)],
        "lon1 double, lat1 double, lon2 double, lat2 double, want double",
    )
    there = [F.col(name) for name in ("lon1", "lat1", "lon2", "lat2")]
    found = points.select("want", spatial.spheroid_distance(*there).alias("got"), spatial.spheroid_distance(*there[2:], *there[:2]).alias("back"))
    for row in found.collect():
        if row["want"] is None:
            assert row["got"] is None
        else:
            assert abs(row["got"] - row["want"]) < 0.001 and abs(row["back"] - row["got"]) < 1e-6


def test_spheroid_methods_agree():
    rng = np.random.default_rng(5)
    lon = rng.uniform(-180, 180, (2, 5000))
    lat = np.degrees(np.arcsin(rng.uniform(-1, 1, (2, 5000))))
    ends = (lon[0], lat[0], lon[1], lat[1])
    assert np.abs(spatial._vincenty(*ends) - spatial._by_azimuth(*ends)).max() < 0.001
    # all pairs around the antipode have a distance, the same from both ends
    over = (lon[0] + 360 + rng.uniform(-1, 1, 5000)) % 360 - 180
    back = np.clip(rng.uniform(-1, 1, 5000) - lat[0], -90, 90)
    there, again = spatial._vincenty(lon[0], lat[0], over, back), spatial._vincenty(over, back, lon[0], lat[0])
    assert np.abs(there - again).max() < 1e-6
    assert there.max() < 20003931.459 and there.min() > 19_800_000


def test_vertices_round_trip(spark):
    text = "POLYGON ((0 0, 10.5 0, 10.5 -7.25, 0 0), (1 1, 2 1, 2 2, 1 1))"
    zones = spark.createDataFrame([("z", text)], "id string, geom string")
    vertices = wkt.ring_vertices(zones, "id", "geom")
    assert rows(vertices)[1] == ("z", 0, 1, 10.5, 0.0)
    assert vertices.count() == 8
    assert rows(wkt.rings_to_text(vertices)) == [("z", text)]


def test_several_parts_round_trip(spark):
    text = "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1)), ((20 20, 21 20, 21 21, 20 20)))"
    zones = spark.createDataFrame([("m", text), ("p", "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "id string, geom string")
    vertices = wkt.ring_vertices(zones, "id", "geom", parts=True)
    assert sorted({(v["zone_id"], v["part"], v["ring"]) for v in vertices.collect()}) == [
        ("m", 0, 0), ("m", 0, 1), ("m", 1, 2), ("p", 0, 0)
    ]
    assert sorted(rows(wkt.rings_to_text(vertices))) == [("m", text), ("p", "POLYGON ((0 0, 1 0, 1 1, 0 0))")]
