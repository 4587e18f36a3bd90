from __future__ import annotations

import random
from math import dist, hypot

import pytest
from pyspark.sql import functions as F

from corridor.operators import spatial_joins

POINTS = "id int, x double, y double, level int, cx string, rings int"


def points_table(spark, points):
    """Points with extra columns that the joins use as names of their own."""
    return spark.createDataFrame([(i, x, y, 1, "c", 2) for i, (x, y) in enumerate(points)], POINTS).repartition(3)


def inside(point, rings):
    x, y = point
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            on_line = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
            if on_line and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def square(x, y, half):
    return [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]


def text(rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in ring) + ")" for ring in rings) + ")"


def test_points_in_polygons_of_all_sizes(spark):
    pick = random.Random(2)
    outlines = {f"s{k}": [square(pick.randint(-50, 50), pick.randint(-50, 50), pick.choice([1, 2, 5]))] for k in range(25)}
    outlines |= {"country": [square(0, 0, 10_000)], "ring": [square(3, 3, 20), square(3, 3, 8)], "dot": [square(7, 7, 0)]}
    outlines["notch"] = [[(0, 0), (40, 0), (40, 40), (20, 10), (0, 40), (0, 0)]]
    grid = [(pick.randint(-60, 60), pick.randint(-60, 60)) for _ in range(300)] + [(0.5, 0.25), (-0.5, 0.0), (9999.0, -9999.0), (10_000, 0)]
    points = [(float(x), float(y)) for x, y in grid] + [(1.0, 1.0)] * 40
    zones = spark.createDataFrame([(k, text(r)) for k, r in outlines.items()] + [("none", None), ("empty", "POLYGON EMPTY")], "zone string, geom string")
    table = points_table(spark, points).unionByName(spark.createDataFrame([(900, None, 1.0, 1, "c", 2), (901, 1.0, None, 1, "c", 2)], POINTS))
    found = spatial_joins.points_in_polygons(table, zones, "zone", "geom")
    assert found.columns == [*table.columns, "polygon_id"]
    got = sorted((r["id"], r["polygon_id"]) for r in found.collect())
    assert got == sorted((i, k) for i, p in enumerate(points) for k, rings in outlines.items() if inside(p, rings))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_polygons_and_no_points(spark):
    zones = spark.createDataFrame([("a", text([square(0, 0, 5)]))], "zone string, geom string")
    points = points_table(spark, [(0.0, 0.0)])
    assert spatial_joins.points_in_polygons(points, zones.limit(0), "zone", "geom").count() == 0
    assert spatial_joins.points_in_polygons(points.limit(0), zones, "zone", "geom").count() == 0


@pytest.mark.parametrize("radius", [0.5, 3.0, 10.0])
@pytest.mark.parametrize("mirror", [False, True])
def test_pairs_within(spark, radius, mirror):
    pick = random.Random(4)
    points = [(pick.choice([-1, 1]) * pick.randint(0, 40) / 2, float(pick.randint(-20, 20))) for _ in range(150)] + [(1.0, 1.0)] * 5
    table = points_table(spark, points).unionByName(spark.createDataFrame([(900, None, 1.0, 1, "c", 2)], POINTS))
    found = spatial_joins.pairs_within(table, "id", radius, mirror=mirror)
    got = sorted((r["a_id"], r["b_id"]) for r in found.collect())
    want = [(i, j) for i, p in enumerate(points) for j, q in enumerate(points) if (i != j if mirror else i < j) and hypot(p[0] - q[0], p[1] - q[1]) <= radius]
    assert got == sorted(want)
    for r in found.limit(20).collect():
        assert r["distance_meters"] == pytest.approx(dist(points[r["a_id"]], points[r["b_id"]]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_polygon_covers_four_cells_at_most(spark):
    for extent in (0.3, 1.0, 1.5, 700.0, 2.0**20 + 1):
        side = 2.0 ** spatial_joins.grid_level(extent)
        assert side >= extent and (side == 1.0 or side < 2 * extent)
    with pytest.raises(ValueError, match="positive"):
        spatial_joins.pairs_within(points_table(spark, [(0.0, 0.0)]).withColumn("x", F.col("x")), "id", 0)
