"""Joins by place: points in polygons, and pairs within a distance, without all pairs.

Both spread one side over the cells of a grid and meet on the cell, an ordinary equi-join that Spark
shuffles, broadcasts or splits as it sees fit; the exact test follows on the pairs that met. Every
pair that passes the test meets exactly once.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.functions import wkt
from corridor.functions.spatial import planar_distance, within_rings
from corridor.session import settle

#: Side of the finest cells, in the coordinates' unit.
FINEST = 1.0
#: Side of the coarsest: 2 ** LEVELS finest cells.
LEVELS = 40


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size).cast("bigint")


def boxed(polygons: DataFrame, key: str, geometry: str) -> DataFrame:
    """(key, rings, x1, y1, x2, y2): outlines read from text, with their bounding boxes. Outlines without a ring go."""
    rings = polygons.select(F.col(key).alias("polygon_id"), wkt.rings(F.col(geometry)).alias("rings")).filter(F.size("rings") > 0)
    corners = F.flatten("rings")
    ends = {
        "x1": F.array_min(F.transform(corners, lambda c: c["x"])), "y1": F.array_min(F.transform(corners, lambda c: c["y"])),
        "x2": F.array_max(F.transform(corners, lambda c: c["x"])), "y2": F.array_max(F.transform(corners, lambda c: c["y"])),
    }
    return rings.withColumns(ends)


def points_in_polygons(points: DataFrame, polygons: DataFrame, key: str, geometry: str, x: str = "x", y: str = "y") -> DataFrame:
    """Every point with every polygon it lies strictly inside: the points' columns and polygon_id.

    Each polygon lies on the grid level whose cells are at least as large as its box, so it covers at
    most two by two cells, however large it is; a point looks into its one cell of each level that
    holds a polygon, at most ``LEVELS`` + 1. Holes and several parts count by the even-odd rule; a
    point on an edge, or without a coordinate, lies in no polygon. Rows that repeat stay apart.
    """
    size = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(FINEST)) / FINEST
    level = F.least(F.ceil(F.log2(size)), F.lit(LEVELS)).cast("int")
    side = F.pow(F.lit(2.0), F.col("level")) * FINEST
    outlines = settle(boxed(polygons, key, geometry).withColumn("level", level), "outlines")
    spread = outlines.withColumns({
        "cx": F.explode(F.sequence(_cell(F.col("x1"), side), _cell(F.col("x2"), side))),
    }).withColumn("cy", F.explode(F.sequence(_cell(F.col("y1"), side), _cell(F.col("y2"), side))))
    levels = [row[0] for row in outlines.select("level").distinct().collect()]  # at most LEVELS + 1
    placed = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    probes = placed.withColumn("_at", F.explode(F.lit(levels or [0]).cast("array<int>")))
    probe_side = F.pow(F.lit(2.0), F.col("_at")) * FINEST
    probes = probes.withColumns({"_cx": _cell(F.col(x), probe_side), "_cy": _cell(F.col(y), probe_side)}).alias("p")
    met = probes.join(
        spread.alias("g"),
        (F.col("p._at") == F.col("g.level")) & (F.col("p._cx") == F.col("g.cx")) & (F.col("p._cy") == F.col("g.cy")),
    )
    px, py = F.col(f"p.{x}").cast("double"), F.col(f"p.{y}").cast("double")
    boxed_in = px.between(F.col("g.x1"), F.col("g.x2")) & py.between(F.col("g.y1"), F.col("g.y2"))
    inside = met.filter(boxed_in).filter(within_rings(px, py, F.col("g.rings")))
    return inside.select(*(F.col(f"p.{name}") for name in points.columns), F.col("g.polygon_id"))


def pairs_within(points: DataFrame, key: str, radius: float, x: str = "x", y: str = "y", mirror: bool = False) -> DataFrame:
    """(a_key, b_key, distance_meters) of all pairs with ``a.key < b.key`` at most ``radius`` apart; both ways with ``mirror``.

    Cells are as large as the radius. One side stays in its home cell, the other is copied to the nine
    cells around its own: a pair meets in the first one's home cell and nowhere else. The result, and
    the work, grow with the points' number times how many lie around each, not with its square. A key
    that is listed twice is paired once for each of its rows; points without a coordinate are in no pair.
    """
    if not radius > 0:
        raise ValueError("the radius must be positive")
    flat = points.select(F.col(key).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    flat = flat.filter("x IS NOT NULL AND y IS NOT NULL AND k IS NOT NULL")
    home = flat.withColumns({"cx": _cell(F.col("x"), F.lit(radius)), "cy": _cell(F.col("y"), F.lit(radius))})
    around = home.withColumn("cx", F.explode(F.sequence(F.col("cx") - 1, F.col("cx") + 1))).withColumn(
        "cy", F.explode(F.sequence(F.col("cy") - 1, F.col("cy") + 1))
    )
    a, b = home.alias("a"), around.alias("b")
    same_cell = (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    order = F.col("a.k") != F.col("b.k") if mirror else F.col("a.k") < F.col("b.k")
    metres = planar_distance(F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y"))
    met = a.join(b, same_cell).filter(order).withColumn("distance_meters", metres)
    return met.filter(F.col("distance_meters") <= radius).select(
        F.col("a.k").alias(f"a_{key}"), F.col("b.k").alias(f"b_{key}"), "distance_meters"
    )


def grid_level(extent: float) -> int:
    """The level a box of this larger side lies on."""
    return min(LEVELS, ceil(log2(max(extent, FINEST) / FINEST)))
