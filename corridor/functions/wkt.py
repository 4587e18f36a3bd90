"""Zone geometry as text: points, polygon rings, vertices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = r"(?i)^\s*POINT\s*\(\s*(\S+)\s+([^\s)]+)\s*\)\s*$"
RING = r"\(([^()]+)\)"
BETWEEN_PARTS = r"\)\s*\)\s*,\s*\(\s*\("


def point(text: Column) -> Column:
    """``POINT (x y)`` to a struct of two doubles."""
    return F.struct(
        F.regexp_extract(text, POINT, 1).try_cast("double").alias("x"),
        F.regexp_extract(text, POINT, 2).try_cast("double").alias("y"),
    )


def _vertex(text: Column) -> Column:
    parts = F.split(F.trim(text), r"\s+")
    return F.struct(
        F.get(parts, F.lit(0)).cast("double").alias("x"),
        F.get(parts, F.lit(1)).cast("double").alias("y"),
    )


def rings(text: Column) -> Column:
    """Every ring of a POLYGON or MULTIPOLYGON, each an array of x, y structs."""
    found = F.regexp_extract_all(text, F.lit(RING), F.lit(1))
    return F.transform(found, lambda ring: F.transform(F.split(ring, ","), _vertex))


def _part_rings(text: Column) -> Column:
    """The same rings with the number of the part each belongs to."""

    def of_part(part: Column, number: Column) -> Column:
        closed = F.concat(F.lit("("), part, F.lit(")"))
        return F.transform(rings(closed), lambda points: F.struct(number.alias("part"), points.alias("points")))

    return F.flatten(F.transform(F.split(text, BETWEEN_PARTS), of_part))


def ring_vertices(zones: DataFrame, zone_id: str, geometry: str, parts: bool = False) -> DataFrame:
    """One row per vertex: zone, ring number, position in the ring, x, y.

    Rings are numbered through all parts of a zone. With ``parts`` the number
    of the part is a column too, so that several parts can be written back.
    """
    by_ring = zones.select(
        F.col(zone_id).alias("zone_id"), F.posexplode(_part_rings(F.col(geometry))).alias("ring", "found")
    )
    by_vertex = by_ring.select(
        "zone_id", "ring", F.col("found.part").alias("part"), F.posexplode("found.points").alias("seq", "vertex")
    )
    part = ["part"] if parts else []
    return by_vertex.select("zone_id", *part, "ring", "seq", F.col("vertex.x"), F.col("vertex.y"))


def rings_to_text(vertices: DataFrame) -> DataFrame:
    """Vertex rows back to one text per zone, in part, ring and vertex order: a
    MULTIPOLYGON if the zone has several parts, else a POLYGON.

    Without a column ``part`` all rings are one part. A ring is grouped first,
    then a part and then a zone, so no group holds more than one zone's outline.
    """
    if "part" not in vertices.columns:
        vertices = vertices.withColumn("part", F.lit(0))

    def listed(texts: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(texts, ", "), F.lit(")"))

    corner = F.struct("seq", "x", "y")
    by_ring = vertices.groupBy("zone_id", "part", "ring").agg(
        listed(
            F.transform(
                F.sort_array(F.collect_list(corner)),
                lambda v: F.concat_ws(" ", plain_number(v["x"]), plain_number(v["y"])),
            )
        ).alias("text")
    )
    by_part = by_ring.groupBy("zone_id", "part").agg(
        listed(F.transform(F.sort_array(F.collect_list(F.struct("ring", "text"))), lambda r: r["text"])).alias("text")
    )
    whole = by_part.groupBy("zone_id").agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts"))
    texts = F.transform("parts", lambda p: p["text"])
    return whole.select(
        "zone_id",
        F.when(F.size("parts") > 1, F.concat(F.lit("MULTIPOLYGON "), listed(texts)))
        .otherwise(F.concat(F.lit("POLYGON "), F.get(texts, F.lit(0))))
        .alias("geom_wkt"),
    )


def plain_number(value: Column) -> Column:
    """A double as text without an exponent, and without ``.0`` on whole numbers."""
    whole = value.cast("decimal(38,0)")
    return F.when(value == whole.cast("double"), whole.cast("string")).otherwise(
        F.regexp_replace(value.cast("decimal(38,12)").cast("string"), r"0+$", "")
    )
