"""Zone centroids and outlines, as WKT tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions import wkt
from corridor.schemas import ZONE_WKT

# The three zone levels.
LEVELS = ["distritos", "gaus", "municipios"]


def read_zone_table(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """(ID, geom) from a pipe-delimited, Parquet or JSON Lines table."""
    reader = spark.read.schema(ZONE_WKT)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", "|")
    return reader.format(fmt).load(path)


def centroids(zones: DataFrame) -> DataFrame:
    """(distrito_id, centroide) with the centroid as a struct of x and y."""
    return zones.select(F.col("ID").alias("distrito_id"), wkt.point(F.col("geom")).alias("centroide"))


def outlines(zones: DataFrame) -> DataFrame:
    """(distrito_id, geometria) with the outline as text."""
    return zones.select(F.col("ID").alias("distrito_id"), F.col("geom").alias("geometria"))
