"""The publication feed: which file belongs to which table and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.schemas import FEED_ITEM

# Title patterns of the published files, the table each one
# feeds, and the marker a trip file's link carries.
DIMENSION_TITLES = {
    "bronze_distritos_nombres": "nombres_distritos.csv",
    "bronze_gaus_nombres": "nombres_gaus.csv",
    "bronze_municipios_nombres": "nombres_municipios.csv",
    "bronze_relacion_ine": "relacion_ine_zonificacionMitma.csv",
}
TRIP_TITLES = {
    "bronze_mitma_viajes_distritos": "Viajes_distritos",
    "bronze_mitma_viajes_gau": "Viajes_GAU",
    "bronze_mitma_viajes_municipios": "Viajes_municipios",
}
TRIP_LINK_MARKER = "estudios_basicos"
GEOMETRY_TITLES = {"bronze_zona_distritos": "zonificacion_distritos"}


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """(title, link, pos) of every feed item. ``pos`` is the item's place in the
    document, taken from the item if it has one, else from the reading order."""
    items = spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(path)
    return items.withColumn("pos", F.coalesce("pos", F.monotonically_increasing_id()))


def dimension_files(items: DataFrame, titles: dict[str, str] = DIMENSION_TITLES) -> DataFrame:
    """(url, table) of the items whose title contains a table's file name; with
    ``GEOMETRY_TITLES`` the archives of zone outlines."""
    hits = [
        F.when(F.contains("title", F.lit(title)), F.lit(table)) for table, title in titles.items()
    ]
    found = items.select("link", F.explode(F.array_compact(F.array(*hits))).alias("table"))
    return found.select(F.col("link").alias("url"), "table")


def trip_files(
    items: DataFrame, titles: dict[str, str] = TRIP_TITLES, marker: str = TRIP_LINK_MARKER
) -> DataFrame:
    """(url, table, day, pos): items whose title matches a table's pattern and
    holds a date, and whose link contains the marker."""
    hits = [F.when(F.col("title").rlike(title), F.lit(table)) for table, title in titles.items()]
    wanted = items.filter(F.contains("link", F.lit(marker))).filter(
        reduce(lambda a, b: a | b, [F.col("title").rlike(title) for title in titles.values()])
    )
    by_table = wanted.select("link", "title", "pos", F.explode(F.array_compact(F.array(*hits))).alias("table"))
    # every run of eight digits, overlapping ones too, may be the wanted date
    runs = F.array_distinct(F.regexp_extract_all("title", F.lit(r"(?=(\d{8}))"), F.lit(1)))
    dated = by_table.select("link", "table", "pos", F.explode(runs).alias("run"))
    return dated.select(
        F.col("link").alias("url"), "table", F.try_to_date("run", "yyyyMMdd").alias("day"), "pos"
    ).filter(F.col("day").isNotNull())


def first_file_per_day(files: DataFrame, start: str, end: str) -> DataFrame:
    """For each table and day in [start, end] the first item in document order;
    days without one are absent."""
    inside = files.filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return inside.groupBy("table", "day").agg(F.min_by("url", "pos").alias("url"))
