"""Joins between trips, zones, statistics and calendars.

No join forces a broadcast. Dimension tables come from written tables, so Spark
knows their size and broadcasts one only under its automatic threshold; above
it the join shuffles and adaptive execution splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.functions.scalars import timestamp_text_date


def zone_geometries(centroids: DataFrame, outlines: DataFrame, mapping: DataFrame) -> DataFrame:
    """Centroid and outline under the statistical district code. A zone mapped
    to several codes yields several rows."""
    codes = mapping.withColumnRenamed("distrito_mitma", "distrito_id")
    return (
        centroids.join(outlines, "distrito_id")
        .join(codes, "distrito_id")
        .select(F.col("distrito_ine").alias("distrito_id"), "centroide", "geometria")
    )


def zone_parts(outlines: DataFrame, centroids: DataFrame) -> DataFrame:
    """Outline and centroid under the zone's own code."""
    return outlines.join(centroids, "distrito_id").select(
        F.col("distrito_id").alias("ID"),
        F.col("geometria").alias("geometry"),
        F.col("centroide").alias("centroid"),
    )


def recode_both_ends(trips: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace origin and destination through the same code map. A code with
    several targets multiplies the trip; a code without one drops it."""
    starts = mapping.select(F.col("distrito_mitma").alias("origin"), F.col("distrito_ine").alias("origin_id"))
    ends = mapping.select(
        F.col("distrito_mitma").alias("destination"), F.col("distrito_ine").alias("destination_id")
    )
    return trips.join(starts, "origin").join(ends, "destination").drop("origin", "destination")


def same_section_year(population: DataFrame, income: DataFrame) -> DataFrame:
    """Population and income of one section in one year."""

    def yearly(series: DataFrame, name: str) -> DataFrame:
        return series.select(
            F.col("codigo").alias("seccion_id"),
            F.year(timestamp_text_date(F.col("fecha"))).alias("year"),
            F.col("valor").alias(name),
        )

    return yearly(population, "poblacion_seccion").join(
        yearly(income, "renta_media_seccion"), ["seccion_id", "year"]
    )


def both_ends_in_zones(trips: DataFrame, zones: DataFrame, semi: bool = False) -> DataFrame:
    """Trips whose origin and destination are both listed.

    As an inner join a zone listed twice counts its trips twice; ``semi`` keeps
    each trip once.
    """
    how = "left_semi" if semi else "inner"
    starts = zones.select(F.col("distrito_id").alias("origin_id"))
    ends = zones.select(F.col("distrito_id").alias("destination_id"))
    return trips.join(starts, "origin_id", how).join(ends, "destination_id", how).select(*trips.columns)


def gravity_star(od: DataFrame, demographics: DataFrame, year: int) -> DataFrame:
    """OD totals with distance, plus population at the origin and total income
    at the destination, both of one year."""
    that_year = demographics.filter(F.col("year") == year)
    people = that_year.select(
        F.col("distrito_id").alias("origin_id"), F.col("poblacion").cast("double").alias("P_i")
    )
    money = that_year.select(
        F.col("distrito_id").alias("destination_id"), F.col("renta_total_euros").cast("double").alias("E_j")
    )
    return od.join(people, "origin_id").join(money, "destination_id")


def listed_distances(od: DataFrame, distances: DataFrame) -> DataFrame:
    """OD totals joined to a distance table on both ends."""
    return od.join(distances, ["origin_id", "destination_id"])


def with_calendar(patterns: DataFrame, calendar: DataFrame) -> DataFrame:
    """Day patterns with the holiday flag; days the calendar lacks keep NULL."""
    return patterns.join(calendar.select("date", "is_holiday"), "date", "left").select(
        "date", F.col("pattern_type").alias("cluster"), "is_holiday"
    )
