"""Conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.functions.scalars import flag
from corridor.operators import aggregates, filters, joins, pairs
from corridor.schemas import RELATION, SILVER_TRIPS
from corridor.session import settle


def calendar(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("fecha").cast("date").alias("date"),
        flag(F.col("es_festivo")).alias("is_holiday"),
        flag(F.col("es_fin_de_semana")).alias("is_weekend"),
    )


def relation(bronze: DataFrame) -> DataFrame:
    """The zone relation without rows that lack a code; only the urban-area code
    may be missing."""
    codes = RELATION.fieldNames()
    return filters.all_present(bronze.select(*codes), [code for code in codes if code != "gau_mitma"])


def district_map(relation_table: DataFrame) -> DataFrame:
    """Distinct (mobility district, statistical district) pairs, written once:
    its real size then decides whether the joins broadcast it."""
    return settle(filters.distinct_pairs(relation_table, "distrito_mitma", "distrito_ine"), "district_map")


def geometries(centroids: DataFrame, outlines: DataFrame, mapping: DataFrame) -> DataFrame:
    return joins.zone_geometries(centroids, outlines, mapping)


def demographics(population: DataFrame, income: DataFrame, relation_table: DataFrame) -> DataFrame:
    sections = filters.distinct_pairs(relation_table, "seccion_ine", "distrito_ine").select(
        F.col("seccion_ine").alias("seccion_id"), F.col("distrito_ine").alias("distrito_id")
    )
    yearly = joins.same_section_year(population, income)
    return aggregates.district_income(yearly.join(sections, "seccion_id"))


def trips(bronze: DataFrame, mapping: DataFrame) -> DataFrame:
    """Trips per day, hour, origin and destination under statistical codes.

    With the small code map broadcast, scan, both lookups and the partial sum
    are one stage, so a busy origin folds on the map side before the one shuffle.
    """
    mapped = joins.recode_both_ends(
        bronze.select("date", "period", "origin", "destination", "travels", "travels_km"), mapping
    )
    return aggregates.by_od_hour(mapped).select(*SILVER_TRIPS.fieldNames())


def trips_by_day(bronze: DataFrame, mapping: DataFrame, pieces: int) -> DataFrame:
    """The rows of ``trips``, each day in one or a few of ``pieces`` partitions, ready to be written by day.

    Landed rows are shuffled once, to ranges of day and hour; with the small code map broadcast, the
    lookups, which may multiply them, and the sum follow in the same stage. They do not fold on the map
    side: ``trips`` shuffles less where many landed rows share a group and nothing is written by day.
    """
    # the cast proper comes after the lookups: an hour that is none fails only where its zones are known
    hour = F.expr("try_cast(period AS INT)").alias("hour")
    landed = bronze.select("date", "period", "origin", "destination", "travels", "travels_km", hour)
    mapped = joins.recode_both_ends(landed.repartitionByRange(pieces, "date", "hour"), mapping)
    return aggregates.by_od_hour(mapped, "hour").select(*SILVER_TRIPS.fieldNames())


def od_totals(bronze: DataFrame, mapping: DataFrame) -> DataFrame:
    """OD sums under statistical codes straight from landed trips: the same
    numbers as summing ``trips`` again, with one shuffle instead of two."""
    mapped = joins.recode_both_ends(bronze.select("origin", "destination", "travels"), mapping)
    return aggregates.od_totals(mapped)


def distances(geometry_table: DataFrame) -> DataFrame:
    return pairs.pair_distances(geometry_table)
