"""Products: gravity model, gap report, daily profiles, day patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions.scalars import at_least, ratio, rounded, rounded_int
from corridor.functions.spatial import study_area, within_area
from corridor.operators import aggregates, clustering, filters, joins, pairs, ranking
from corridor.schemas import DAILY_PROFILE, HOUR_COLUMNS
from corridor.session import settle

# The default study area (latitude first), shortest distance in
# metres, and the share of pairs the calibration trims at each end.
STUDY_AREA = "POLYGON((40.9 -1.7, 40.9 0.9, 37.8 0.9, 37.8 -1.7, 40.9 -1.7))"
SHORTEST_METRES = 500.0
BAND = (0.05, 0.95)


def zones_in_area(
    spark: SparkSession, geometries: DataFrame, wkt_text: str = STUDY_AREA, geographic: bool = True
) -> DataFrame:
    """(distrito_id) of the zones whose centroid lies strictly inside."""
    area = study_area(spark, wkt_text, geographic)
    inside = within_area(F.col("centroide.x"), F.col("centroide.y"), area)
    return geometries.filter(inside).select("distrito_id")


def trips_in_region(
    trips: DataFrame, geometries: DataFrame, wkt_text: str = STUDY_AREA, geographic: bool = True, semi: bool = False
) -> DataFrame:
    zones = settle(zones_in_area(trips.sparkSession, geometries, wkt_text, geographic), "zones_in_area")
    kept = joins.both_ends_in_zones(trips, zones, semi)
    return kept.select("date", "period", "origin_id", "destination_id", "travels")


def _gravity(measured: DataFrame, demographics: DataFrame, year: int) -> DataFrame:
    star = joins.gravity_star(measured, demographics, year)
    metres = at_least(F.col("distance_meters"), SHORTEST_METRES)
    pull = F.col("P_i") * F.col("E_j") / F.pow(metres, F.lit(2.0))
    return star.select(
        "origin_id",
        "destination_id",
        "actual_trips",
        metres.alias("dist_meters"),
        "P_i",
        "E_j",
        pull.alias("gravity_raw"),
    )


def gravity_features(
    od: DataFrame,
    demographics: DataFrame,
    year: int,
    distances: DataFrame | None = None,
    geometries: DataFrame | None = None,
) -> DataFrame:
    """Gravity inputs of each OD pair.

    Distances come from a distance table, or straight from the zone centroids:
    then only the pairs that occur are measured and no table of all zone pairs
    is needed. Both give the same rows.
    """
    if (distances is None) == (geometries is None):
        raise ValueError("give either distances or geometries")
    measured = (
        joins.listed_distances(od, distances) if distances is not None else pairs.with_distances(od, geometries)
    )
    return _gravity(measured, demographics, year)


def infrastructure_gaps(features: DataFrame) -> DataFrame:
    """Trips against calibrated demand, for the pairs inside the trimmed band.

    ``features`` is read several times: it is written once first.
    """
    settled = settle(features, "gravity_features")
    efficiency = ratio(F.col("actual_trips"), F.col("gravity_raw"))
    kept = ranking.percent_rank_band(settled, efficiency, *BAND)
    factor = aggregates.ratio_of_sums(kept, "actual_trips", "gravity_raw", "k_factor").scalar()
    # a column of its own: the factor is then computed once, not per use
    expected = kept.withColumn("demand", factor * F.col("gravity_raw"))
    return expected.select(
        "origin_id",
        "destination_id",
        "actual_trips",
        rounded_int(F.col("dist_meters")).alias("distance_meters"),
        rounded_int(F.col("demand")).alias("potential_demand"),
        rounded(ratio(F.col("actual_trips"), F.col("demand")), 4).alias("gap_ratio"),
    )


def worst_first(gaps: DataFrame) -> DataFrame:
    """The report in order: smallest ratio first, unknown ratios last."""
    return gaps.orderBy(F.col("gap_ratio").asc_nulls_last())


def worst_served(gaps: DataFrame, n: int) -> DataFrame:
    """The n worst-served pairs; ties fall by origin and destination."""
    return gaps.orderBy(F.col("gap_ratio").asc_nulls_last(), "origin_id", "destination_id").limit(n)


def daily_profile(trips: DataFrame) -> DataFrame:
    """Each day's 24 hour shares, for every day at once."""
    shares = aggregates.hour_shares(aggregates.hour_and_day_totals(trips))
    return aggregates.pivot_hours(shares, "share").select(*DAILY_PROFILE.fieldNames())


def date_patterns(profile: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """(date, pattern_type): days clustered by their hour shares."""
    if start is not None:
        profile = profile.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        profile = profile.filter(F.col("date") <= F.lit(end).cast("date"))
    days = settle(profile.na.fill(0.0, HOUR_COLUMNS), "daily_profile")
    _, _, labelled = clustering.choose_k(days, HOUR_COLUMNS)
    return clustering.pattern_table(labelled)
