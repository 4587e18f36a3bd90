"""The older variants whose results differ from the current products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.functions.scalars import flag_is_one, iso_date, raised_to, ratio, timestamp_text_date
from corridor.functions.spatial import spheroid_distance
from corridor.operators import aggregates, filters
from corridor.operators.pairs import pair_distances

# Fixed value: the shortest distance in metres.
SHORTEST_METRES = 0.1


def calendar(bronze: DataFrame) -> DataFrame:
    """From text dates and text flags."""
    return bronze.select(
        iso_date(F.col("fecha")).alias("date"),
        flag_is_one(F.col("es_festivo")).alias("is_holiday"),
        flag_is_one(F.col("es_fin_de_semana")).alias("is_weekend"),
    )


def population(sections: DataFrame) -> DataFrame:
    """(ID, population, year) where year is the full date."""
    return sections.select(
        F.col("seccion").alias("ID"),
        F.rint(F.col("total").cast("double")).cast("int").alias("population"),
        timestamp_text_date(F.col("fecha")).alias("year"),
    )


def income(sections: DataFrame) -> DataFrame:
    """(ID, year, gdp_euros)."""
    return sections.select(
        F.col("seccion").alias("ID"),
        F.year(timestamp_text_date(F.col("fecha"))).alias("year"),
        F.col("total").cast("double").alias("gdp_euros"),
    )


def distances(geographic_zones: DataFrame) -> DataFrame:
    """Geodesic distances of the pairs with a < b only."""
    half = pair_distances(geographic_zones, distance=spheroid_distance, mirror=False)
    return filters.renamed(
        half, {"origin_id": "zone_a_id", "destination_id": "zone_b_id", "distance_meters": "distance_meters"}
    )


def model_inputs(
    trips: DataFrame,
    zones: DataFrame,
    people: DataFrame,
    money: DataFrame,
    half_distances: DataFrame,
    start: str,
    end: str,
) -> DataFrame:
    """OD sums, distance, largest population and largest income.

    The joins have no year key, so a trip counts once for every population row
    of its origin times every income row of its destination, times the zone
    rows. Each dimension folds to (zone, rows, largest value) and each pair to
    one sum first; the multiplied counts then scale the sum, which gives the
    same numbers without carrying the multiplied rows through a shuffle.
    """
    od = filters.between_days(trips, start, end).groupBy("origin_id", "destination_id").agg(
        F.sum("travels").alias("travels")
    )
    listed = zones.groupBy("ID").agg(F.count("*").alias("zone_rows"))

    def folded(table: DataFrame, end_id: str, value: str, name: str) -> DataFrame:
        rows = table.groupBy("ID").agg(F.count("*").alias("rows"), F.max(value).alias(name))
        return rows.join(listed, "ID").select(
            F.col("ID").alias(end_id), (F.col("rows") * F.col("zone_rows")).alias(f"{end_id}_rows"), name
        )

    # one pair may be listed at several distances, or several times at one
    apart = half_distances.groupBy(
        F.col("zone_a_id").alias("origin_id"), F.col("zone_b_id").alias("destination_id"), "distance_meters"
    ).agg(F.count("*").alias("pair_rows"))
    met = (
        od.join(apart, ["origin_id", "destination_id"])
        .join(folded(people, "origin_id", "population", "P_i"), "origin_id")
        .join(folded(money, "destination_id", "gdp_euros", "E_j"), "destination_id")
    )
    times = F.col("origin_id_rows") * F.col("destination_id_rows") * F.col("pair_rows")
    return met.select(
        "origin_id",
        "destination_id",
        (F.col("travels") * times).alias("actual_trips"),
        "distance_meters",
        "P_i",
        "E_j",
    )


def infrastructure_gaps(inputs: DataFrame) -> DataFrame:
    """Untrimmed calibration; all pairs are reported, ratios unrounded."""
    metres = raised_to(F.col("distance_meters"), SHORTEST_METRES)
    weight: Column = F.col("P_i") * F.col("E_j")
    squared = F.pow(metres, F.lit(2.0))
    pulled = inputs.withColumn("gravity_raw", weight / squared)
    factor = aggregates.ratio_of_sums(pulled, "actual_trips", "gravity_raw", "factor").scalar()
    expected = inputs.withColumn("potential_demand", factor * weight / squared)
    return expected.select(
        "origin_id",
        "destination_id",
        "actual_trips",
        "potential_demand",
        ratio(F.col("actual_trips"), F.col("potential_demand")).alias("gap_ratio"),
    )


def mobility_patterns(trips: DataFrame, exact: bool = False) -> DataFrame:
    """Hourly totals and median trips for weekdays and weekends, in order.

    The median is a sketch's; ``exact`` gives the interpolated one instead.
    """
    if not exact:
        found = aggregates.by_day_type(trips, aggregates.approx_median("travels").alias("median_trips_per_hour"))
    else:
        named = trips.select("period", aggregates.day_type(F.col("date")).alias("day_type"), "travels")
        middle = aggregates.exact_median(named, ["period", "day_type"], "travels", "median_trips_per_hour")
        found = aggregates.by_day_type(trips).join(middle, ["period", "day_type"])
    return found.orderBy("day_type", "period")
