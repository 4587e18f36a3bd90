"""Filters, joins, aggregates, windows, sorts, set operations and scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions import scalars as s
from corridor.operators import aggregates, filters, joins, pairs, ranking, setops
from corridor.plans import first_generation, gold, silver
from corridor.schemas import TRIP_FIELDS
from corridor.session import settle
from corridor.sources import geometry
from corridor.workload import tables as t
from corridor.workload.oracle_tables import statement
from corridor.workload.registry import query
from corridor.workload.source_queries import order_calendar


def silver_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.relation(t.relation(spark, sf_dir))


def district_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.district_map(silver_relation(spark, sf_dir))


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.trips(t.legs(spark, sf_dir), district_map(spark, sf_dir))


def busy_silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.trips(t.busy_legs(spark, sf_dir), district_map(spark, sf_dir))


def geometries(spark: SparkSession, sf_dir: str, mapping: DataFrame | None = None) -> DataFrame:
    """Zones under statistical codes, written once."""
    found = silver.geometries(
        geometry.centroids(t.centroid_table(spark, sf_dir)),
        geometry.outlines(t.outline_table(spark, sf_dir)),
        district_map(spark, sf_dir) if mapping is None else mapping,
    )
    return settle(found, "geometries")


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District statistics, written once."""
    found = silver.demographics(
        t.section_series(spark, sf_dir, "people"),
        t.section_series(spark, sf_dir, "income"),
        silver_relation(spark, sf_dir),
    )
    return settle(found, "demographics")


def two_places(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: s.rounded(F.col(name), 2) for name in names})


# --- filters -----------------------------------------------------------------


@query("filter_not_null_all", statement("SELECT * FROM silver_relation"))
def filter_not_null_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_relation(spark, sf_dir)


@query("filter_distinct_from", statement("SELECT * FROM relation WHERE gau_mitma IS DISTINCT FROM 'NA'"))
def filter_distinct_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.not_literally(t.relation(spark, sf_dir), "gau_mitma")


@query("filter_day", statement("SELECT * FROM legs WHERE date = DATE '1996-06-15'"))
def filter_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.on_day(t.legs(spark, sf_dir), "1996-06-15")


@query(
    "filter_date_range", statement("SELECT * FROM legs WHERE date BETWEEN DATE '1996-05-08' AND DATE '1996-05-14'")
)
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.between_days(t.legs(spark, sf_dir), "1996-05-08", "1996-05-14")


# the percent rank of a value: the number of smaller ones over the number of other rows
COUNTED = {
    "priced": """SELECT l_orderkey, l_linenumber, l_extendedprice,
        CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount END AS per_discount FROM lineitem""",
    "priced_counts": "SELECT per_discount, COUNT(*) AS n FROM priced GROUP BY per_discount",
    "priced_ranks": """SELECT per_discount, SUM(n) OVER (ORDER BY per_discount NULLS LAST) - n AS smaller,
        SUM(n) OVER () - 1 AS others FROM priced_counts""",
    "ranked_prices": """SELECT l_orderkey, l_linenumber, l_extendedprice, smaller, others
        FROM priced JOIN priced_ranks r ON priced.per_discount IS NOT DISTINCT FROM r.per_discount""",
}


def _discounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")


@query(
    "win_percent_rank",
    statement(
        "SELECT l_orderkey, l_linenumber, round(CAST(smaller AS DOUBLE) / CAST(others AS DOUBLE), 9) AS pr FROM ranked_prices",
        **COUNTED,
    ),
)
def win_percent_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    efficiency = s.ratio(F.col("l_extendedprice"), F.col("l_discount"))
    ranked = ranking.percent_rank(_discounted(spark, sf_dir), efficiency, "pr")
    return ranked.select("l_orderkey", "l_linenumber", s.rounded(F.col("pr"), 9).alias("pr"))


@query(
    "filter_percentile_band",
    statement(
        """SELECT l_orderkey, l_linenumber, l_extendedprice FROM ranked_prices
           WHERE 20 * smaller >= others AND 20 * smaller <= 19 * others""",
        **COUNTED,
    ),
)
def filter_percentile_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    efficiency = s.ratio(F.col("l_extendedprice"), F.col("l_discount"))
    return ranking.percent_rank_band(_discounted(spark, sf_dir), efficiency, 0.05, 0.95).drop("l_discount")


@query("distinct_mapping", statement("SELECT * FROM district_map"))
def distinct_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.distinct_pairs(silver_relation(spark, sf_dir), "distrito_mitma", "distrito_ine")


# --- joins -------------------------------------------------------------------


@query("join_geometry_mapping", statement("SELECT * FROM geometries"))
def join_geometry_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometries(spark, sf_dir).select("distrito_id", "centroide.x", "centroide.y", "geometria")


@query(
    "join_zone_parts",
    statement(
        'SELECT zone AS "ID", CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, geom AS geometry '
        "FROM zone_points JOIN outlines USING (zone)"
    ),
)
def join_zone_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = t.geometries(spark, sf_dir)
    found = joins.zone_parts(own.select("distrito_id", "geometria"), own.select("distrito_id", "centroide"))
    return found.select("ID", "centroid.x", "centroid.y", "geometry")


@query(
    "join_od_recode",
    statement(
        """SELECT date, period, origin_id, unnest(d_ids) AS destination_id, travels
           FROM (SELECT date, period, unnest(o_ids) AS origin_id, d_ids, travels
                 FROM legs JOIN recode_targets o(origin, o_ids) USING (origin)
                 JOIN recode_targets d(destination, d_ids) USING (destination))"""
    ),
)
def join_od_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = t.legs(spark, sf_dir).select("date", "period", "origin", "destination", "travels")
    return joins.recode_both_ends(trips, district_map(spark, sf_dir))


@query(
    "join_section_year",
    statement(
        """SELECT seccion AS seccion_id, year, CAST(people AS DOUBLE) AS poblacion_seccion,
             CAST(income AS DOUBLE) AS renta_media_seccion FROM section_years"""
    ),
)
def join_section_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.same_section_year(
        t.section_series(spark, sf_dir, "people"), t.section_series(spark, sf_dir, "income")
    )


# a metric, concave study area with a notch from the north
AREA = (
    "POLYGON((660000 4250000, 800000 4250000, 800000 4450000, 730000 4450000, 730000 4340000, "
    "715000 4340000, 715000 4450000, 660000 4450000, 660000 4250000))"
)
AREA_EDGES = """
    SELECT * FROM (VALUES
        (660000.0::DOUBLE, 4250000.0::DOUBLE, 800000.0::DOUBLE, 4250000.0::DOUBLE),
        (800000.0, 4250000.0, 800000.0, 4450000.0), (800000.0, 4450000.0, 730000.0, 4450000.0),
        (730000.0, 4450000.0, 730000.0, 4340000.0), (730000.0, 4340000.0, 715000.0, 4340000.0),
        (715000.0, 4340000.0, 715000.0, 4450000.0), (715000.0, 4450000.0, 660000.0, 4450000.0),
        (660000.0, 4450000.0, 660000.0, 4250000.0)) v(x1, y1, x2, y2)"""


def inside_sql(edges: str) -> dict[str, str]:
    """Tables ``edges`` and ``zones_inside`` (one row per zone row inside)."""
    listed = "SELECT row_number() OVER (ORDER BY distrito_id, x, y) AS rid, * FROM geometries"
    crossing = "(y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1"
    touching = (
        "(x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2) "
        "AND y BETWEEN least(y1, y2) AND greatest(y1, y2)"
    )
    return {
        "edges": edges,
        "listed_zones": listed,
        "zones_inside": f"""
            SELECT ANY_VALUE(distrito_id) AS distrito_id FROM listed_zones, edges GROUP BY rid
            HAVING SUM(CASE WHEN {crossing} THEN 1 ELSE 0 END) % 2 = 1 AND NOT bool_or({touching})""",
    }


@query("st_within_polygon", statement("SELECT distrito_id FROM zones_inside", **inside_sql(AREA_EDGES)))
def st_within_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.zones_in_area(spark, geometries(spark, sf_dir), AREA, geographic=False)


# a trip is repeated for every pair of zone rows its ends have
IN_ZONE = """
    SELECT date, period, origin_id, destination_id, travels
    FROM (SELECT silver_trips.*, unnest(range(a.n * b.n)) AS copy_no
          FROM silver_trips, (SELECT distrito_id, COUNT(*) AS n FROM {zones} GROUP BY 1) a,
            (SELECT distrito_id, COUNT(*) AS n FROM {zones} GROUP BY 1) b
          WHERE origin_id = a.distrito_id AND destination_id = b.distrito_id)"""


@query("join_both_ends_in_zone", statement(IN_ZONE.format(zones="zones_inside"), **inside_sql(AREA_EDGES)))
def join_both_ends_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trips_in_region(silver_trips(spark, sf_dir), geometries(spark, sf_dir), AREA, geographic=False)


@query(
    "join_semi_in_zone",
    statement(
        IN_ZONE.format(zones="(SELECT DISTINCT distrito_id FROM zones_inside)"), **inside_sql(AREA_EDGES)
    ),
)
def join_semi_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trips_in_region(
        silver_trips(spark, sf_dir), geometries(spark, sf_dir), AREA, geographic=False, semi=True
    )


STAR = """
    SELECT origin_id, destination_id, actual_trips, round(metres, 4) AS distance_meters,
        people AS "P_i", euros AS "E_j" FROM measured_od"""


@query("join_gravity_star", statement(STAR))
def join_gravity_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that occur, measured from both centroids."""
    od = aggregates.od_totals(silver_trips(spark, sf_dir))
    measured = pairs.with_distances(od, geometries(spark, sf_dir))
    star = joins.gravity_star(measured, demographics(spark, sf_dir), 1996)
    return star.withColumn("distance_meters", s.rounded(F.col("distance_meters"), 4))


@query(
    "join_theta_pairs",
    statement(
        """SELECT a.distrito_id AS a_distrito_id, b.distrito_id AS b_distrito_id
           FROM own_zones a JOIN own_zones b ON a.distrito_id < b.distrito_id"""
    ),
)
def join_theta_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = settle(t.geometries(spark, sf_dir).select("distrito_id"), "zones")
    return pairs.unordered_pairs(zones, "distrito_id", [])


FIXED_PATTERNS = """
    SELECT date, CAST(CASE WHEN COUNT(*) % 2 = 0 THEN 0 ELSE 1 END AS INTEGER) AS pattern_type
    FROM (SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem) GROUP BY date"""


def fixed_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a label that needs no clustering: the parity of a day's rows."""
    return t.legs(spark, sf_dir).groupBy("date").agg((F.count("*") % 2).cast("int").alias("pattern_type"))


CALENDAR_JOIN = statement(
    """SELECT p.date, pattern_type AS cluster, es_festivo = 1 AS is_holiday
       FROM patterns p LEFT JOIN calendar c ON p.date = c.fecha""",
    patterns=FIXED_PATTERNS,
)


@query("join_left_calendar", CALENDAR_JOIN)
def join_left_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.with_calendar(fixed_patterns(spark, sf_dir), silver.calendar(order_calendar(spark, sf_dir)))


@query(
    "scalar_subquery",
    """SELECT o_orderkey, round(o_totalprice / (SELECT MAX(o_totalprice) FROM orders), 6) AS share FROM orders""",
)
def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.load(spark, sf_dir, "orders")
    largest = orders.agg(F.max("o_totalprice")).scalar()
    return orders.select("o_orderkey", s.rounded(s.ratio(F.col("o_totalprice"), largest), 6).alias("share"))


# --- aggregates --------------------------------------------------------------

THIRTEEN = "date, period, origin, destination, distance, activity_origin, activity_destination, " \
    "study_origin_posible, study_destination_posible, residence, rent, age, gender"


@query(
    "agg_trips_13dim", statement(f"SELECT {THIRTEEN}, travels, round(travels_km, 2) AS travels_km FROM busy_bronze")
)
def agg_trips_13dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_places(aggregates.by_all_dimensions(t.raw_trips(spark, sf_dir, busy=True)), "travels_km")


@query(
    "agg_od_hour",
    statement(
        "SELECT date, period, origin_id, destination_id, travels, round(travels_km, 2) AS travels_km FROM busy_silver"
    ),
)
def agg_od_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_places(busy_silver_trips(spark, sf_dir), "travels_km")


@query(
    "agg_od_hour_raw",
    statement(
        """SELECT date, CAST(period AS INTEGER) AS period, origin AS origin_id, destination AS destination_id,
             SUM(travels) AS travels, round(SUM(travels_km), 2) AS travels_km
           FROM (SELECT * REPLACE (CASE WHEN activity_origin = 'A' THEN ltrim(period, '0') || CASE WHEN period = '00' THEN '0' ELSE '' END
                                   ELSE period END AS period) FROM busy_legs) shown
           GROUP BY date, shown.period, origin, destination"""
    ),
)
def agg_od_hour_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows write the hour without its leading zero: they stay apart."""
    bare = F.col("periodo").cast("int").cast("string")
    mixed = t.raw_trips(spark, sf_dir, busy=True).withColumn(
        "periodo", F.when(F.col("actividad_origen") == "A", bare).otherwise(F.col("periodo"))
    )
    return two_places(aggregates.by_od_hour_raw(filters.renamed(mixed, TRIP_FIELDS)), "travels_km")


@query("agg_od_total", statement("SELECT * FROM od"))
def agg_od_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.od_totals(silver_trips(spark, sf_dir))


WEEKS = ("1995-01-01", "2001-12-31")
PARTIALS = f"""
    SELECT CAST(floor((date - DATE '{WEEKS[0]}') / 7) AS BIGINT) AS batch, origin_id, destination_id,
        CAST(SUM(travels * 0.5::DOUBLE) AS BIGINT) AS partial_trips
    FROM busy_silver WHERE date BETWEEN DATE '{WEEKS[0]}' AND DATE '{WEEKS[1]}' GROUP BY 1, 2, 3"""


def halved_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half trips, so that partial sums end in .5 and the rounding shows."""
    trips = busy_silver_trips(spark, sf_dir).withColumn("travels", F.col("travels") * 0.5)
    return aggregates.weekly_partials(trips, *WEEKS)


@query("agg_weekly_partial", statement(PARTIALS))
def agg_weekly_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return halved_partials(spark, sf_dir)


@query(
    "agg_partial_final",
    statement(
        """SELECT origin_id, destination_id, CAST(SUM(partial_trips) AS BIGINT) AS actual_trips
           FROM partials GROUP BY 1, 2""",
        partials=PARTIALS,
    ),
)
def agg_partial_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.from_partials(halved_partials(spark, sf_dir))


@query("agg_weighted_mean", statement("SELECT * FROM demographics"))
def agg_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.demographics(
        t.section_series(spark, sf_dir, "people"),
        t.section_series(spark, sf_dir, "income"),
        silver_relation(spark, sf_dir),
    )


@query("agg_ratio_of_sums", "SELECT round(SUM(l_extendedprice) / SUM(l_quantity), 6) AS k_factor FROM lineitem")
def agg_ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = t.load(spark, sf_dir, "lineitem")
    found = aggregates.ratio_of_sums(items, "l_extendedprice", "l_quantity", "k_factor")
    return found.select(s.rounded(F.col("k_factor"), 6).alias("k_factor"))


# days since a Monday
DAY_TYPE = "if(datediff('day', DATE '1900-01-01', CAST({} AS DATE)) % 7 >= 5, 'Weekend', 'Weekday')"


def by_type_sql(extra: str) -> str:
    return f"""SELECT period, {DAY_TYPE.format('date')} AS day_type, SUM(travels) AS total_trips{extra}
        FROM silver_trips GROUP BY ALL ORDER BY day_type, period"""


@query("agg_daytype_period", statement(by_type_sql("")))
def agg_daytype_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.by_day_type(silver_trips(spark, sf_dir)).orderBy("day_type", "period")


@query("agg_approx_median")
def agg_approx_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_generation.mobility_patterns(silver_trips(spark, sf_dir))


@query(
    "agg_median_sketches",
    statement(
        f"""SELECT period, {DAY_TYPE.format('date')} AS day_type, SUM(travels) AS total_trips,
              COUNT(travels) AS n, true AS within_bound FROM silver_trips GROUP BY ALL"""
    ),
)
def agg_median_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians merged from a stored table of daily sketches, held against exact ranks."""
    trips = settle(silver_trips(spark, sf_dir).select("date", "period", "travels"), "trips")
    states = settle(aggregates.median_states(trips), "median_states")
    medians = settle(aggregates.medians_from_states(states), "medians")
    found = aggregates.median_rank_errors(trips, medians)
    within = F.col("rank_error") <= aggregates.MOST_RANK_ERROR
    return found.select("period", "day_type", "total_trips", "n", within.alias("within_bound"))


@query(
    "agg_exact_median",
    """SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.5) AS median_price
       FROM lineitem GROUP BY 1, 2""",
)
def agg_exact_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = t.load(spark, sf_dir, "lineitem")
    return aggregates.exact_median(items, ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price")


@query("agg_max_reduce", statement("SELECT distrito_id, MAX(renta_total_euros) AS most FROM demographics GROUP BY 1"))
def agg_max_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demographics(spark, sf_dir).groupBy("distrito_id").agg(F.max("renta_total_euros").alias("most"))


@query("agg_count_all", "SELECT COUNT(*) AS n FROM lineitem")
def agg_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query(
    "agg_value_counts",
    statement("SELECT pattern_type, COUNT(*) AS count FROM patterns GROUP BY 1", patterns=FIXED_PATTERNS),
)
def agg_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.value_counts(fixed_patterns(spark, sf_dir), "pattern_type")


@query(
    "agg_hour_and_total",
    statement(
        """SELECT date, period AS hour, SUM(travels) AS hour_trips,
             SUM(SUM(travels)) OVER (PARTITION BY date) AS day_total FROM silver_trips GROUP BY 1, 2"""
    ),
)
def agg_hour_and_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.hour_and_day_totals(silver_trips(spark, sf_dir))


@query("win_sum_over_agg", statement(
    """SELECT date, hour, CAST(SUM(value) AS DOUBLE) AS hour_trips,
         CAST(SUM(SUM(value)) OVER (PARTITION BY date) AS DOUBLE) AS day_total FROM activity GROUP BY 1, 2"""
))
def win_sum_over_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = t.activity(spark, sf_dir).select("date", F.col("hour").alias("period"), F.col("value").alias("travels"))
    totals = aggregates.hour_and_day_totals(hourly)
    return totals.withColumns({n: F.col(n).cast("double") for n in ("hour_trips", "day_total")})


@query("share_of_total", statement("SELECT * FROM daily_shares"))
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.hour_shares(aggregates.hour_and_day_totals(silver_trips(spark, sf_dir)))


@query(
    "pivot_hours",
    statement(
        "SELECT date, "
        + ", ".join(f'COALESCE(CAST(SUM(value) FILTER (hour = {h}) AS DOUBLE), 0.0) AS "{h}"' for h in range(24))
        + " FROM activity GROUP BY date"
    ),
)
def pivot_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = t.activity(spark, sf_dir).groupBy("date", "hour").agg(F.sum("value").cast("double").alias("value"))
    return aggregates.pivot_hours(hourly, "value")


# --- sorts and set operations ------------------------------------------------

PAIR_DISTANCE = """
    SELECT a.distrito_id AS origin_id, b.distrito_id AS destination_id,
        sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS distance_meters
    FROM own_zones a JOIN own_zones b ON a.distrito_id {test} b.distrito_id"""


@query("sort_by_date", statement("SELECT * FROM daily_profile ORDER BY date"))
def sort_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_profile(silver_trips(spark, sf_dir)).orderBy("date")


@query(
    "union_all_mirror",
    statement(
        "SELECT origin_id, destination_id, round(distance_meters, 4) AS distance_meters "
        f"FROM ({PAIR_DISTANCE.format(test='<>')})"
    ),
)
def union_all_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = settle(t.geometries(spark, sf_dir), "zones")
    half = pairs.pair_distances(zones, mirror=False)
    both = setops.mirrored(half, "origin_id", "destination_id")
    return both.withColumn("distance_meters", s.rounded(F.col("distance_meters"), 4))


@query(
    "except_distinct",
    statement("SELECT date, origin, gender FROM legs WHERE study_origin_posible = 'si' EXCEPT "
              "SELECT date, origin, gender FROM legs WHERE study_origin_posible = 'no'"),
)
def except_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is on one side: what only trips from a study zone have; a missing gender equals itself."""
    trips = t.legs(spark, sf_dir)
    sides = [trips.filter(F.col("study_origin_posible") == side).select("date", "origin", "gender") for side in ("si", "no")]
    return setops.except_distinct(*sides)


# --- scalar functions --------------------------------------------------------


@query(
    "fn_parse_compact_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS lenient,
         CAST(o_orderdate AS DATE) AS strict FROM orders""",
)
def fn_parse_compact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyyMMdd")
    broken = F.when(F.col("o_orderstatus") == "P", F.concat(F.substring(text, 1, 4), F.lit("0132"))).otherwise(text)
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        s.compact_date(broken, lenient=True).alias("lenient"),
        s.compact_date(text).alias("strict"),
    )


@query(
    "fn_parse_iso_date",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS plain, CAST(o_orderdate AS DATE) AS stamped FROM orders",
)
def fn_parse_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        s.iso_date(text).alias("plain"),
        s.timestamp_text_date(F.concat(text, F.lit("T00:00:00.000+01:00"))).alias("stamped"),
    )


@query(
    "fn_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS dow, isodow(o_orderdate) > 5 AS weekend FROM orders""",
)
def fn_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        s.weekday_from_sunday(day).alias("dow"),
        s.is_weekend(day).alias("weekend"),
    )


@query(
    "fn_date_arith",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS next_day,
         CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS days_in,
         least(CAST(o_orderdate AS DATE) + 6, DATE '2001-08-01') AS batch_end FROM orders""",
)
def fn_date_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_add(day, 1).alias("next_day"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days_in"),
        F.least(F.date_add(day, 6), F.lit("2001-08-01").cast("date")).alias("batch_end"),
    )


@query(
    "fn_try_cast",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS number FROM orders""",
)
def fn_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "..").otherwise(F.col("o_totalprice").cast("string"))
    return t.load(spark, sf_dir, "orders").select("o_orderkey", s.number_or_null(text).alias("number"))


@query(
    "fn_cast_round_int",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity * 0.5::DOUBLE AS INTEGER) AS half,
         CAST(-l_quantity * 0.5::DOUBLE AS INTEGER) AS minus_half, CAST(l_extendedprice AS INTEGER) AS whole
       FROM lineitem""",
)
def fn_cast_round_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        s.rounded_int(F.col("l_quantity") * 0.5).alias("half"),
        s.rounded_int(-F.col("l_quantity") * 0.5).alias("minus_half"),
        s.rounded_int(F.col("l_extendedprice")).alias("whole"),
    )


@query(
    "fn_cast_bool",
    """SELECT doc_id, quality = 1 AS from_int, quality = 1 AS from_text, toxic = 1 AS is_one FROM labels""",
)
def fn_cast_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "labels").select(
        "doc_id",
        s.flag(F.col("quality")).alias("from_int"),
        s.flag(F.col("quality").cast("string")).alias("from_text"),
        s.flag_is_one(F.col("toxic").cast("string")).alias("is_one"),
    )


@query(
    "fn_safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS ratio FROM lineitem",
)
def fn_safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", s.ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio")
    )


@query(
    "fn_floor_clamp",
    """SELECT c_custkey, GREATEST(v, 500.0) AS floored, CASE WHEN v < 0.1 THEN 0.1 ELSE v END AS raised
       FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS v FROM customer)""",
)
def fn_floor_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_acctbal"))
    return t.load(spark, sf_dir, "customer").select(
        "c_custkey", s.at_least(value, 500.0).alias("floored"), s.raised_to(value, 0.1).alias("raised")
    )


@query("fn_power", """SELECT p_partkey, round(POWER(p_retailprice, 2), 4) AS squared, round(p_retailprice ** 2, 4) AS caret FROM part""")
def fn_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    return t.load(spark, sf_dir, "part").select(
        "p_partkey",
        s.rounded(F.pow(price, F.lit(2.0)), 4).alias("squared"),
        s.rounded(F.pow(price, F.lit(2.0)), 4).alias("caret"),
    )


@query(
    "fn_round",
    """SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice * l_discount, 2) AS two,
         ROUND(l_extendedprice / l_quantity, 4) AS four, ROUND(-l_extendedprice * (l_tax + 1), 2) AS minus FROM lineitem""",
)
def fn_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        s.rounded(price * F.col("l_discount"), 2).alias("two"),
        s.rounded(s.ratio(price, F.col("l_quantity")), 4).alias("four"),
        s.rounded(-price * (F.col("l_tax") + 1), 2).alias("minus"),
    )


@query(
    "fn_coalesce",
    """SELECT c_custkey, COALESCE(CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice * 100)::BIGINT END) AS DOUBLE), 0.0) AS cents
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side of the join is one row per customer: the orders fold first."""
    cents = F.when(F.col("o_orderstatus") == "P", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    sums = t.load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(cents).alias("c"))
    customers = t.load(spark, sf_dir, "customer").select("c_custkey")
    return customers.join(sums, "c_custkey", "left").select(
        "c_custkey", F.coalesce(F.col("c").cast("double"), F.lit(0.0)).alias("cents")
    )


@query(
    "fn_case_label",
    f"SELECT o_orderkey, {DAY_TYPE.format('o_orderdate')} AS day_type FROM orders",
)
def fn_case_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey", s.day_type(F.col("o_orderdate").cast("date")).alias("day_type")
    )


@query(
    "fn_regex_title",
    """SELECT page_id, regexp_matches(url, '/(fr|de)/') AS in_pattern, contains(url, 'page=') AS has_marker FROM pages""",
)
def fn_regex_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "pages").select(
        "page_id", F.col("url").rlike("/(fr|de)/").alias("in_pattern"), F.col("url").contains("page=").alias("has_marker")
    )


@query(
    "fn_struct_list_access",
    "SELECT vec_id, embedding[1] AS first_item, embedding[64] AS last_item, embedding[65] AS beyond FROM embeddings",
)
def fn_struct_list_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.col("embedding")
    return t.load(spark, sf_dir, "embeddings").select(
        "vec_id",
        s.item(values, 1).alias("first_item"),
        s.item(values, 64).alias("last_item"),
        s.item(values, 65).alias("beyond"),
    )
