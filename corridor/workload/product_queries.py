"""Spatial operators, clustering and the end-to-end products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions import scalars as s
from corridor.functions import spatial
from corridor.operators import aggregates, clustering, filters, joins, pairs, spatial_joins
from corridor.plans import first_generation, gold, silver
from corridor.schemas import HOUR_COLUMNS
from corridor.session import settle
from corridor.sources.calendar import special_days
from corridor.workload import tables as t
from corridor.workload.oracle_tables import gravity, measured, statement
from corridor.workload.registry import query
from corridor.workload.relational_queries import (
    CALENDAR_JOIN,
    FIXED_PATTERNS,
    IN_ZONE,
    PAIR_DISTANCE,
    PARTIALS,
    by_type_sql,
    demographics,
    district_map,
    fixed_patterns,
    geometries,
    halved_partials,
    inside_sql,
    silver_relation,
    silver_trips,
    two_places,
)
from corridor.workload.source_queries import order_calendar

YEAR = 1996


def places(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: s.rounded(F.col(name), digits) for name in names})


# --- spatial -----------------------------------------------------------------


def chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trip's two end points: lookups of origin and destination."""
    zones = settle(t.geometries(spark, sf_dir), "zones")
    od = t.legs(spark, sf_dir).groupBy(
        F.col("origin").alias("origin_id"), F.col("destination").alias("destination_id")
    ).agg(F.count("*").alias("trips"))
    return pairs.with_distances(od, zones)


CORNERS = """
    SELECT zone, x, y, half, dx * half AS ax, dy * half AS ay, ex * half AS bx, ey * half AS by_
    FROM zone_points, (VALUES (900), (300)) h(half),
        (VALUES (-1, -1, 1, -1), (1, -1, 1, 1), (1, 1, -1, 1), (-1, 1, -1, -1)) s(dx, dy, ex, ey)"""


@query(
    "join_points_in_polygons",
    statement(
        """SELECT vec_id, zone AS polygon_id
           FROM vector_points p JOIN (SELECT zone, x, y, ax, ay, bx, by_ FROM outline_edges) e
             ON abs(p.x - e.x) <= 900 AND abs(p.y - e.y) <= 900
           GROUP BY vec_id, zone
           HAVING SUM(CASE WHEN (e.y + ay > p.y) <> (e.y + by_ > p.y)
                           AND p.x < e.x + ax + (bx - ax) * (p.y - e.y - ay) / CAST(by_ - ay AS DOUBLE) THEN 1 ELSE 0 END) % 2 = 1
             AND NOT bool_or((bx - ax) * (p.y - e.y - ay) = (by_ - ay) * (p.x - e.x - ax)
                             AND p.x - e.x BETWEEN least(ax, bx) AND greatest(ax, bx)
                             AND p.y - e.y BETWEEN least(ay, by_) AND greatest(ay, by_))""",
        outline_edges=CORNERS,
    ),
)
def join_points_in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's point with every zone outline, a square with a square hole, that it lies inside."""
    found = spatial_joins.points_in_polygons(t.vector_points(spark, sf_dir), t.outline_table(spark, sf_dir), "ID", "geom")
    return found.select("vec_id", "polygon_id")


NEAR = 5000


@query(
    "join_points_within",
    statement(
        f"""SELECT a.vec_id AS a_vec_id, b.vec_id AS b_vec_id,
              round(sqrt(CAST((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS DOUBLE)), 4) AS distance_meters
           FROM vector_points a JOIN vector_points b
             ON a.vec_id < b.vec_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {NEAR * NEAR}"""
    ),
)
def join_points_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = spatial_joins.pairs_within(t.vector_points(spark, sf_dir), "vec_id", float(NEAR))
    return places(near, 4, "distance_meters")


@query(
    "st_distance_planar",
    statement(
        """SELECT origin AS origin_id, destination AS destination_id, COUNT(*) AS trips,
             round(ANY_VALUE(distance_meters), 4) AS distance_meters
           FROM legs JOIN apart ON origin = origin_id AND destination = destination_id GROUP BY 1, 2""",
        apart=PAIR_DISTANCE.format(test="<>"),
    ),
)
def st_distance_planar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the zone pairs that occur in trips."""
    return places(chained(spark, sf_dir), 4, "distance_meters")


DEGREES = """
    SELECT zone AS distrito_id, -3.0::DOUBLE + (x - 726000) / 30000.0::DOUBLE AS lon,
        40.0::DOUBLE + (y - 4350000) / 40000.0::DOUBLE AS lat FROM zone_points"""


def in_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones with made-up longitudes (x) and latitudes (y)."""
    lon = (F.col("x") - 726000) / 30000.0 - 3.0
    lat = (F.col("y") - 4350000) / 40000.0 + 40.0
    return settle(
        t.zone_points(spark, sf_dir).select(
            F.col("zone").alias("distrito_id"), F.struct(lon.alias("x"), lat.alias("y")).alias("centroide")
        ),
        "degrees",
    )


@query(
    "st_distance_haversine",
    statement(
        """SELECT a.distrito_id AS origin_id, b.distrito_id AS destination_id,
             round(2 * 6371008.8::DOUBLE * asin(sqrt(power(sin(radians(b.lat - a.lat) / 2), 2)
               + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2))), 3)
               AS distance_meters
           FROM degrees a JOIN degrees b ON a.distrito_id < b.distrito_id""",
        degrees=DEGREES,
    ),
)
def st_distance_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = pairs.pair_distances(in_degrees(spark, sf_dir), distance=spatial.haversine_distance, mirror=False)
    return places(half, 3, "distance_meters")


def _meridian_sql(term: str, n: int) -> str:
    """The sum over 0 to n of a weight times the meridian's radius over the axis at some latitude."""
    e2 = "(1 / 298.257223563::DOUBLE * (2 - 1 / 298.257223563::DOUBLE))"
    weight, latitude = term.split("|")
    return f"""list_sum(list_transform(range({n + 1}), lambda i:
        ({weight}) * (1 - {e2}) / power(1 - {e2} * power(sin({latitude}), 2), 1.5::DOUBLE)))"""


@query(
    "st_distance_antipodal",
    statement(
        f"""SELECT vec_id, round(6378137.0::DOUBLE * (
              {_meridian_sql("CASE WHEN i IN (0, 64) THEN 0.5 ELSE 1.0 END::DOUBLE|i * pi() / 128", 64)} * pi() / 64
              - abs(off) / 96 * {_meridian_sql("CASE WHEN i IN (0, 32) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END::DOUBLE|lat - off * i / 32", 32)}
            ), 2) AS distance_meters
            FROM (SELECT vec_id, radians(((y % 160001) + 160001) % 160001 / 2000.0::DOUBLE - 40) AS lat,
                    radians((vec_id % 7 - 3)::DOUBLE) AS off FROM vector_points)"""
    ),
)
def st_distance_antipodal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From every vector's point to one on the opposite meridian, up to three degrees from its antipode."""
    lon, lat = F.expr("pmod(x, 360001) / 1000.0D - 180"), F.expr("pmod(y, 160001) / 2000.0D - 40")
    points = t.vector_points(spark, sf_dir).select("vec_id", lon.alias("lon"), lat.alias("lat"))
    over = F.when(F.col("lon") > 0, F.col("lon") - 180).otherwise(F.col("lon") + 180)
    beyond = F.pmod("vec_id", F.lit(7)) - 3 - F.col("lat")
    apart = spatial.spheroid_distance(F.col("lon"), F.col("lat"), over, beyond)
    return places(points.select("vec_id", apart.alias("distance_meters")), 2, "distance_meters")


def _vincenty_sql() -> dict[str, str]:
    """The ellipsoid series unrolled: eight rounds are ample at these distances."""
    f, a = "(1 / 298.257223563::DOUBLE)", "6378137.0::DOUBLE"
    b = f"({a} * (1 - {f}))"
    tables = {
        "degrees": DEGREES,
        "reduced": f"""SELECT a.distrito_id AS za, b.distrito_id AS zb, radians(b.lon - a.lon) AS span,
            atan((1 - {f}) * tan(radians(a.lat))) AS u1, atan((1 - {f}) * tan(radians(b.lat))) AS u2
            FROM degrees a JOIN degrees b ON a.distrito_id < b.distrito_id""",
        "round0": "SELECT *, span AS lam FROM reduced",
    }
    for i in range(1, 9):
        tables[f"sides{i}"] = f"""SELECT za, zb, span, u1, u2, lam,
            sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS s,
            sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS c FROM round{i - 1}"""
        tables[f"angles{i}"] = f"""SELECT *, atan2(s, c) AS sigma,
            CASE WHEN s = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / s END AS sa FROM sides{i}"""
        tables[f"bends{i}"] = f"""SELECT *, 1 - sa * sa AS ca,
            CASE WHEN 1 - sa * sa = 0 THEN 0 ELSE c - 2 * sin(u1) * sin(u2) / (1 - sa * sa) END AS cm,
            {f} / 16 * (1 - sa * sa) * (4 + {f} * (4 - 3 * (1 - sa * sa))) AS k FROM angles{i}"""
        tables[f"round{i}"] = f"""SELECT za, zb, span, u1, u2, s, c, sigma, ca, cm,
            span + (1 - k) * {f} * sa * (sigma + k * s * (cm + k * c * (2 * cm * cm - 1))) AS lam FROM bends{i}"""
    tables["squares"] = f"SELECT *, ca * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS usq FROM round8"
    tables["weights"] = """SELECT *, 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq))) AS wa,
        usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq))) AS wb FROM squares"""
    tables["geodesics"] = f"""SELECT za AS zone_a_id, zb AS zone_b_id, {b} * wa * (sigma - wb * s * (cm + wb / 4 * (
        c * (2 * cm * cm - 1) - wb / 6 * cm * (4 * s * s - 3) * (4 * cm * cm - 3)))) AS distance_meters FROM weights"""
    return tables


@query(
    "st_distance_spheroid",
    statement(
        "SELECT zone_a_id, zone_b_id, round(distance_meters, 3) AS distance_meters FROM geodesics", **_vincenty_sql()
    ),
)
def st_distance_spheroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(first_generation.distances(in_degrees(spark, sf_dir)), 3, "distance_meters")


def _projection_sql(points: str) -> dict[str, str]:
    """``projected``: the rows of ``points`` (lat, lon) with x and y, by the same series."""
    n = "(1 / 298.257222101::DOUBLE / (2 - 1 / 298.257222101::DOUBLE))"
    radius = f"(6378137.0::DOUBLE / (1 + {n}) * (1 + {n} ** 2 / 4 + {n} ** 4 / 64))"
    weights = [
        f"({n} / 2 - 2 * {n} ** 2 / 3 + 5 * {n} ** 3 / 16)",
        f"(13 * {n} ** 2 / 48 - 3 * {n} ** 3 / 5)",
        f"(61 * {n} ** 3 / 240)",
    ]
    ecc = f"(2 * sqrt({n}) / (1 + {n}))"
    east = " + ".join(f"{w} * cos({2 * i} * xi) * sinh({2 * i} * eta)" for i, w in enumerate(weights, 1))
    north = " + ".join(f"{w} * sin({2 * i} * xi) * cosh({2 * i} * eta)" for i, w in enumerate(weights, 1))
    return {
        "geographic": points,
        "conformal": f"""SELECT *, radians(lon + 3) AS lam, sinh(atanh(sin(radians(lat)))
            - {ecc} * atanh({ecc} * sin(radians(lat)))) AS tt FROM geographic""",
        "sphere": "SELECT *, atan2(tt, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + tt * tt)) AS eta FROM conformal",
        "projected": f"""SELECT * EXCLUDE (lam, tt, xi, eta), 500000 + 0.9996::DOUBLE * {radius} * (eta + {east}) AS x,
            0.9996::DOUBLE * {radius} * (xi + {north}) AS y FROM sphere""",
    }


@query(
    "st_transform_points",
    statement(
        """SELECT distrito_id, round(x, 4) AS x, round(y, 4) AS y FROM projected""", **_projection_sql(DEGREES)
    ),
)
def st_transform_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = in_degrees(spark, sf_dir).select(
        "distrito_id", F.col("centroide.y").alias("lat"), F.col("centroide.x").alias("lon")
    )
    moved = spatial.transform_points(zones)
    return places(moved.select("distrito_id", "x", "y"), 4, "x", "y")


ALL_DISTANCES = statement(
    "SELECT origin_id, destination_id, round(distance_meters, 4) AS distance_meters FROM distances"
)


@query(
    "pairwise_distances",
    statement(
        "SELECT origin_id, destination_id, round(distance_meters, 4) AS distance_meters "
        f"FROM ({PAIR_DISTANCE.format(test='<>').replace('own_zones', 'fine_zones')})"
    ),
)
def pairwise_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between the zones of the finer grid."""
    zones = settle(t.fine_zones(spark, sf_dir), "zones")
    return places(pairs.pair_distances(zones), 4, "distance_meters")


@query("prod_distances", ALL_DISTANCES)
def prod_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between the zones under statistical codes, doubled codes included."""
    return places(silver.distances(geometries(spark, sf_dir)), 4, "distance_meters")


# --- clustering --------------------------------------------------------------


def trip_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-by-hour shares of all trips, written once."""
    return settle(gold.daily_profile(silver_trips(spark, sf_dir)), "daily_profile")


ACTIVITY_PROFILE = "SELECT date, " + ", ".join(
    f'COALESCE(CAST(SUM(value) FILTER (hour = {h}) AS DOUBLE), 0.0) AS "{h}"' for h in range(24)
) + " FROM activity GROUP BY date"


def activity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = t.activity(spark, sf_dir).groupBy("date", "hour").agg(F.sum("value").cast("double").alias("value"))
    return settle(aggregates.pivot_hours(hourly, "value"), "activity_profile")


Z_SCORES = "SELECT date, " + ", ".join(
    f'round(("{h}" - AVG("{h}") OVER ()) / STDDEV_POP("{h}") OVER (), 6) AS "{h}"' for h in range(24)
) + " FROM activity_profile"


@query("ml_standardize", statement(Z_SCORES, activity_profile=ACTIVITY_PROFILE))
def ml_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = clustering.standardized(activity_profile(spark, sf_dir), HOUR_COLUMNS)
    return places(scores, 6, *HOUR_COLUMNS).select("date", *HOUR_COLUMNS)


def _gap_squares(v: str, c: str) -> str:
    """The squared distance of two lists, summed from the first hour on."""
    return " + ".join(f"({v}[{h}] - {c}[{h}]) * ({v}[{h}] - {c}[{h}])" for h in range(1, 25))


def _draws(number: int) -> str:
    """The smallest -ln(draw) / squared distance of each start, and its point appended to the centres."""
    name = f"(42 + s.start) || ':{number}:' || strftime(p.date, '%Y-%m-%d')"
    draw = f"(CAST(CAST('0x' || substr(md5({name}), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496::DOUBLE"
    if number == 0:
        return f"SELECT start, [arg_min(p.v, {{'key': -ln({draw}), 'day': p.date}})] AS cs FROM (SELECT unnest(range(10)) AS start) s, km_points p GROUP BY start"
    return f"""
        SELECT start, list_append(ANY_VALUE(cs), arg_min(v, {{'key': key, 'day': date}})) AS cs
        FROM (SELECT s.start, s.cs, p.v, p.date, -ln({draw}) / far AS key
              FROM (SELECT start, cs, date, v, list_min(list_transform(cs, lambda c: {_gap_squares("v", "c")})) AS far
                    FROM km_draw{number - 1}, km_points) p
              JOIN km_draw{number - 1} s USING (start) WHERE far > 0)
        GROUP BY start"""


def clusters_sql(days: str) -> dict[str, str]:
    """Seeding as four draws, Lloyd's rounds as a recursion over all runs that still move, and the
    silhouette of each number of clusters over pairs of days."""
    near = f"list_transform(cs, lambda c: {_gap_squares('v', 'c')})"
    means = ", ".join(f"CAST(SUM(v[{h}]) AS DOUBLE) / COUNT(*)" for h in range(1, 25))
    scores = ", ".join(
        f'round(COALESCE(("{h}" - AVG("{h}") OVER ()) / NULLIF(STDDEV_POP("{h}") OVER (), 0), 0) * 1000000)'
        for h in range(24)
    )
    return {
        "km_points": f"SELECT date, CAST([{scores}] AS DOUBLE[]) AS v FROM {days}",
        **{f"km_draw{number}": _draws(number) for number in range(4)},
        "km_runs": f"""
            SELECT 0 AS round, k, start, cs[1:k] AS cs, true AS moved, CAST(0 AS HUGEINT) AS cost
            FROM km_draw3, (VALUES (3), (4)) sizes(k)
            UNION ALL
            SELECT round + 1, k, start, next, next <> cs, total
            FROM (SELECT round, k, start, cs, total,
                    list_transform(range(1, k + 1), lambda i: COALESCE(found[i], cs[i])) AS next
                  FROM (SELECT round, k, start, ANY_VALUE(cs) AS cs, CAST(SUM(cost) AS HUGEINT) AS total,
                          map_from_entries(list({{'k': cluster, 'v': mean}})) AS found
                        FROM (SELECT round, k, start, cluster, ANY_VALUE(cs) AS cs, [{means}] AS mean,
                                SUM(CAST(floor(list_min(far) / 1000000) AS HUGEINT)) AS cost
                              FROM (SELECT *, list_position(far, list_min(far)) AS cluster
                                    FROM (SELECT round, k, start, cs, v, {near} AS far
                                          FROM km_runs, km_points WHERE moved AND round < 300))
                              GROUP BY round, k, start, cluster)
                        GROUP BY round, k, start))""",
        "km_best": """
            SELECT k, arg_min(cs, {'cost': cost, 'start': start}) AS cs
            FROM (SELECT * FROM km_runs QUALIFY row_number() OVER (PARTITION BY k, start ORDER BY round DESC) = 1)
            GROUP BY k""",
        "km_labels": f"""
            SELECT k, date, v, CAST(list_position(far, list_min(far)) - 1 AS INTEGER) AS cluster
            FROM (SELECT k, date, v, {near} AS far FROM km_best, km_points)""",
        "km_scores": """
            SELECT k, AVG(CASE WHEN size = 1 THEN 0 ELSE COALESCE((b - a) / NULLIF(GREATEST(a, b), 0), 0) END) AS silhouette
            FROM (SELECT k, date, MAX(CASE WHEN same THEN members END) AS size,
                    MAX(CASE WHEN same THEN total / NULLIF(members - 1, 0) END) AS a,
                    MIN(CASE WHEN NOT same THEN total / members END) AS b
                  FROM (SELECT p.k, p.date, q.cluster, p.cluster = q.cluster AS same, COUNT(*) AS members,
                          SUM(list_distance(p.v, q.v)) AS total
                        FROM km_labels p JOIN km_labels q USING (k) GROUP BY ALL)
                  GROUP BY 1, 2)
            GROUP BY 1""",
        "km_chosen": """
            SELECT date, cluster, k, round(silhouette, 6) AS silhouette,
                MIN(date) OVER (PARTITION BY cluster) AS first_day
            FROM km_labels JOIN km_scores USING (k)
            WHERE k = (SELECT if(MAX(CASE WHEN k = 4 THEN silhouette END) > MAX(CASE WHEN k = 3 THEN silhouette END), 4, 3)
                       FROM km_scores)""",
    }


ACTIVITY_CLUSTERS = {"activity_profile": ACTIVITY_PROFILE, **clusters_sql("activity_profile")}
PATTERNS = "SELECT date, CAST(dense_rank() OVER (ORDER BY first_day) - 1 AS INTEGER) AS pattern_type FROM km_chosen"


@query("ml_kmeans", statement("SELECT date, cluster FROM km_labels WHERE k = 3", **ACTIVITY_CLUSTERS))
def ml_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of hourly activity in three clusters."""
    scores = clustering.standardized(activity_profile(spark, sf_dir), HOUR_COLUMNS)
    points = settle(clustering.fixed_points(scores, HOUR_COLUMNS), "points")
    centres = clustering.best_kmeans(points, (3,))[3]
    return clustering.labelled(points, centres, "date").withColumnRenamed("prediction", "cluster")


SILHOUETTE = f"""
    SELECT round(AVG(CASE WHEN size = 1 THEN 0 ELSE COALESCE((b - a) / NULLIF(GREATEST(a, b), 0), 0) END), 6) AS silhouette
    FROM (SELECT date, pattern_type, ANY_VALUE(CASE WHEN other = pattern_type THEN members END) AS size,
            MAX(CASE WHEN other = pattern_type THEN total / NULLIF(members - 1, 0) END) AS a,
            MIN(CASE WHEN other <> pattern_type THEN total / members END) AS b
          FROM (SELECT p.date, p.pattern_type, q.pattern_type AS other, COUNT(*) AS members,
                  SUM(sqrt({" + ".join(f'power(p."{h}" - q."{h}", 2)' for h in range(24))})) AS total
                FROM labelled p, labelled q GROUP BY 1, 2, 3)
          GROUP BY 1, 2)"""


@query(
    "ml_silhouette",
    statement(
        SILHOUETTE,
        patterns=FIXED_PATTERNS,
        labelled="SELECT * FROM daily_profile JOIN patterns USING (date)",
    ),
)
def ml_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the days' hour shares under fixed labels."""
    points = labelled_shares(spark, sf_dir)
    return places(clustering.mean_silhouette(points, "date", "pattern_type", "shares"), 6, "silhouette")


def labelled_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = trip_profile(spark, sf_dir).join(fixed_patterns(spark, sf_dir), "date")
    return settle(labelled.select("date", "pattern_type", F.array(*HOUR_COLUMNS).alias("shares")), "points")


# How much of a day falls where the whole day has its most: clusters that lie apart.
PEAKS = f"""SELECT date, list_position([{", ".join(f'"{h}"' for h in range(24))}],
    greatest({", ".join(f'"{h}"' for h in range(24))})) - 1 AS peak FROM daily_profile"""
TO_CENTRE = " + ".join(f'power(p."{h}" - c.m{h}, 2)' for h in range(24))


@query(
    "ml_silhouette_work",
    statement(
        """SELECT CAST(SUM(n) FILTER (other = peak OR least <= 1.000000001::DOUBLE * (
                 SELECT MIN(o.most) FROM bounds o WHERE o.date = b.date AND o.other <> b.peak)) AS BIGINT) AS compared,
               ANY_VALUE(pairs) AS pairs
           FROM bounds b""",
        peaks=PEAKS,
        centres=f"""SELECT peak AS other, COUNT(*) AS n, {", ".join(f'AVG("{h}") AS m{h}' for h in range(24))},
            {" + ".join(f'VAR_POP("{h}")' for h in range(24))} AS spread FROM daily_profile JOIN peaks USING (date) GROUP BY 1""",
        bounds=f"""SELECT p.date, k.peak, c.other, c.n, sqrt({TO_CENTRE}) AS least, sqrt({TO_CENTRE} + c.spread) AS most,
              CAST((SELECT COUNT(*) * COUNT(*) FROM daily_profile) AS BIGINT) AS pairs
            FROM daily_profile p JOIN peaks k USING (date), centres c""",
    ),
)
def ml_silhouette_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances the silhouette of days under their busiest hour takes, of those between all days."""
    shares = F.array(*HOUR_COLUMNS)
    peak = (F.array_position(shares, F.array_max(shares)) - 1).cast("int")
    points = settle(trip_profile(spark, sf_dir).select("date", peak.alias("peak"), shares.alias("shares")), "points")
    return clustering.silhouette_work(points, "date", "peak", "shares")


@query("ml_select_k", statement("SELECT date, cluster, k, silhouette FROM km_chosen", **ACTIVITY_CLUSTERS))
def ml_select_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of hourly activity under the chosen number of clusters."""
    best, scores, labelled = clustering.choose_k(activity_profile(spark, sf_dir), HOUR_COLUMNS)
    return labelled.select(
        "date",
        F.col("prediction").alias("cluster"),
        F.lit(best).alias("k"),
        s.rounded(F.lit(scores[best]), 6).alias("silhouette"),
    )


@query("ml_pattern_table", statement(PATTERNS, **ACTIVITY_CLUSTERS))
def ml_pattern_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, labelled = clustering.choose_k(activity_profile(spark, sf_dir), HOUR_COLUMNS)
    return clustering.pattern_table(labelled)


# --- products ----------------------------------------------------------------


@query(
    "prod_calendar",
    statement(
        "SELECT fecha AS date, es_festivo = 1 AS is_holiday, es_fin_de_semana = 1 AS is_weekend FROM calendar"
    ),
)
def prod_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.calendar(order_calendar(spark, sf_dir))


@query(
    "prod_calendar_gen1",
    statement(
        """SELECT fecha AS date, es_festivo = 1 AS is_holiday, es_fin_de_semana = 1 AS is_weekend FROM calendar
           WHERE es_festivo = 1 OR es_fin_de_semana = 1"""
    ),
)
def prod_calendar_gen1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From text columns, special days only."""
    texts = special_days(order_calendar(spark, sf_dir)).select(
        F.date_format("fecha", "yyyy-MM-dd").alias("fecha"),
        F.col("es_festivo").cast("string").alias("es_festivo"),
        F.col("es_fin_de_semana").cast("string").alias("es_fin_de_semana"),
    )
    return first_generation.calendar(texts)


@query("prod_relation", statement("SELECT * FROM silver_relation"))
def prod_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_relation(spark, sf_dir)


@query("prod_geometries", statement("SELECT * FROM geometries"))
def prod_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometries(spark, sf_dir).select("distrito_id", "centroide.x", "centroide.y", "geometria")


@query("prod_demographics", statement("SELECT * FROM demographics"))
def prod_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demographics(spark, sf_dir)


def _sections(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    series = t.section_series(spark, sf_dir, value)
    return series.select(
        F.col("codigo").alias("seccion"), "fecha", F.col("valor").cast("bigint").cast("string").alias("total")
    )


@query(
    "prod_demographics_gen1",
    statement(
        """SELECT seccion AS "ID", CAST(people AS INTEGER) AS population, make_date(year, 1, 1) AS year
           FROM section_years"""
    ),
)
def prod_demographics_gen1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_generation.population(_sections(spark, sf_dir, "people"))


@query(
    "prod_gdp_gen1",
    statement("""SELECT seccion AS "ID", year, CAST(income AS DOUBLE) AS gdp_euros FROM section_years"""),
)
def prod_gdp_gen1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_generation.income(_sections(spark, sf_dir, "income"))


@query(
    "prod_trips",
    statement(
        "SELECT date, period, origin_id, destination_id, travels, round(travels_km, 2) AS travels_km FROM silver_trips"
    ),
)
def prod_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_places(silver_trips(spark, sf_dir), "travels_km")


STUDY_CORNERS = """
    SELECT * FROM (VALUES (0, 40.9::DOUBLE, -1.7::DOUBLE), (1, 40.9, 0.9), (2, 37.8, 0.9),
        (3, 37.8, -1.7), (4, 40.9, -1.7)) v(seq, lat, lon)"""
STUDY_EDGES = """
    SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM projected a JOIN projected b ON b.seq = a.seq + 1"""
STUDY = {**_projection_sql(STUDY_CORNERS), **inside_sql(STUDY_EDGES)}


@query("prod_trips_in_region", statement(IN_ZONE.format(zones="zones_inside"), **STUDY))
def prod_trips_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trips_in_region(silver_trips(spark, sf_dir), geometries(spark, sf_dir))


def _features_sql(od: str) -> dict[str, str]:
    return {"measured_pairs": measured(od), "shown_features": gravity("measured_pairs", 4)}


FEATURES = "SELECT * FROM shown_features"


@query(
    "prod_gravity_features",
    statement(
        FEATURES,
        **STUDY,
        region_trips=IN_ZONE.format(zones="zones_inside"),
        region_od="SELECT origin_id, destination_id, SUM(travels) AS actual_trips FROM region_trips GROUP BY 1, 2",
        **_features_sql("region_od"),
    ),
)
def prod_gravity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the trips inside the study area: both ends are filtered before the one sum."""
    mapping = district_map(spark, sf_dir)
    zones = geometries(spark, sf_dir, mapping)
    od = aggregates.od_totals(gold.trips_in_region(joins.recode_both_ends(t.legs(spark, sf_dir), mapping), zones))
    features = gold.gravity_features(od, demographics(spark, sf_dir), YEAR, geometries=zones)
    return places(features, 4, "dist_meters", "gravity_raw")


DATES = ("1996-01-01", "1996-12-31")


@query(
    "prod_gravity_features_dated",
    statement(
        FEATURES,
        dated_od=f"""SELECT origin_id, destination_id, SUM(travels) AS actual_trips FROM silver_trips
            WHERE date BETWEEN DATE '{DATES[0]}' AND DATE '{DATES[1]}' GROUP BY 1, 2""",
        **_features_sql("dated_od"),
    ),
)
def prod_gravity_features_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = filters.between_days(silver_trips(spark, sf_dir), *DATES)
    features = gold.gravity_features(
        aggregates.od_totals(dated), demographics(spark, sf_dir), YEAR, geometries=geometries(spark, sf_dir)
    )
    return places(features, 4, "dist_meters", "gravity_raw")


@query(
    "prod_gravity_features_batched",
    statement(
        FEATURES,
        partials=PARTIALS,
        batched_od="""SELECT origin_id, destination_id, CAST(SUM(partial_trips) AS BIGINT) AS actual_trips
            FROM partials GROUP BY 1, 2""",
        **_features_sql("batched_od"),
    ),
)
def prod_gravity_features_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = gold.gravity_features(
        aggregates.from_partials(halved_partials(spark, sf_dir)),
        demographics(spark, sf_dir),
        YEAR,
        geometries=geometries(spark, sf_dir),
    )
    return places(features, 4, "dist_meters", "gravity_raw")


def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = district_map(spark, sf_dir)
    features = gold.gravity_features(
        silver.od_totals(t.legs(spark, sf_dir), mapping),
        demographics(spark, sf_dir),
        YEAR,
        geometries=geometries(spark, sf_dir, mapping),
    )
    return gold.infrastructure_gaps(features)


@query("prod_infrastructure_gaps", statement("SELECT * FROM gaps ORDER BY gap_ratio"))
def prod_infrastructure_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.worst_first(gap_report(spark, sf_dir))


@query("sort_gap_asc", statement("SELECT origin_id, destination_id, gap_ratio FROM gaps ORDER BY gap_ratio"))
def sort_gap_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.worst_first(gap_report(spark, sf_dir)).select("origin_id", "destination_id", "gap_ratio")


@query(
    "topk_gaps",
    statement("SELECT * FROM gaps ORDER BY gap_ratio, origin_id, destination_id LIMIT 50"),
)
def topk_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.worst_served(gap_report(spark, sf_dir), 50)


@query(
    "agg_avg_by_zone",
    """SELECT c_nationkey AS origin_id, AVG(round(c_acctbal * 100)) AS avg_gap_ratio, n_name AS geom_wkt
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 3""",
)
def agg_avg_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = t.load(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("origin_id"), F.round(F.col("c_acctbal") * 100).alias("gap_ratio")
    )
    zones = t.load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("distrito_id"), F.col("n_name").alias("geometria")
    )
    return aggregates.mean_gap_by_zone(values, zones)


@query(
    "prod_gap_map_data",
    statement(
        """SELECT origin_id, AVG(round(gap_ratio * 10000)) / 10000 AS avg_gap_ratio, geom_wkt
           FROM gaps JOIN (SELECT distrito_id AS origin_id, geometria AS geom_wkt FROM geometries) USING (origin_id)
           GROUP BY ALL"""
    ),
)
def prod_gap_map_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averaged in ten-thousandths, which add up exactly in any order."""
    whole = gap_report(spark, sf_dir).withColumn("gap_ratio", F.round(F.col("gap_ratio") * 10000))
    found = aggregates.mean_gap_by_zone(whole, geometries(spark, sf_dir))
    return found.withColumn("avg_gap_ratio", F.col("avg_gap_ratio") / 10000)


FANOUT = {
    "g1_trips": """SELECT date, lpad(origin, 8, '0') AS origin_id, lpad(destination, 8, '0') AS destination_id,
        travels FROM legs""",
    "g1_zones": "SELECT lpad(zone, 8, '0') AS zid, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM zone_points",
    # a pair counts once for each population row of its origin and income row of its destination
    "g1_sections": """SELECT seccion, COUNT(*) AS n_years, MAX(people) AS people, MAX(income) AS income
        FROM section_years GROUP BY seccion""",
    "g1_totals": """SELECT origin_id, destination_id, SUM(travels) AS trips FROM g1_trips
        WHERE year(date) BETWEEN 1995 AND 2001 AND origin_id < destination_id GROUP BY origin_id, destination_id""",
    "g1_inputs": """SELECT origin_id, destination_id, sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS distance_meters,
          trips * p.n_years * e.n_years AS actual_trips, p.people AS p_most, e.income AS e_most
        FROM g1_totals, g1_zones a, g1_zones b, g1_sections p, g1_sections e
        WHERE a.zid = origin_id AND b.zid = destination_id AND p.seccion = origin_id AND e.seccion = destination_id""",
    "g1_pull": """SELECT *, CAST(p_most AS DOUBLE) * e_most / greatest(distance_meters * distance_meters, 0.01) AS pull
        FROM g1_inputs""",
}


def _first_generation_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones are sections here, so a zone has a population row per year."""

    def code(name: str):
        return F.lpad(F.col(name), 8, "0")

    trips = t.legs(spark, sf_dir).select(
        "date", code("origin").alias("origin_id"), code("destination").alias("destination_id"), "travels"
    )
    zones = settle(t.geometries(spark, sf_dir).withColumn("distrito_id", code("distrito_id")), "zones")
    half = filters.renamed(
        pairs.pair_distances(zones, mirror=False),
        {"origin_id": "zone_a_id", "destination_id": "zone_b_id", "distance_meters": "distance_meters"},
    )
    return first_generation.model_inputs(
        trips,
        joins.zone_parts(zones.select("distrito_id", "geometria"), zones.select("distrito_id", "centroide")),
        first_generation.population(_sections(spark, sf_dir, "people")),
        first_generation.income(_sections(spark, sf_dir, "income")),
        half,
        "1995-01-01",
        "2001-12-31",
    )


@query(
    "join_model_inputs_fanout",
    statement(
        """SELECT origin_id, destination_id, actual_trips, round(distance_meters, 4) AS distance_meters,
             CAST(p_most AS INTEGER) AS "P_i", CAST(e_most AS DOUBLE) AS "E_j" FROM g1_inputs""",
        **FANOUT,
    ),
)
def join_model_inputs_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(_first_generation_inputs(spark, sf_dir), 4, "distance_meters")


@query(
    "prod_infrastructure_gaps_gen1",
    statement(
        """SELECT origin_id, destination_id, actual_trips, round(expected, 3) AS potential_demand,
             CASE WHEN expected > 0 THEN round(actual_trips / expected, 5) END AS gap_ratio
           FROM (SELECT *, pull * (SUM(actual_trips) OVER () / fsum(pull) OVER ()) AS expected FROM g1_pull)""",
        **FANOUT,
    ),
)
def prod_infrastructure_gaps_gen1(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = settle(_first_generation_inputs(spark, sf_dir), "model_inputs")
    return places(places(first_generation.infrastructure_gaps(inputs), 3, "potential_demand"), 5, "gap_ratio")


@query(
    "prod_mobility_patterns",
    statement(
        by_type_sql(", quantile_cont(travels, 0.5) AS median_trips_per_hour")
    ),
)
def prod_mobility_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact median reads the trips several times: they are written first."""
    trips = settle(silver_trips(spark, sf_dir).select("date", "period", "travels"), "trips")
    return first_generation.mobility_patterns(trips, exact=True)


@query("prod_daily_profile", statement("SELECT * FROM daily_profile"))
def prod_daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_profile(silver_trips(spark, sf_dir))


REGION_PROFILE = {
    **STUDY,
    "region_trips": IN_ZONE.format(zones="zones_inside"),
    "region_shares": """
        SELECT date, hour, hour_trips / NULLIF(SUM(hour_trips) OVER (PARTITION BY date), 0) AS share
        FROM (SELECT date, period AS hour, SUM(travels) AS hour_trips FROM region_trips GROUP BY 1, 2)""",
    "region_profile": "SELECT date, "
    + ", ".join(f'COALESCE(SUM(share) FILTER (hour = {h}), 0.0) AS "{h}"' for h in range(24))
    + " FROM region_shares GROUP BY date",
}


@query("prod_date_patterns", statement(PATTERNS, **REGION_PROFILE, **clusters_sql("region_profile")))
def prod_date_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of the trips inside the study area."""
    trips = gold.trips_in_region(silver_trips(spark, sf_dir), geometries(spark, sf_dir))
    return gold.date_patterns(gold.daily_profile(trips))


@query("prod_calendar_clusters", CALENDAR_JOIN)
def prod_calendar_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.with_calendar(fixed_patterns(spark, sf_dir), silver.calendar(order_calendar(spark, sf_dir)))
