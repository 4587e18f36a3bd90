"""The engine's input tables, derived from the driver's tables.

Every line item stands for one landed trip row, customers for census sections,
orders for section statistics and feed items, embeddings for zone centroids,
events for hourly activity. Zones are a fixed grid of codes, as a country's
districts are: more data means more trips per zone, not more zones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.schemas import TRIP_FIELDS
from corridor.sources import geometry

ZONES = 500
FINE_ZONES = 2000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def legs(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Typed trip rows before any sum."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_shipdate AS DATE) AS date",
        "lpad(CAST(l_orderkey % 24 AS STRING), 2, '0') AS period",
        f"lpad(CAST(l_partkey % {ZONES} AS STRING), 3, '0') AS origin",
        f"lpad(CAST(l_suppkey % {ZONES} AS STRING), 3, '0') AS destination",
        """CASE WHEN l_extendedprice < 20000 THEN '0.5-2' WHEN l_extendedprice < 40000 THEN '2-10'
           WHEN l_extendedprice < 60000 THEN '10-50' ELSE '>50' END AS distance""",
        "l_returnflag AS activity_origin",
        "l_linestatus AS activity_destination",
        "CASE WHEN l_discount >= 0.05 THEN 'si' ELSE 'no' END AS study_origin_posible",
        "CASE WHEN l_linenumber > 3 THEN 'si' ELSE 'no' END AS study_destination_posible",
        "lpad(CAST(l_suppkey % 25 AS STRING), 2, '0') AS residence",
        "CASE WHEN l_linenumber <= 2 THEN '<10' WHEN l_linenumber <= 5 THEN '10-15' ELSE '>15' END AS rent",
        """CASE WHEN l_tax < 0.02 THEN '0-25' WHEN l_tax < 0.04 THEN '25-45'
           WHEN l_tax < 0.06 THEN '45-65' ELSE '65-100' END AS age""",
        """CASE WHEN l_tax >= 0.08 THEN NULL WHEN l_orderkey % 2 = 0 THEN 'hombre' ELSE 'mujer' END AS gender""",
        "l_quantity AS travels",
        "l_extendedprice AS travels_km",
        *extra,
    )


def busy_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as legs of 16 neighbouring orders each: a leg's rows share day, hour, both zones
    and most other dimensions, so every group of a sum holds ten rows or more, and the number of
    groups grows with the table."""
    few = {
        "date": "date_add(DATE '1995-01-01', CAST(leg * 37 % 2557 AS INT))",
        "period": "lpad(CAST(leg % 24 AS STRING), 2, '0')",
        "origin": f"lpad(CAST(leg % {ZONES} AS STRING), 3, '0')",
        "destination": f"lpad(CAST((leg + leg div {ZONES} + 1) % {ZONES} AS STRING), 3, '0')",
        "distance": "CASE WHEN leg % 5 < 3 THEN '2-10' ELSE '10-50' END",
        "study_origin_posible": "CASE WHEN leg % 5 < 2 THEN 'si' ELSE 'no' END",
        "study_destination_posible": "CASE WHEN leg % 7 < 3 THEN 'si' ELSE 'no' END",
        "residence": "lpad(CAST(leg % 25 AS STRING), 2, '0')",
        "rent": "CASE WHEN leg % 2 = 0 THEN '<10' ELSE '>15' END",
        "age": "CASE WHEN leg % 3 = 0 THEN '25-45' ELSE '45-65' END",
        "gender": "CASE WHEN leg % 4 = 0 THEN NULL ELSE 'mujer' END",
    }
    rows = legs(spark, sf_dir, "l_orderkey div 16 AS leg")
    return rows.withColumns({name: F.expr(sql) for name, sql in few.items()}).drop("leg")


def raw_trips(spark: SparkSession, sf_dir: str, busy: bool = False, weekly: bool = False) -> DataFrame:
    """The same rows as published: all strings, compact dates."""
    rows = busy_legs if busy else weekly_legs if weekly else legs
    typed = rows(spark, sf_dir).withColumn("date", F.date_format("date", "yyyyMMdd"))
    return typed.select(*(F.col(new).cast("string").alias(old) for old, new in TRIP_FIELDS.items()))


def relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone relation, one row per section. Some sections sit in the next
    district, so a few districts map to two; some codes are missing or 'NA'."""
    return load(spark, sf_dir, "customer").selectExpr(
        "lpad(CAST(c_custkey AS STRING), 8, '0') AS seccion_ine",
        f"""concat('D', lpad(CAST(CASE WHEN c_custkey % 97 = 0 THEN (c_custkey + 1) % {ZONES}
            ELSE c_custkey % {ZONES} END AS STRING), 3, '0')) AS distrito_ine""",
        "CASE WHEN c_custkey % 101 = 50 THEN NULL ELSE lpad(CAST(c_nationkey AS STRING), 5, '0') END AS municipio_ine",
        f"lpad(CAST(c_custkey % {ZONES} AS STRING), 3, '0') AS distrito_mitma",
        "concat('M', CAST(c_nationkey AS STRING)) AS municipio_mitma",
        """CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN 'NA'
           ELSE concat('G', CAST(c_nationkey % 5 AS STRING)) END AS gau_mitma""",
    )


def zone_points(spark: SparkSession, sf_dir: str, zones: int = ZONES) -> DataFrame:
    """(zone, x, y): whole projected metres, the mean of a zone's vectors."""
    micro = load(spark, sf_dir, "embeddings").selectExpr(
        f"lpad(CAST(vec_id % {zones} AS STRING), {len(str(zones - 1))}, '0') AS zone",
        "CAST(floor(CAST(embedding[0] AS DOUBLE) * CAST(1000000 AS DOUBLE)) AS BIGINT) AS mx",
        "CAST(floor(CAST(embedding[1] AS DOUBLE) * CAST(1000000 AS DOUBLE)) AS BIGINT) AS my",
    )
    summed = micro.groupBy("zone").agg(
        F.sum("mx").cast("double").alias("sx"), F.sum("my").cast("double").alias("sy"), F.count("*").alias("n")
    )
    return summed.selectExpr(
        "zone",
        "CAST(726000 + floor(sx / n * CAST(0.4 AS DOUBLE)) AS BIGINT) AS x",
        "CAST(4350000 + floor(sy / n * CAST(0.5 AS DOUBLE)) AS BIGINT) AS y",
    )


def vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, x, y): every vector as a point in whole projected metres, as zone points are their means."""
    return load(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "CAST(726000 + floor(floor(CAST(embedding[0] AS DOUBLE) * CAST(1000000 AS DOUBLE)) * CAST(0.4 AS DOUBLE)) AS BIGINT) AS x",
        "CAST(4350000 + floor(floor(CAST(embedding[1] AS DOUBLE) * CAST(1000000 AS DOUBLE)) * CAST(0.5 AS DOUBLE)) AS BIGINT) AS y",
    )


def weekly_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trip rows as a publisher of weekly files dates them: by the Monday of their week."""
    return legs(spark, sf_dir).withColumn("date", F.trunc("date", "week"))


def week_number() -> F.Column:
    return F.floor(F.datediff(F.col("date"), F.lit("1995-01-02").cast("date")) / 7)


def later_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly rows as landed some time later: one week in 11 has come, one in 9 has more travels, one in 17 is no more."""
    more = F.when(week_number() % 9 == 0, F.col("travels") + 1).otherwise(F.col("travels"))
    return weekly_legs(spark, sf_dir).filter(week_number() % 17 != 3).withColumn("travels", more)


def earlier_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly rows landed at first, without the weeks that come later."""
    return weekly_legs(spark, sf_dir).filter(week_number() % 11 != 5)


def centroid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_points(spark, sf_dir).selectExpr("zone AS ID", "concat('POINT (', x, ' ', y, ')') AS geom")


def outline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square around the centroid with a square hole."""

    def square(half: int) -> str:
        corners = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
        parts = ", ', ', ".join(f"x + {dx}, ' ', y + {dy}" for dx, dy in corners)
        return f"'(', {parts}, ')'"

    return zone_points(spark, sf_dir).selectExpr(
        "zone AS ID", f"concat('POLYGON (', {square(900)}, ', ', {square(300)}, ')') AS geom"
    )


def geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as (distrito_id, centroide, geometria) under their own codes."""
    points = geometry.centroids(centroid_table(spark, sf_dir))
    return points.join(geometry.outlines(outline_table(spark, sf_dir)), "distrito_id")


def fine_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(distrito_id, centroide) on a finer grid, for the pairwise distances."""
    return zone_points(spark, sf_dir, FINE_ZONES).select(
        F.col("zone").alias("distrito_id"),
        F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).alias("centroide"),
    )


def section_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seccion, year, people, income): whole numbers, from a section's orders."""
    return (
        load(spark, sf_dir, "orders")
        .selectExpr(
            "lpad(CAST(o_custkey AS STRING), 8, '0') AS seccion",
            "year(o_orderdate) AS year",
            "CAST(round(o_totalprice * 100) AS BIGINT) AS cents",
        )
        .groupBy("seccion", "year")
        .agg(F.count("*").alias("orders"), F.sum("cents").alias("cents"))
        .selectExpr("seccion", "year", "orders * 100 AS people", "cents div (100 * orders) AS income")
    )


def section_series(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    """(codigo, fecha, valor) of ``people`` or ``income``."""
    return section_years(spark, sf_dir).selectExpr(
        "seccion AS codigo",
        "concat(CAST(year AS STRING), '-01-01T00:00:00.000+01:00') AS fecha",
        f"CAST({value} AS DOUBLE) AS valor",
    )


def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistical documents, one per section: five metadata entries (two for
    some), a value per year ('.' for some), no values at all for some."""
    points = section_years(spark, sf_dir).selectExpr(
        "seccion",
        """named_struct('Fecha', concat(CAST(year AS STRING), '-01-01T00:00:00.000+01:00'),
           'Valor', CASE WHEN year = 1997 AND right(seccion, 1) = '3' THEN '.'
                    ELSE CAST(income AS STRING) END) AS point""",
    )
    # at most one point per section and year
    grouped = points.groupBy("seccion").agg(F.sort_array(F.collect_list("point")).alias("points"))
    meta = """array(
        named_struct('T3_Variable', CASE WHEN right(seccion, 1) = '9' THEN 'Municipios' ELSE 'Secciones' END,
                     'Codigo', seccion, 'Nombre', concat('Seccion ', seccion)),
        named_struct('T3_Variable', 'Edad', 'Codigo', '', 'Nombre', '16 y más años'),
        named_struct('T3_Variable', 'Concepto', 'Codigo', '',
                     'Nombre', CASE WHEN right(seccion, 1) = '7' THEN 'Total' ELSE 'Renta neta media por persona' END),
        named_struct('T3_Variable', 'Sexo', 'Codigo', '', 'Nombre', 'Total'),
        named_struct('T3_Variable', 'Origen', 'Codigo', '', 'Nombre', 'Total'))"""
    return grouped.selectExpr(
        f"CASE WHEN right(seccion, 1) = '5' THEN slice({meta}, 1, 2) ELSE {meta} END AS MetaData",
        "CASE WHEN right(seccion, 1) = '1' THEN slice(points, 1, 0) ELSE points END AS Data",
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, hour, value) of every event."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(ts AS DATE) AS date", "hour(ts) AS hour", "CAST(value AS DECIMAL(18, 2)) AS value"
    )


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed item per order: daily files of three levels; some links lack the
    marker, some items name a dimension file or an archive of outlines."""
    return load(spark, sf_dir, "orders").selectExpr(
        """CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 1 THEN 'nombres_distritos.csv'
           WHEN o_orderkey % 25 = 7 THEN 'zonificacion_distritos.zip'
           ELSE concat(date_format(o_orderdate, 'yyyyMMdd'), '_Viajes_',
                CASE o_orderkey % 3 WHEN 0 THEN 'distritos' WHEN 1 THEN 'GAU' ELSE 'municipios' END,
                '.csv.gz') END AS title""",
        """concat('https://files.example.org/',
                CASE WHEN o_orderkey % 5 = 0 THEN 'otros' ELSE 'estudios_basicos' END,
                '/', CAST(o_orderkey AS STRING)) AS link""",
        "o_orderkey AS pos",
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date): days with a very large urgent order."""
    return (
        load(spark, sf_dir, "orders")
        .filter("o_orderpriority = '1-URGENT' AND o_totalprice > 400000")
        .selectExpr("CAST(o_orderdate AS DATE) AS date")
        .distinct()
    )
