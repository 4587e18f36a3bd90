"""Sources: each query lands data derived from the tables, then reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corridor.functions import wkt
from corridor.operators import filters
from corridor.plans import bronze
from corridor.schemas import RAW_TRIPS, RELATION, TRIP_FIELDS, strings
from corridor.session import new_path
from corridor.sources import calendar as calendars
from corridor.sources import delimited, feed, geometry, series
from corridor.workload import tables as t
from corridor.workload.oracle_tables import statement
from corridor.workload.registry import query

RAW_SQL = """
    SELECT strftime(date, '%Y%m%d') AS fecha, period AS periodo, origin AS origen, destination AS destino,
        distance AS distancia, activity_origin AS actividad_origen, activity_destination AS actividad_destino,
        study_origin_posible AS estudio_origen_posible, study_destination_posible AS estudio_destino_posible,
        residence AS residencia, rent AS renta, age AS edad, gender AS sexo,
        travels AS viajes, travels_km AS viajes_km
    FROM legs"""


def _numbers(raw: DataFrame) -> DataFrame:
    return raw.withColumns({name: F.col(name).cast("double") for name in ("viajes", "viajes_km")})


@query("scan_csv_lenient", statement(RAW_SQL))
def scan_csv_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every good row next to a copy of it that is too short or too long."""
    path = new_path(spark, "lenient")
    raw = t.raw_trips(spark, sf_dir)
    raw.write.option("header", True).option("sep", "|").option("compression", "gzip").csv(path)
    fields = [F.coalesce(F.col(name), F.lit("")) for name in raw.columns]
    short, long = F.concat_ws("|", *fields[:4]), F.concat_ws("|", *fields, F.lit("x"))
    malformed = F.when(F.col("actividad_destino") == "O", short).otherwise(long)
    raw.select(malformed.alias("value")).write.mode("append").text(path)
    return _numbers(delimited.read_lenient(spark, path, RAW_TRIPS))


@query("scan_csv_dims", statement("SELECT * FROM relation"))
def scan_csv_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "relation")
    codes = RELATION.fieldNames()
    t.relation(spark, sf_dir).withColumn("extra", F.lit("x")).write.option("header", True).option("sep", "|").csv(path)
    return delimited.read_dimension(spark, path, codes)


@query(
    "detect_delimiter",
    statement(
        """SELECT origen, delimiter, COUNT(*) AS rows, SUM(viajes) AS viajes FROM raw
           JOIN (VALUES ('O', ';'), ('F', '|')) d(actividad_destino, delimiter) USING (actividad_destino)
           GROUP BY 1, 2""",
        raw=RAW_SQL,
    ),
)
def detect_delimiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of open items use ';', the others '|'; one table of both."""
    path = new_path(spark, "mixed")
    raw = t.raw_trips(spark, sf_dir)
    for status, sep in (("O", ";"), ("F", "|")):
        part = raw.filter(F.col("actividad_destino") == status)
        part.write.option("header", True).option("sep", sep).csv(f"{path}/{'semicolon' if sep == ';' else 'pipe'}")
    folders = [f"{path}/semicolon", f"{path}/pipe"]
    rows = delimited.read_detected(spark, folders, RAW_TRIPS)
    return rows.groupBy("origen", "delimiter").agg(
        F.count("*").alias("rows"), F.sum(F.col("viajes").cast("double")).alias("viajes")
    )


@query("scan_glob", statement("SELECT event_id, hour, date FROM activity"))
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day folders with compressed files to read and plain ones to leave."""
    path = new_path(spark, "days")
    daily = t.activity(spark, sf_dir).withColumn("day", F.date_format("date", "yyyyMMdd"))
    writer = daily.select("event_id", "hour", "date", "day").write.partitionBy("day").option("header", True)
    writer.option("compression", "gzip").csv(path)
    daily.select(F.lit(-1).alias("event_id"), "hour", "date", "day").write.mode("append").partitionBy("day").csv(path)
    schema = strings("event_id", "hour", "date")
    rows = delimited.read_lenient(spark, f"{path}/day=2024*", schema, sep=",", glob="*.csv.gz")
    return rows.select(F.col("event_id").cast("bigint"), F.col("hour").cast("int"), F.col("date").cast("date"))


def land_documents(spark: SparkSession, sf_dir: str) -> str:
    """Statistical documents as gzip text, one array of at most 256 per line."""
    path = new_path(spark, "documents")
    documents = t.series_documents(spark, sf_dir)
    texts = documents.select(
        F.floor(F.col("MetaData")[0]["Codigo"].cast("bigint") / 256).alias("block"),
        F.to_json(F.struct("MetaData", "Data")).alias("text"),
    )
    arrays = texts.groupBy("block").agg(F.concat(F.lit("["), F.array_join(F.collect_list("text"), ","), F.lit("]")))
    arrays.drop("block").write.option("compression", "gzip").text(path)
    return path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.read_documents(spark, land_documents(spark, sf_dir), one_array_per_file=False)


INCOME_FILTER = "last NOT IN ('9', '7', '5')"

SHAPES = statement(
    """SELECT seccion AS codigo, CAST(CASE WHEN ANY_VALUE(last) = '5' THEN 2 ELSE 5 END AS INTEGER) AS meta_entries,
             CAST(CASE WHEN ANY_VALUE(last) = '1' THEN 0 ELSE COUNT(*) END AS INTEGER) AS data_points
       FROM documents_flat GROUP BY seccion"""
)


def shapes(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.get("MetaData", F.lit(0))["Codigo"].alias("codigo"),
        F.size("MetaData").alias("meta_entries"),
        F.size("Data").alias("data_points"),
    )


@query("scan_nested_json", SHAPES)
def scan_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes(documents(spark, sf_dir))


def land_arrays(spark: SparkSession, sf_dir: str, compression: str) -> str:
    """Statistical documents as published: each file is one array over many lines."""
    path = new_path(spark, "arrays")
    texts = t.series_documents(spark, sf_dir).select(
        F.floor(F.col("MetaData")[0]["Codigo"].cast("bigint") / 512).alias("file"),
        F.to_json(F.struct("MetaData", "Data"), {"pretty": "true"}).alias("text"),
    )
    first = F.row_number().over(Window.partitionBy("file").orderBy("text")) == 1
    lines = texts.withColumn("text", F.concat(F.when(first, "[").otherwise(","), "text")).withColumn("place", F.lit(0))
    ends = texts.select("file", F.lit("]").alias("text"), F.lit(1).alias("place")).distinct()
    ordered = lines.unionByName(ends).repartition("file").sortWithinPartitions("file", "place", F.col("text").startswith(","))
    ordered.drop("place").write.partitionBy("file").option("compression", compression).text(path)
    return path


@query("scan_json_arrays", SHAPES)
def scan_json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one array over many lines each."""
    return shapes(series.read_documents(spark, land_arrays(spark, sf_dir, "none")))


@query(
    "scan_json_arrays_packed",
    statement(
        f"""SELECT seccion AS codigo, fecha, TRY_CAST(valor AS DOUBLE) AS valor FROM documents_flat
            WHERE last <> '1' AND {INCOME_FILTER}"""
    ),
)
def scan_json_arrays_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The income series out of gzip files that are one array each."""
    return bronze.income(spark, land_arrays(spark, sf_dir, "gzip"))


@query(
    "filter_nested_meta",
    statement(
        f"""SELECT seccion AS codigo, CAST(CASE WHEN ANY_VALUE(last) = '1' THEN 0 ELSE COUNT(*) END AS INTEGER) AS data_points
            FROM documents_flat WHERE {INCOME_FILTER} GROUP BY seccion"""
    ),
)
def filter_nested_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = series.with_meta(documents(spark, sf_dir), series.INCOME_SERIES)
    return kept.select(F.col("MetaData")[0]["Codigo"].alias("codigo"), F.size("Data").alias("data_points"))


@query("lateral_unnest", statement("SELECT seccion AS codigo, fecha, valor FROM documents_flat WHERE last <> '1'"))
def lateral_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.data_points(documents(spark, sf_dir))


@query(
    "json_series_extract",
    statement(
        f"""SELECT seccion AS codigo, fecha, TRY_CAST(valor AS DOUBLE) AS valor FROM documents_flat
            WHERE last <> '1' AND {INCOME_FILTER}"""
    ),
)
def json_series_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.extract_series(documents(spark, sf_dir), series.INCOME_SERIES)


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders")
    t.load(spark, sf_dir, "orders").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "scan_zone_geometry",
    statement(
        """SELECT level, zone AS distrito_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, geom AS geometria
           FROM zone_points JOIN outlines USING (zone),
             (VALUES ('distritos'), ('gaus'), ('municipios')) l(level)"""
    ),
)
def scan_zone_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three levels, each a centroid and an outline table."""
    base = new_path(spark, "zones")
    levels = []
    for level, fmt in zip(geometry.LEVELS, ("csv", "json", "parquet"), strict=True):
        for kind, table in (("points", t.centroid_table), ("outlines", t.outline_table)):
            writer = table(spark, sf_dir).write.format(fmt)
            if fmt == "csv":
                writer = writer.option("header", True).option("sep", "|")
            writer.save(f"{base}/{level}/{kind}")
        points = geometry.centroids(geometry.read_zone_table(spark, f"{base}/{level}/points", fmt))
        drawn = geometry.outlines(geometry.read_zone_table(spark, f"{base}/{level}/outlines", fmt))
        levels.append(points.join(drawn, "distrito_id").withColumn("level", F.lit(level)))
    found = levels[0].unionByName(levels[1]).unionByName(levels[2])
    return found.select("level", "distrito_id", "centroide.x", "centroide.y", "geometria")


def landed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "feed")
    items = t.feed_items(spark, sf_dir)
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return feed.read_feed(spark, path)


@query(
    "feed_manifest",
    statement(
        """SELECT url, "table", day FROM trip_feed
           UNION ALL SELECT link, 'bronze_distritos_nombres', CAST(NULL AS DATE) FROM feed
           WHERE title = 'nombres_distritos.csv'
           UNION ALL SELECT link, 'bronze_zona_distritos', CAST(NULL AS DATE) FROM feed
           WHERE title = 'zonificacion_distritos.zip'"""
    ),
)
def feed_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = landed_feed(spark, sf_dir)
    daily = feed.trip_files(items).select("url", "table", "day")
    titles = feed.DIMENSION_TITLES | feed.GEOMETRY_TITLES
    fixed = feed.dimension_files(items, titles).withColumn("day", F.lit(None).cast("date"))
    return daily.unionByName(fixed)


FEED_WINDOW = ("1995-01-01", "2001-12-31")


@query(
    "feed_days",
    statement(
        f"""SELECT "table", day, arg_min(url, pos) AS url FROM trip_feed
            WHERE day BETWEEN DATE '{FEED_WINDOW[0]}' AND DATE '{FEED_WINDOW[1]}' GROUP BY 1, 2"""
    ),
)
def feed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.first_file_per_day(feed.trip_files(landed_feed(spark, sf_dir)), *FEED_WINDOW)


@query(
    "load_audit",
    statement(
        """SELECT level, COUNT(*) AS expected, COUNT(found) AS found, COUNT(*) - COUNT(found) AS missing,
             COALESCE(string_agg(CASE WHEN found IS NULL THEN CAST(day AS VARCHAR) END, ',' ORDER BY day), '') AS missing_days
           FROM (SELECT day, level, found FROM order_days
                 CROSS JOIN (VALUES ('distritos'), ('gau'), ('municipios')) l(level)
                 LEFT JOIN (SELECT DISTINCT level, day, 1 AS found FROM feed) f USING (level, day))
           GROUP BY level"""
    ),
)
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed: the (level, day) of every order."""
    orders = t.load(spark, sf_dir, "orders")
    landed = orders.select(
        F.get(F.array(*map(F.lit, ("distritos", "gau", "municipios"))), (F.col("o_orderkey") % 3).cast("int")).alias("level"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return calendars.load_audit(
        calendars.days_spanned(orders, "o_orderdate"), ["distritos", "gau", "municipios"], landed
    )


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendars.days_spanned(t.load(spark, sf_dir, "orders"), "o_orderdate")
    return calendars.calendar(days, t.holidays(spark, sf_dir))


@query("calendar_gen", statement("SELECT * FROM calendar"))
def calendar_gen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_calendar(spark, sf_dir)


@query("calendar_gen_sparse", statement("SELECT * FROM calendar WHERE es_festivo = 1 OR es_fin_de_semana = 1"))
def calendar_gen_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.special_days(order_calendar(spark, sf_dir))


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("project_rename", statement("SELECT * FROM legs"))
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = t.legs(spark, sf_dir).select(*(F.col(new).alias(old) for old, new in TRIP_FIELDS.items()))
    return filters.renamed(published, TRIP_FIELDS)


@query(
    "zone_ring_vertices",
    statement(
        """SELECT zone AS zone_id, CAST(ring AS INTEGER) AS ring, CAST(seq AS INTEGER) AS seq,
             CAST(x + half * sx AS DOUBLE) AS x, CAST(y + half * sy AS DOUBLE) AS y
           FROM zone_points, (VALUES (0, 900), (1, 300)) r(ring, half),
             (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1), (4, -1, -1)) c(seq, sx, sy)"""
    ),
)
def zone_ring_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wkt.ring_vertices(t.outline_table(spark, sf_dir), "ID", "geom")


@query("zone_rings_to_text", statement("SELECT zone AS zone_id, geom AS geom_wkt FROM outlines"))
def zone_rings_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wkt.rings_to_text(wkt.ring_vertices(t.outline_table(spark, sf_dir), "ID", "geom"))
