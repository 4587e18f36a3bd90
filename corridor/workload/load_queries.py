"""Load strategies, run on tables in a fresh database in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.operators import loads
from corridor.plans import bronze, refresh, silver
from corridor.schemas import TRIP_DIMENSIONS
from corridor.session import new_database, new_path, settle
from corridor.sources import feed
from corridor.streaming.daily import ingest_days
from corridor.streaming.published import ingest_published, missing_parts
from corridor.workload import tables as t
from corridor.workload.oracle_tables import statement
from corridor.workload.registry import query

ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "orders")


def _order_rows(spark: SparkSession, sf_dir: str, where: str = "true", price: str = "o_totalprice") -> DataFrame:
    return _orders(spark, sf_dir).filter(where).selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", f"{price} AS o_totalprice"
    )


@query("sink_replace", f"SELECT {ORDER} FROM orders WHERE o_orderstatus <> 'F'")
def sink_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_database(spark)}.orders"
    loads.replace_table(_order_rows(spark, sf_dir), table)
    return loads.replace_table(_order_rows(spark, sf_dir, "o_orderstatus <> 'F'"), table)


@query("sink_if_absent", f"SELECT {ORDER} FROM orders")
def sink_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_database(spark)}.orders"
    loads.create_if_absent(_order_rows(spark, sf_dir), table)
    return loads.create_if_absent(_order_rows(spark, sf_dir, "o_orderstatus = 'F'"), table)


@query("sink_empty_like", f"SELECT {ORDER} FROM orders")
def sink_empty_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty clone, filled by name from rows in another column order."""
    rows = _order_rows(spark, sf_dir)
    table = f"{new_database(spark)}.orders"
    loads.replace_table(loads.empty_like(rows), table)
    return loads.append_by_name(rows.select(*reversed(rows.columns)), table)


@query(
    "sink_append_positional",
    f"SELECT {ORDER} FROM orders UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice "
    "FROM orders WHERE o_orderstatus = 'F'",
)
def sink_append_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns land by place: the swapped keys end up swapped."""
    rows = _order_rows(spark, sf_dir)
    table = f"{new_database(spark)}.orders"
    loads.replace_table(rows, table)
    closed = rows.filter("o_orderstatus = 'F'")
    return loads.append_by_position(closed.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"), table)


REPLACED = ["2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"]


@query(
    "sink_replace_day",
    statement(
        """SELECT event_id, hour, value, date FROM activity
           WHERE date NOT BETWEEN DATE '2024-01-03' AND DATE '2024-01-06'
           UNION ALL SELECT event_id, hour, value + 1, date FROM activity
           WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-05' AND hour < 12"""
    ),
)
def sink_replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four days are replaced: three by fewer rows, one by none at all."""
    events = t.activity(spark, sf_dir).select("event_id", "hour", "value", "date")
    table = f"{new_database(spark)}.activity"
    loads.replace_table(events, table, ["date"])
    again = events.filter("hour < 12 AND date <> DATE '2024-01-06'").withColumn(
        "value", (F.col("value") + 1).cast("decimal(18,2)")
    )
    return loads.replace_days(again, table, REPLACED)


@query(
    "upsert_by_key",
    f"""SELECT {ORDER} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _order_rows(spark, sf_dir, "o_orderdate < DATE '1999-01-01'")
    source = _order_rows(spark, sf_dir, "o_orderdate >= DATE '1998-01-01'", "o_totalprice + 1")
    table = f"{new_database(spark)}.orders"
    loads.replace_table(target, table)
    return loads.upsert_into(table, source, ["o_orderkey"])


@query(
    "upsert_composite_2",
    statement(
        """SELECT seccion AS codigo, year || '-01-01T00:00:00.000+01:00' AS fecha,
             CAST(income AS DOUBLE) + CASE WHEN year >= 1997 THEN 1 ELSE 0 END AS valor FROM section_years"""
    ),
)
def upsert_composite_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    income = settle(t.section_series(spark, sf_dir, "income"), "income")
    target = income.filter("fecha < '1999'")
    source = income.filter("fecha >= '1997'").withColumn("valor", F.col("valor") + 1)
    table = f"{new_database(spark)}.income"
    loads.replace_table(target, table)
    return loads.upsert_into(table, source, ["codigo", "fecha"])


UPSERT_13 = """
    SELECT {dims}, travels, round(travels_km, 2) AS travels_km FROM busy_bronze WHERE date < DATE '1998-01-01'
    UNION ALL SELECT {dims}, travels + 1, round(travels_km, 2) FROM busy_bronze WHERE date >= DATE '1998-01-01'
    UNION ALL SELECT {dims}, travels, round(travels_km, 2) FROM busy_bronze
    WHERE gender IS NULL AND date >= DATE '1998-01-01' AND date < DATE '1999-01-01'
""".format(dims=", ".join(TRIP_DIMENSIONS))


@query("upsert_composite_13", statement(UPSERT_13))
def upsert_composite_13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing gender is part of the key and matches nothing: such rows of the
    shared year appear twice."""
    trips = settle(_bronze(spark, sf_dir), "bronze_trips")
    target = trips.filter("date < DATE '1999-01-01'")
    source = trips.filter("date >= DATE '1998-01-01'").withColumn("travels", F.col("travels") + 1)
    table = f"{new_database(spark)}.bronze_trips"
    loads.replace_table(target, table)
    merged = loads.upsert_into(table, source, TRIP_DIMENSIONS)
    return merged.withColumn("travels_km", F.round("travels_km", 2))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.busy_legs(spark, sf_dir).groupBy(*TRIP_DIMENSIONS).agg(
        F.sum("travels").alias("travels"), F.sum("travels_km").alias("travels_km")
    )


@query(
    "insert_only_new",
    """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
       UNION ALL (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'
       EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')""",
)
def insert_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = t.load(spark, sf_dir, "lineitem")
    target = items.filter("l_shipdate < DATE '1998-01-01'").select("l_partkey", "l_suppkey")
    source = items.filter("l_shipdate >= DATE '1997-01-01'").select("l_partkey", "l_suppkey")
    return loads.insert_only_new(target, source)


@query("write_parquet_provenance", "SELECT o_orderkey, o_totalprice, true AS has_source, true AS stamped FROM orders")
def write_parquet_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders")
    loads.with_provenance(_orders(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path).select(
        "o_orderkey",
        "o_totalprice",
        F.col("source_url").endswith("orders.parquet").alias("has_source"),
        (F.col("ingestion_ts") <= F.current_timestamp()).alias("stamped"),
    )


@query(
    "write_partition_tree",
    statement(
        """SELECT event_id, hour, value, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
             CAST(day(date) AS INTEGER) AS day FROM activity"""
    ),
)
def write_partition_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tree")
    loads.write_day_tree(t.activity(spark, sf_dir), path)
    return spark.read.parquet(path).select("event_id", "hour", "value", "year", "month", "day")


@query(
    "skip_already_loaded",
    statement("""SELECT url, "table", day FROM trip_feed WHERE day >= DATE '1998-01-01' """),
)
def skip_already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = feed.trip_files(t.feed_items(spark, sf_dir)).select("url", "table", "day")
    ledger = new_path(spark, "ledger")
    manifest.filter("day < DATE '1998-01-01'").write.parquet(ledger)
    return loads.not_yet_loaded(manifest, spark.read.parquet(ledger), ["url"])


@query(
    "write_clustered",
    statement("SELECT date, period, origin_id, destination_id, travels, round(travels_km, 2) AS travels_km FROM silver_trips"),
)
def write_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "clustered")
    mapping = silver.district_map(silver.relation(t.relation(spark, sf_dir)))
    trips = silver.trips(t.legs(spark, sf_dir), mapping)
    loads.clustered(trips, "date", "origin_id", "destination_id").write.parquet(path)
    return spark.read.parquet(path).withColumn("travels_km", F.round("travels_km", 2))


@query("stream_daily_ingest", statement("SELECT event_id, hour, value, date FROM activity"))
def stream_daily_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of daily files; the second adds days and completes one."""
    base = new_path(spark, "stream")
    landing, table = f"{base}/landing", f"{new_database(spark)}.activity"
    events = t.activity(spark, sf_dir).select("event_id", "hour", "value", "date")
    loads.create_if_absent(loads.empty_like(events), table, ["date"])
    late = F.col("date") > F.lit("2024-01-15").cast("date")
    half = (F.col("date") == F.lit("2024-01-15").cast("date")) & (F.col("hour") >= 12)
    for arrival in (events.filter(~late & ~half), events.filter(late | half)):
        arrival.write.mode("append").partitionBy("date").option("header", True).csv(landing)
        ingest_days(
            spark, landing, events.schema, table, f"{base}/checkpoint", files_per_batch=20, header=True
        )
    return spark.table(table).select("event_id", "hour", "value", "date")


QUARTERS = ("actividad_0", "actividad_1", "actividad_2", "actividad_3")


def _publish(events: DataFrame, folder: str) -> None:
    """Files under flat names, one for each day and quarter of a day."""
    spark = events.sparkSession
    written = new_path(spark, "published")
    name = F.concat(F.date_format("date", "yyyyMMdd"), F.lit("_actividad_"), F.floor(F.col("hour") / 6))
    named = events.withColumn("name", name).drop("date").repartition("name")
    named.write.partitionBy("name").option("header", True).csv(written)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for row in spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(written).select("path", "name").collect():
        files.rename(hadoop.Path(row["path"]), hadoop.Path(f"{folder}/{row['name']}.csv"))


def _published_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quarters of days arrive twice: late ones complete their day, others never come. Table and ledger."""
    base, database = new_path(spark, "flat"), new_database(spark)
    table, ledger = f"{database}.activity", f"{database}.ledger"
    events = settle(t.activity(spark, sf_dir).select("event_id", "hour", "value", "date"), "events")
    loads.create_if_absent(loads.empty_like(events), table, ["date"])
    quarter, day = F.floor(F.col("hour") / 6), F.dayofmonth("date")
    never = (day % 7 == 5) & (quarter == 3)
    late = (day % 7 == 3) & (quarter == 2)
    schema = events.drop("date").schema
    for arrival in (events.filter(~never & ~late), events.filter(late)):
        _publish(arrival, f"{base}/landing")
        ingest_published(
            spark, f"{base}/landing", schema, table, ledger, f"{base}/checkpoint", QUARTERS, header=True
        )
    return spark.table(table), spark.table(ledger)


@query(
    "stream_published_days",
    statement(
        """SELECT event_id, hour, value, date FROM activity WHERE day(date) % 7 <> 5
             AND date IN (SELECT date FROM activity GROUP BY date HAVING COUNT(DISTINCT hour // 6) = 4)"""
    ),
)
def stream_published_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days all of whose files have come."""
    return _published_twice(spark, sf_dir)[0].select("event_id", "hour", "value", "date")


@query(
    "stream_missing_parts",
    statement(
        """SELECT date AS day, 'actividad_' || q AS part
           FROM (SELECT DISTINCT date FROM activity), (SELECT unnest(range(4)) AS q)
           WHERE (day(date) % 7 = 5 AND q = 3)
              OR (date, q) NOT IN (SELECT (date, hour // 6) FROM activity)"""
    ),
)
def stream_missing_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger still waits for."""
    return missing_parts(_published_twice(spark, sf_dir)[1], QUARTERS)


@query(
    "prod_bronze_trips",
    statement(f"SELECT {', '.join(TRIP_DIMENSIONS)}, travels, round(travels_km, 2) AS travels_km FROM weekly_bronze"),
)
def prod_bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table after loading every day that was published, all in one job."""
    table = f"{new_database(spark)}.trips"
    bronze.create_trips(spark, table)
    # as many as days
    days = [str(row[0]) for row in t.weekly_legs(spark, sf_dir).select("date").distinct().collect()]
    loaded = bronze.load_trips(t.raw_trips(spark, sf_dir, weekly=True), table, days)
    return loaded.withColumn("travels_km", F.round("travels_km", 2))


def _two_silver_loads(spark: SparkSession, sf_dir: str) -> tuple[str, list[str], list[str]]:
    """Silver trips loaded twice from what had landed by then: the table, and the days each load did."""
    database = new_database(spark)
    mapping = silver.district_map(silver.relation(t.relation(spark, sf_dir)))
    table, ledger = f"{database}.silver_trips", f"{database}.silver_ledger"
    first = refresh.refresh_trips(t.earlier_legs(spark, sf_dir), mapping, table, ledger)
    second = refresh.refresh_trips(t.later_legs(spark, sf_dir), mapping, table, ledger)
    return table, first, second


#: Days that came, changed or went between the two loads.
CHANGED = "((date - DATE '1995-01-02') // 7 % 11 = 5 OR (date - DATE '1995-01-02') // 7 % 9 = 0)"


@query(
    "prod_trips_refreshed",
    statement(
        f"""SELECT date, period, origin_id, destination_id, travels, round(travels_km, 2) AS travels_km,
            {CHANGED} AS loaded_again FROM later_silver"""
    ),
)
def prod_trips_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips after a second load that does only the days that differ."""
    table, _, second = _two_silver_loads(spark, sf_dir)
    again = F.col("date").isin([F.lit(day).cast("date") for day in second])
    return spark.table(table).select(
        "date", "period", "origin_id", "destination_id", "travels", F.round("travels_km", 2).alias("travels_km"),
        again.alias("loaded_again"),
    )


WEEKS = ("1995-01-01", "2001-12-31")


@query(
    "agg_partials_refreshed",
    statement(
        f"""SELECT CAST(floor((date - DATE '{WEEKS[0]}') / 7) AS BIGINT) AS batch, origin_id, destination_id,
            CAST(SUM(travels) AS BIGINT) AS partial_trips
        FROM later_silver WHERE date BETWEEN DATE '{WEEKS[0]}' AND DATE '{WEEKS[1]}' GROUP BY 1, 2, 3"""
    ),
)
def agg_partials_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly partial sums stored after the first load and brought up to date after the second."""
    database = new_database(spark)
    mapping = silver.district_map(silver.relation(t.relation(spark, sf_dir)))
    table, ledger, partials = (f"{database}.{name}" for name in ("silver_trips", "silver_ledger", "partials"))
    for landed in (t.earlier_legs(spark, sf_dir), t.later_legs(spark, sf_dir)):
        days = refresh.refresh_trips(landed, mapping, table, ledger)
        refresh.refresh_partials(spark.table(table), days, partials, *WEEKS)
    return spark.table(partials).select("batch", "origin_id", "destination_id", "partial_trips")


@query(
    "load_requested_days",
    statement(f"""SELECT {', '.join(TRIP_DIMENSIONS)}, travels, round(travels_km, 2) AS travels_km FROM weekly_bronze
                  WHERE (date - DATE '1995-01-02') // 7 % 2 = 0"""),
)
def load_requested_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other week's files, found through a manifest; dates in the other files cannot be read."""
    path, database = new_path(spark, "published"), new_database(spark)
    raw = t.raw_trips(spark, sf_dir, weekly=True)
    monday = F.to_date("fecha", "yyyyMMdd")
    skipped = F.floor(F.datediff(monday, F.lit("1995-01-02").cast("date")) / 7) % 2 == 1
    spoilt = F.when(skipped, F.lit("no date")).otherwise(F.col("fecha"))
    published = raw.withColumn("week", monday).withColumn("fecha", spoilt)
    published.repartition("week").write.partitionBy("week").option("header", True).option("sep", "|").csv(path)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    manifest = settle(listing.select(F.col("path").alias("url"), F.col("week").alias("day")), "manifest")
    wanted = manifest.filter(F.floor(F.datediff("day", F.lit("1995-01-02").cast("date")) / 7) % 2 == 0).select("day").distinct()
    table = f"{database}.trips"
    bronze.create_trips(spark, table)
    loaded = bronze.load_requested(spark, manifest, table, [str(row[0]) for row in wanted.collect()])
    return loaded.withColumn("travels_km", F.round("travels_km", 2))
