"""Landing: files as published, typed where a key or a date needs it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions.scalars import iso_date
from corridor.operators.aggregates import by_all_dimensions
from corridor.operators.loads import create_if_absent, replace_days
from corridor.schemas import BRONZE_TRIPS, CALENDAR, PROVINCES, RAW_TRIPS, RELATION, ZONE_NAMES, ZONE_PEOPLE
from corridor.sources import delimited, geometry, series

# The columns kept of each reference file.
DIMENSIONS = {
    "bronze_distritos_nombres": ZONE_NAMES.fieldNames(),
    "bronze_gaus_nombres": ZONE_NAMES.fieldNames(),
    "bronze_municipios_nombres": ZONE_NAMES.fieldNames(),
    "bronze_relacion_ine": RELATION.fieldNames(),
    "bronze_poblacion_distritos": ZONE_PEOPLE.fieldNames(),
    "bronze_poblacion_gaus": ZONE_PEOPLE.fieldNames(),
    "bronze_provincias": PROVINCES.fieldNames(),
}


def create_trips(spark: SparkSession, table: str) -> DataFrame:
    """The empty trip table, partitioned by date; nothing happens on a rerun."""
    return create_if_absent(spark.createDataFrame([], BRONZE_TRIPS), table, ["date"])


def load_trips(raw: DataFrame, table: str, days: list[str], lenient: bool = False) -> DataFrame:
    """Replace the given days from landed files, all days in one job."""
    return replace_days(by_all_dimensions(raw, lenient=lenient), table, days)


def load_requested(
    spark: SparkSession, files: DataFrame, table: str, days: list[str], lenient: bool = False, sep: str = "|"
) -> DataFrame:
    """Replace the given days from the files a manifest (url, day) lists for them.

    Only those files are opened, all in one job, and Spark packs small ones into one task and cuts
    large ones that are not compressed; what other days' files hold cannot fail the load. Days the
    manifest has no file for are left alone, as they have not been published; a day whose files
    hold no row of it is cleared.
    """
    asked = files.filter(F.col("day").isin([date.fromisoformat(day) for day in days]))
    # as many rows as files of the requested days
    listed = asked.select("url", F.col("day").cast("string").alias("day")).distinct().collect()
    if not listed:
        return spark.table(table)
    raw = delimited.read_lenient(spark, sorted({row["url"] for row in listed}), RAW_TRIPS, sep=sep)
    return load_trips(raw, table, sorted({row["day"] for row in listed}), lenient)


def dimension(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One of the pipe-delimited reference files."""
    return delimited.read_dimension(spark, path, DIMENSIONS[table])


def calendar(spark: SparkSession, path: str) -> DataFrame:
    """The comma-delimited holiday file."""
    texts = delimited.read_dimension(spark, path, CALENDAR.fieldNames(), sep=",")
    return texts.select(
        iso_date(F.col("fecha")).alias("fecha"),
        F.col("es_festivo").cast("int").alias("es_festivo"),
        F.col("es_fin_de_semana").cast("int").alias("es_fin_de_semana"),
    )


def income(spark: SparkSession, path: str) -> DataFrame:
    """Net income per person and section."""
    return series.extract_series(series.read_documents(spark, path), series.INCOME_SERIES)


def population(spark: SparkSession, path: str) -> DataFrame:
    """People of 16 and over per section."""
    return series.extract_series(series.read_documents(spark, path), series.POPULATION_SERIES)


def centroids(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return geometry.centroids(geometry.read_zone_table(spark, path, fmt))


def outlines(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return geometry.outlines(geometry.read_zone_table(spark, path, fmt))
