"""Calendars and the expected-versus-landed report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions.scalars import is_weekend


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day of [start, end]."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(span).alias("day"))


def days_spanned(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest date of a column."""
    ends = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("day"))


def calendar(days_table: DataFrame, holidays: DataFrame) -> DataFrame:
    """(fecha, es_festivo, es_fin_de_semana), flags as 0 or 1.

    ``days_table`` has a ``day`` column; ``holidays`` a ``date`` column.
    """
    marked = holidays.select(F.col("date").alias("day")).distinct().withColumn("hit", F.lit(1))
    return days_table.join(marked, "day", "left").select(
        F.col("day").alias("fecha"),
        F.coalesce("hit", F.lit(0)).alias("es_festivo"),
        is_weekend(F.col("day")).cast("int").alias("es_fin_de_semana"),
    )


def special_days(calendar_table: DataFrame) -> DataFrame:
    """Only the holidays and weekend days."""
    return calendar_table.filter((F.col("es_festivo") == 1) | (F.col("es_fin_de_semana") == 1))


def load_audit(days_table: DataFrame, levels: list[str], landed: DataFrame) -> DataFrame:
    """Per level: files expected, found, missing, and the missing dates.

    ``landed`` has (level, day); the list of missing dates is at most as long
    as ``days_table``.
    """
    expected = days_table.select(
        "day", F.explode(F.array(*(F.lit(level) for level in levels))).alias("level")
    )
    seen = landed.select("level", "day").distinct().withColumn("found", F.lit(1))
    checked = expected.join(seen, ["level", "day"], "left")
    absent = F.when(F.col("found").isNull(), F.col("day").cast("string"))
    return checked.groupBy("level").agg(
        F.count("*").alias("expected"),
        F.count("found").alias("found"),
        (F.count("*") - F.count("found")).alias("missing"),
        F.array_join(F.sort_array(F.collect_list(absent)), ",").alias("missing_days"),
    )
