"""Row filters and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the columns in ``names`` under their new names, in that order."""
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))


def all_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def not_literally(df: DataFrame, column: str, text: str = "NA") -> DataFrame:
    """Drop rows holding the text; NULLs stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(text)))


def on_day(df: DataFrame, day: str, column: str = "date") -> DataFrame:
    return df.filter(F.col(column) == F.lit(day).cast("date"))


def between_days(df: DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def distinct_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.select(first, second).distinct()
