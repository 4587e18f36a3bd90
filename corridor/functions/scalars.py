"""Column expressions whose edge cases differ from Spark's own defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _strictly(text: Column, parsed: Column, what: str) -> Column:
    bad = text.isNotNull() & parsed.isNull()
    message = F.concat(F.lit(f"not a {what}: "), text)
    return F.when(bad, F.raise_error(message).cast("date")).otherwise(parsed)


def compact_date(text: Column, lenient: bool = False) -> Column:
    """``20230131`` to a date; bad text fails the job, or is NULL if lenient."""
    parsed = F.try_to_date(text, "yyyyMMdd")
    return parsed if lenient else _strictly(text, parsed, "yyyyMMdd date")


def iso_date(text: Column, lenient: bool = False) -> Column:
    """``2023-01-31`` to a date; bad text fails the job, or is NULL if lenient."""
    parsed = F.try_to_date(text, "yyyy-MM-dd")
    return parsed if lenient else _strictly(text, parsed, "yyyy-MM-dd date")


def timestamp_text_date(text: Column) -> Column:
    """The calendar date written at the start of an ISO timestamp text."""
    return text.cast("date")


def weekday_from_sunday(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def day_type(day: Column) -> Column:
    return F.when(is_weekend(day), "Weekend").otherwise("Weekday")


def number_or_null(text: Column) -> Column:
    return text.try_cast("double")


def rounded_int(value: Column) -> Column:
    """Nearest integer, halves to the even one; out of range fails under ANSI."""
    return F.rint(value).cast("int")


def rounded_bigint(value: Column) -> Column:
    return F.rint(value).cast("bigint")


def rounded(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back, all in DOUBLE.

    Spark's own two-argument ``round`` works on the decimal text of the number
    and so turns 1.005 into 1.01; scaling in DOUBLE gives 1.0.
    """
    scale = float(10**digits)
    return F.round(value * scale, 0) / scale


def flag(value: Column) -> Column:
    """'0'/'1' or 0/1 to a boolean."""
    return value.cast("boolean")


def flag_is_one(value: Column) -> Column:
    return value.cast("int") == 1


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def at_least(value: Column, floor: float) -> Column:
    """A NULL becomes the floor."""
    return F.greatest(value, F.lit(floor))


def raised_to(value: Column, floor: float) -> Column:
    """Values under the floor are raised to it; a NULL stays NULL."""
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def item(values: Column, position: int) -> Column:
    """The element at a 1-based position, NULL when there is none."""
    return F.get(values, F.lit(position - 1))
