"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks; NULLs compare equal.

    Both sides fold to distinct rows before the one shuffle, so a row repeated
    a billion times travels once per task.
    """
    sides = left.withColumn("_right", F.lit(0)).unionByName(right.withColumn("_right", F.lit(1)))
    folded = sides.groupBy(*left.columns).agg(F.max("_right").alias("_right"))
    return folded.filter(F.col("_right") == 0).drop("_right")


def mirrored(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Every pair both ways round. The pairs are computed once and doubled."""
    rest = [name for name in pairs.columns if name not in (first, second)]
    both = F.array(
        F.struct(F.col(first).alias("a"), F.col(second).alias("b")),
        F.struct(F.col(second).alias("a"), F.col(first).alias("b")),
    )
    doubled = pairs.select(F.explode(both).alias("_ends"), *rest)
    return doubled.select(F.col("_ends.a").alias(first), F.col("_ends.b").alias(second), *rest)
