"""Loads driven by change: only days whose landed rows differ are conformed and summed again.

A ledger keeps, for each day, fingerprints of its landed rows and of the zone map they were recoded
with. A day is changed if its fingerprint differs from the ledger's, if the ledger does not know it,
or if it has no rows any more. The ledger is written after the rows: a load that fails in between is
done again and gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.operators import aggregates, loads
from corridor.plans import silver
from corridor.session import settle


# Landed rows one task recodes and sums; codes with several targets make them a few times as many.
ROWS_A_PIECE = 500_000


def _fingerprint(columns: list[str]) -> list[Column]:
    """Folds that do not depend on the order of rows, and tell repeated rows apart by their number."""
    whole = F.xxhash64(*columns)
    other = F.xxhash64(F.lit("second"), *columns)
    return [
        F.count("*").alias("n_rows"), F.bit_xor(whole).alias("mixed"),
        F.sum(whole.cast("decimal(38,0)")).alias("summed"), F.sum(other.cast("decimal(38,0)")).alias("summed_too"),
    ]


def day_fingerprints(rows: DataFrame, column: str = "date", basis: DataFrame | None = None) -> DataFrame:
    """(day, n_rows, mixed, summed, summed_too, basis): one row for each day of ``rows``.

    ``basis`` is a table the rows' results depend on besides the rows; its own fingerprint stands with
    every day. Rows without a day belong to none and are left out.
    """
    days = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("day")).agg(*_fingerprint(rows.columns))
    if basis is None:
        return days.withColumn("basis", F.lit(None).cast("string"))
    # one row
    known = basis.agg(*_fingerprint(basis.columns)).first()
    return days.withColumn("basis", F.lit("/".join(str(v) for v in known)))


def changed_days(now: DataFrame, ledger: DataFrame) -> list[str]:
    """Days that differ from the ledger, are new, or are no more; as many as days at most."""
    facts = ["n_rows", "mixed", "summed", "summed_too", "basis"]
    joined = now.alias("n").join(ledger.alias("l"), "day", "full_outer")
    same = F.lit(True)
    for fact in facts:
        same = same & F.col(f"n.{fact}").eqNullSafe(F.col(f"l.{fact}"))
    # a missing side has no number of rows, which no day of rows lacks
    return sorted(str(row[0]) for row in joined.filter(~same).select("day").collect())


def _ledger(spark: SparkSession, table: str, like: DataFrame) -> DataFrame:
    return loads.create_if_absent(loads.empty_like(like), table)


def refresh_trips(bronze: DataFrame, mapping: DataFrame, table: str, ledger: str) -> list[str]:
    """Bring the silver trips of changed days up to date; returns those days.

    The landed rows are read once for the fingerprints and twice more for the changed days alone, to cut
    ranges and to fill them, with a filter on the day that a table partitioned by it answers by its folders.
    They are shuffled once.
    """
    spark = bronze.sparkSession
    needed = bronze.select("date", "period", "origin", "destination", "travels", "travels_km")
    now = settle(day_fingerprints(needed, "date", mapping), "fingerprints")
    days = changed_days(now, _ledger(spark, ledger, now))
    part = needed.filter(F.col("date").isin([F.lit(day).cast("date") for day in days])) if days else loads.empty_like(needed)
    landed = now.filter(F.col("day").isin([F.lit(day).cast("date") for day in days])).agg(F.sum("n_rows")).first()[0] or 0
    pieces = max(spark.sparkContext.defaultParallelism, -(-landed // ROWS_A_PIECE))
    rows = silver.trips_by_day(part, mapping, pieces)
    loads.create_if_absent(loads.empty_like(rows), table, ["date"])
    if days:
        loads.replace_days(rows, table, days, placed=True)
        loads.replace_table(now, ledger)
    return days


def refresh_partials(trips: DataFrame, days: list[str], table: str, start: str, end: str) -> list[int]:
    """Bring the stored weekly partial sums up to date after changes on ``days``; returns the weeks done again.

    A week any changed day falls in is summed anew from all its trips; a week that has none any more
    goes. Days outside ``start`` to ``end`` belong to no week.
    """
    spark = trips.sparkSession
    first = F.lit(start).cast("date")
    loads.create_if_absent(loads.empty_like(aggregates.weekly_partials(trips, start, end)), table, ["batch"])
    if not days:
        return []
    week = F.floor(F.datediff("date", first) / 7)
    listed = spark.range(1).select(F.explode(F.lit(days)).alias("day"))
    asked = listed.select(F.col("day").cast("date").alias("date")).filter(F.col("date").between(first, F.lit(end).cast("date"))).select(week.alias("batch")).distinct()
    weeks = sorted(row[0] for row in asked.collect())  # at most as many as days
    rows = aggregates.weekly_partials(trips.filter(week.isin(weeks)), start, end)
    loads.replace_partitions(rows, table, weeks, "batch")
    return weeks
