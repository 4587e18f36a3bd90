"""Global percent rank, spread over the cluster.

``percent_rank() over (order by v)`` has no partition key, so Spark would sort
every row in one task. Here rows fold to (value, count) first, the distinct
values are cut into ranges at approximate quantiles, and each range is ranked
on its own from an offset. The cuts only balance the work: any cuts give the
same, exact ranks.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.session import settle

VALUES_PER_RANGE = 100_000
MOST_RANGES = 1024


def _placed_counts(df: DataFrame, value: Column, ranges: int | None) -> DataFrame:
    """(value, rows, _range): each distinct value, how many rows hold it, and
    the range it falls in. NULL has a range of its own, the last.

    The number of ranges follows from the number of distinct values. Reading
    the result again gives the same rows, however often a lost task is rerun:
    the counts are a written table and the cuts are literals.
    """
    values = df.select(value.cast("double").alias("value"))
    counted = settle(values.groupBy("value").agg(F.count("*").alias("rows")), "value_counts")
    if ranges is None:
        ranges = min(MOST_RANGES, ceil(counted.count() / VALUES_PER_RANGE))
    cuts: list[float] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = counted.agg(F.percentile_approx("value", shares, 10 * MOST_RANGES).alias("cuts")).first()["cuts"] or []
    return counted.withColumn("_range", _range_of("value", sorted(set(cuts))))


def value_ranks(df: DataFrame, value: Column, ranges: int | None = None) -> DataFrame:
    """(value, rows, rank, total): each distinct value, how many rows hold it,
    the 1-based rank they share, and the row count. NULL ranks last."""
    return _ranked(_placed_counts(df, value, ranges))


def _ranked(placed: DataFrame) -> DataFrame:
    sizes = placed.groupBy("_range").agg(F.sum("rows").alias("_size"))
    # at most ranges + 1 rows, so this unpartitioned window stays tiny
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("total"),
    )
    ranked = placed.join(F.broadcast(starts), "_range")  # as many rows as there are ranges
    return ranked.select("value", "rows", (F.col("_before") + _earlier() + 1).alias("rank"), "total")


def _earlier() -> Column:
    """Rows with a smaller value inside the same range."""
    inside = Window.partitionBy("_range").orderBy(F.col("value").asc_nulls_last())
    return F.coalesce(F.sum("rows").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _range_of(value: str, cuts: list[float]) -> Column:
    """The number of cuts at or below the value; NULL gets a range of its own.

    A binary search that folds over its step sizes, with the cuts as one constant
    array: the expression has the same size for any number of cuts.
    """
    if not cuts:
        return F.when(F.col(value).isNull(), 1).otherwise(0)
    steps = [1 << bit for bit in reversed(range(len(cuts).bit_length()))]

    def step(found: Column, size: Column) -> Column:
        # past the end of the array the cut is NULL, and the step is not taken
        return F.when(F.get(F.lit(cuts), found + size - 1) <= F.col(value), found + size).otherwise(found)

    return F.when(F.col(value).isNull(), len(cuts) + 1).otherwise(
        F.aggregate(F.lit(steps), F.lit(0), step)
    )


def _percent(rank: Column, total: Column) -> Column:
    return F.when(total > 1, (rank - 1) / F.nullif(total - 1, F.lit(0))).otherwise(F.lit(0.0))


def percent_rank(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add each row's percent rank by ``value``, NULLs last.

    Rows without a value share one rank, known from two counts: they go around
    the join, where they would all meet on one key.
    """
    placed = _placed_counts(df, value, None)
    counts = placed.agg(F.sum("rows").alias("total"), F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))).alias("known"))
    total, known = counts.first()
    last = (known or 0) / (total - 1) if total and total > 1 else 0.0
    ranks = _ranked(placed.filter(F.col("value").isNotNull())).select(
        F.col("value").alias("_value"), _percent(F.col("rank"), F.lit(total)).alias(name)
    )
    keyed = df.withColumn("_value", value.cast("double"))
    met = keyed.filter(F.col("_value").isNotNull()).alias("l").join(ranks.alias("r"), F.col("l._value") == F.col("r._value"))
    found = met.select(*(F.col(f"l.{column}") for column in df.columns), F.col(f"r.{name}"))
    missing = keyed.filter(F.col("_value").isNull()).drop("_value")
    return found.unionByName(missing.withColumn(name, F.lit(last)))


def percent_rank_band(
    df: DataFrame, value: Column, low: float, high: float, ranges: int | None = None
) -> DataFrame:
    """Rows whose percent rank lies in [low, high].

    Equal values share a rank, so the band is an interval of values: only its
    two ends are looked up, and no row needs its own rank or a join. The range
    sizes tell which ranges hold an end; only those are sorted.
    """
    placed = _placed_counts(df, value, ranges)
    summary = (
        placed.groupBy("_range")
        .agg(F.sum("rows").alias("size"), F.min("value").alias("first"), F.max("value").alias("last"))
        .orderBy("_range")
        .collect()  # as many rows as there are ranges
    )
    total = sum(part["size"] for part in summary)

    def percent(rank: int) -> float:
        return (rank - 1) / (total - 1) if total > 1 else 0.0

    ends: list[float] = []
    cut_ranges: dict[int, int] = {}
    nulls_inside = False
    before = 0
    for part in summary:
        lowest, highest = percent(before + 1), percent(before + part["size"])
        if part["first"] is None:
            nulls_inside = low <= lowest <= high
        elif low <= lowest and highest <= high:
            ends += [part["first"], part["last"]]
        elif highest >= low and lowest <= high:
            cut_ranges[part["_range"]] = before
        before += part["size"]
    if cut_ranges:
        offset = F.coalesce(*(F.when(F.col("_range") == part, start) for part, start in cut_ranges.items()))
        ranked = placed.filter(F.col("_range").isin(list(cut_ranges))).select(
            "value", _percent(offset + _earlier() + 1, F.lit(total)).alias("pr")
        )
        found = ranked.filter(F.col("pr").between(low, high)).agg(F.min("value"), F.max("value")).first()
        ends += [end for end in found if end is not None]
    number = value.cast("double")
    kept = number.isNull() if nulls_inside else F.lit(False)
    if ends:
        kept = kept | F.coalesce(number.between(min(ends), max(ends)), F.lit(False))
    return df.filter(kept)
