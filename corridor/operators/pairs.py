"""Zone pairs and their distances."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.functions.spatial import planar_distance
from corridor.operators.setops import mirrored

ZONES_PER_BLOCK = 256
MOST_TASKS = 20_000


def unordered_pairs(zones: DataFrame, key: str, carried: list[str], blocks: int | None = None) -> DataFrame:
    """Every pair with ``a.key < b.key``: columns a_<name>, b_<name>.

    The zones are hashed into blocks and each zone is copied once per block, so
    that every pair of blocks is one key of an ordinary equi-join. The result
    has n(n-1)/2 rows by definition; no task sees more than one block pair, and
    neither side has to fit in one executor's memory.
    """
    if blocks is None:
        blocks = max(1, ceil(zones.count() / ZONES_PER_BLOCK))
    names = [key, *carried]
    block = F.pmod(F.xxhash64(key), F.lit(blocks))
    every = F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")
    low = zones.select(
        *(F.col(name).alias(f"a_{name}") for name in names), block.alias("_i"), F.explode(every).alias("_j")
    )
    high = zones.select(
        *(F.col(name).alias(f"b_{name}") for name in names), F.explode(every).alias("_i"), block.alias("_j")
    )
    # the input is small and the output is not: a fixed number of tasks keeps
    # adaptive execution from folding the block pairs into one
    tasks = min(blocks * blocks, MOST_TASKS)
    low, high = (side.repartition(tasks, "_i", "_j") for side in (low, high))
    met = low.join(high.hint("shuffle_hash"), ["_i", "_j"]).filter(F.col(f"a_{key}") < F.col(f"b_{key}"))
    return met.drop("_i", "_j")


def pair_distances(zones: DataFrame, distance=planar_distance, mirror: bool = True) -> DataFrame:
    """(origin_id, destination_id, distance_meters) of all zone pairs, without
    the diagonal. ``zones`` has distrito_id and centroide (x, y)."""
    flat = _flat(zones)
    pairs = unordered_pairs(flat, "distrito_id", ["x", "y"])
    half = pairs.select(
        F.col("a_distrito_id").alias("origin_id"),
        F.col("b_distrito_id").alias("destination_id"),
        distance(F.col("a_x"), F.col("a_y"), F.col("b_x"), F.col("b_y")).alias("distance_meters"),
    )
    return mirrored(half, "origin_id", "destination_id") if mirror else half


def with_distances(od: DataFrame, zones: DataFrame) -> DataFrame:
    """Add distance_meters to the pairs of ``od``, looking up both centroids.

    Same rows as a join to the full distance table (pairs within one zone and
    unknown zones drop out, a zone listed twice counts twice), but only pairs
    that occur are measured.
    """
    flat = _flat(zones)
    start = flat.select(F.col("distrito_id").alias("origin_id"), F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    stop = flat.select(F.col("distrito_id").alias("destination_id"), F.col("x").alias("_dx"), F.col("y").alias("_dy"))
    measured = (
        od.filter(F.col("origin_id") != F.col("destination_id"))
        .join(start, "origin_id")
        .join(stop, "destination_id")
    )
    metres: Column = planar_distance(F.col("_ox"), F.col("_oy"), F.col("_dx"), F.col("_dy"))
    return measured.select(*od.columns, metres.alias("distance_meters"))


def _flat(zones: DataFrame) -> DataFrame:
    return zones.select("distrito_id", F.col("centroide.x").alias("x"), F.col("centroide.y").alias("y"))
