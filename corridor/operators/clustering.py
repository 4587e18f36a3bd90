"""Day patterns: standardised features, k-means, silhouette, choice of k."""

from __future__ import annotations

import json
import sys
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from math import ceil, fsum

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.functions.scalars import ratio
from corridor.session import settle

# the pandas function below travels with its job: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Seed, number of starts, most iterations of a run, and the
# numbers of clusters tried.
SEED = 42
STARTS = 10
MOST_ITERATIONS = 300
CANDIDATE_K = (3, 4)
# Coordinates are counted in these parts of one.
UNIT = 1_000_000

POINTS_PER_BLOCK = 1024
POINTS_PER_TASK = 256
MOST_TASKS = 20_000


def standardized(df: DataFrame, columns: list[str]) -> DataFrame:
    """Z-scores with the population deviation; a constant column becomes 0.

    The fitted means and deviations are two numbers per column.
    """
    fitted = df.agg(
        *(F.avg(name).alias(f"m{i}") for i, name in enumerate(columns)),
        *(F.stddev_pop(name).alias(f"s{i}") for i, name in enumerate(columns)),
    ).first()
    scores = {}
    for i, name in enumerate(columns):
        mean, deviation = fitted[f"m{i}"], fitted[f"s{i}"]
        scores[name] = (F.col(name) - mean) / deviation if deviation else F.col(name) * 0.0
    return df.withColumns(scores)


def fixed_points(df: DataFrame, columns: list[str], day: str = "date") -> DataFrame:
    """(day, v): the columns in whole millionths, so that sums over points do not depend on their order."""
    whole = ", ".join(f"CAST(round(`{name}` * {UNIT}, 0) AS BIGINT)" for name in columns)
    return df.select(day, F.expr(f"array({whole}) AS v"))


# The nearest of the centres ``cs`` to ``v`` as (squared distance, number), the first of equally near ones.
NEAREST = """array_min(transform(cs, (c, i) -> struct(
    aggregate(zip_with(v, c, (x, y) -> (x - y) * (x - y)), 0.0D, (a, b) -> a + b) AS far, i AS cluster)))"""


def _nearest(runs: list[list[list[float]]]) -> Column:
    """NEAREST for each run's centres, which are one constant."""
    return F.expr(f"transform(from_json('{json.dumps(runs)}', 'array<array<array<double>>>'), cs -> {NEAREST})")


def seeded(points: DataFrame, k: int, starts: int, seed: int, day: str = "date") -> list[list[list[int]]]:
    """Per start up to ``k`` first centres: points drawn with chances as their squared distance
    from the centres drawn before.

    A point's draw is a hash of seed, number of the centre and day, and the smallest of
    -ln(draw) / squared distance wins, so the same table gives the same centres however it is cut.
    One aggregate for each centre, for all starts at once; the driver holds k x starts points.
    """
    chosen: list[list[list[int]]] = [[] for _ in range(starts)]
    for number in range(k):
        far = "near.far" if number else "1.0D"
        # a fixed number above 0 and below 1 for each seed, number of the centre and day
        name = f"concat(start + {seed}, ':{number}:', `{day}`)"
        draw = f"(CAST(conv(substr(md5({name}), 1, 13), 16, 10) AS DOUBLE) + 0.5D) / {2**52}D"
        drawn = (
            points.select(day, "v", F.posexplode(_nearest(chosen)).alias("start", "near"))
            .filter(f"{far} > 0")
            .groupBy("start")
            .agg(F.expr(f"min(struct(-ln({draw}) / {far} AS key, `{day}` AS day, v)) AS best"))
        )
        for row in drawn.collect():
            chosen[row["start"]].append(row["best"]["v"])
    return chosen


def best_kmeans(
    points: DataFrame, ks: tuple[int, ...], starts: int = STARTS, seed: int = SEED, day: str = "date"
) -> dict[int, list[list[float]]]:
    """For each k the centres of the cheapest of several k-means runs; equal costs go to the first start.

    ``points`` come from ``fixed_points``, one row for each day, and should be a written table. Each
    round is one aggregate over the points for all runs that still move: counts and whole sums by run
    and nearest centre (equally near: the first). A centre that lost its points stays. Fewer different
    points than k give fewer centres, no points none. The driver holds the centres alone.
    """
    first = seeded(points, max(ks), starts, seed, day)
    runs = [(k, start) for k in ks for start in range(starts)]
    centres: list[list[list[float]]] = [[list(map(float, c)) for c in first[start][:k]] for k, start in runs]
    cost = [Decimal(0)] * len(runs)
    moving = [run for run, own in enumerate(centres) if own]
    width = len(centres[moving[0]][0]) if moving else 0
    for _ in range(MOST_ITERATIONS):
        if not moving:
            break
        sums = (
            points.select("v", F.posexplode(_nearest([centres[run] for run in moving])).alias("run", "near"))
            .groupBy("run", "near.cluster")
            .agg(
                F.expr(f"sum(CAST(floor(near.far / {UNIT}) AS DECIMAL(20, 0))) AS cost"),
                F.expr(f"array({', '.join(f'sum(v[{i}])' for i in range(width))}) AS total"),
                F.count("*").alias("n"),
            )
            .collect()
        )
        before = {run: centres[run] for run in moving}
        for run in moving:
            centres[run] = list(before[run])
            cost[run] = Decimal(0)
        for row in sums:
            run = moving[row["run"]]
            centres[run][row["cluster"]] = [float(total) / row["n"] for total in row["total"]]
            cost[run] += row["cost"]
        moving = [run for run in moving if centres[run] != before[run]]
    return {
        k: centres[min((run for run, (size, _) in enumerate(runs) if size == k), key=lambda run: (cost[run], run))]
        for k in ks
    }


def labelled(points: DataFrame, centres: list[list[float]], *kept: str) -> DataFrame:
    """``kept`` columns and ``prediction``, the number of the nearest centre."""
    return points.select(*kept, _nearest([centres])[0]["cluster"].alias("prediction"))


def _block_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    columns = ["point", "label", "other", "distance", "members"]
    if left.empty or right.empty:
        return pd.DataFrame(columns=columns)
    a, b = np.stack(left["v"].to_numpy()), np.stack(right["w"].to_numpy())
    labels, place = np.unique(right["other"].to_numpy(), return_inverse=True)
    member = np.eye(len(labels))[place]
    rows = max(1, 2_000_000 // b.size)
    sums = [
        np.sqrt(((a[i : i + rows, None, :] - b[None, :, :]) ** 2).sum(axis=2)) @ member
        for i in range(0, len(a), rows)
    ]
    return pd.DataFrame(
        {
            "point": np.repeat(left["point"].to_numpy(), len(labels)),
            "label": np.repeat(left["label"].to_numpy(), len(labels)),
            "other": np.tile(labels, len(a)),
            "distance": np.concatenate(sums).ravel(),
            "members": np.tile(member.sum(axis=0).astype("int64"), len(a)),
        }
    )


def _rival_clusters(keyed: DataFrame) -> tuple[DataFrame, list[dict]]:
    """The points with ``rivals``, their own cluster and every other that may be the nearest on average;
    and the clusters, which are all the driver holds.

    The mean distance of a point from a cluster's members is at least its distance from their centre,
    and at most the root of that distance squared plus the members' mean squared distance from the
    centre. A cluster whose least is above the smallest most of the others cannot be the nearest.
    """
    by_place = keyed.select("label", F.posexplode("v").alias("place", "x"))
    fitted = by_place.groupBy("label", "place").agg(F.avg("x").alias("mean"), F.var_pop("x").alias("spread"), F.count("*").alias("n"))
    # a row for each coordinate of a centre
    found: dict[int, list] = {}
    for row in sorted(fitted.collect(), key=lambda row: (row["label"], row["place"])):
        found.setdefault(row["label"], []).append(row)
    held = [
        {"label": label, "centre": [r["mean"] for r in own], "spread": fsum(r["spread"] for r in own), "n": own[0]["n"]}
        for label, own in found.items()
    ]
    known = F.expr(f"from_json('{json.dumps(held)}', 'array<struct<label int, centre array<double>, spread double, n bigint>>')")
    far = "aggregate(zip_with(v, c.centre, (x, y) -> (x - y) * (x - y)), 0.0D, (a, b) -> a + b)"
    bounds = F.expr(
        f"transform(known, c -> struct(c.label AS label, c.n AS n, sqrt({far}) AS least, sqrt({far} + c.spread) AS most))"
    )
    # rounding must not lose the nearest
    rivals = F.expr(
        """filter(bounds, c -> c.label = label OR c.least <= (1 + 1e-9D) * array_min(
            transform(filter(bounds, o -> o.label <> label), o -> o.most)))"""
    )
    return keyed.withColumn("known", known).withColumn("bounds", bounds).withColumn("rivals", rivals).drop("known", "bounds"), held


def _silhouette_points(points: DataFrame, point: str, label: str, values: str) -> DataFrame:
    return points.select(
        F.col(point).alias("point"),
        F.col(label).cast("int").alias("label"),
        F.col(values).cast("array<double>").alias("v"),
    )


def silhouette_work(points: DataFrame, point: str, label: str, values: str) -> DataFrame:
    """(compared, pairs): distances that ``silhouette_samples`` takes, of all there are."""
    bounded, held = _rival_clusters(_silhouette_points(points, point, label, values))
    every = sum(cluster["n"] for cluster in held)
    own = F.expr("aggregate(rivals, 0L, (sum, c) -> sum + c.n)")
    return bounded.agg(F.coalesce(F.sum(own), F.lit(0)).alias("compared"), F.lit(every * every).cast("bigint").alias("pairs"))


def silhouette_samples(
    points: DataFrame, point: str, label: str, values: str, per_block: int = POINTS_PER_BLOCK
) -> DataFrame:
    """(point, label, silhouette) with plain Euclidean distances, exactly.

    A point is compared with its own cluster and with those that may be its nearest
    (``_rival_clusters``). The points of a cluster are hashed into blocks. Each pair of
    blocks is one small task that returns, per point, the summed distance to the other
    block: no pair of points is ever a row. Points in a cluster of their own score 0.
    """
    bounded, held = _rival_clusters(_silhouette_points(points, point, label, values))
    blocks = f"CAST(ceil(rival.n / {per_block}) AS INT)"
    own = F.expr("filter(rivals, c -> c.label = label)[0]").alias("rival")
    keyed = bounded.select("*", own).withColumn("block", F.expr(f"CAST(pmod(xxhash64(point), {blocks}) AS INT)"))
    tasks = min(max(1, sum(cluster["n"] for cluster in held) // per_block) ** 2, MOST_TASKS)
    keys = ["mine", "block", "other", "partner"]
    left = (
        keyed.withColumn("mine", F.col("label"))
        .withColumn("rival", F.explode("rivals"))
        .withColumn("other", F.col("rival.label"))
        .withColumn("partner", F.explode(F.expr(f"sequence(0, {blocks} - 1)")))
        .drop("rivals", "rival")
    )
    # the blocks any point of which is compared with a cluster, under columns of their own
    met = left.select(*(F.col(name).alias(name) for name in ("mine", "block", "other"))).distinct()
    right = keyed.select(F.col("label").alias("other"), F.col("block").alias("partner"), F.col("v").alias("w")).join(met, "other")
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    kind = points.schema[point].dataType.simpleString()
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _block_sums, f"point {kind}, label int, other int, distance double, members bigint"
    )
    per_cluster = sums.groupBy("point", "label", "other").agg(
        F.sum("distance").alias("distance"), F.sum("members").alias("members")
    )
    own = F.col("other") == F.col("label")
    scored = per_cluster.groupBy("point", "label").agg(
        F.max(F.when(own, F.col("members"))).alias("size"),
        F.max(F.when(own, ratio(F.col("distance"), F.col("members") - 1))).alias("a"),
        F.min(F.when(~own, F.col("distance") / F.col("members"))).alias("b"),
    )
    spread = ratio(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return scored.select(
        F.col("point").alias(point),
        F.col("label").alias(label),
        F.when(F.col("size") == 1, 0.0).otherwise(F.coalesce(spread, F.lit(0.0))).alias("silhouette"),
    )


def mean_silhouette(points: DataFrame, point: str, label: str, values: str) -> DataFrame:
    return silhouette_samples(points, point, label, values).agg(F.avg("silhouette").alias("silhouette"))


def choose_k(
    days: DataFrame, columns: list[str], day: str = "date", candidates: tuple[int, ...] = CANDIDATE_K
) -> tuple[int, dict[int, float], DataFrame]:
    """The k with the strictly greatest mean silhouette (ties go to the smaller
    k), every candidate's score, and the days labelled by the winner.

    ``days`` holds one row per calendar day and should be a written table.
    """
    # a point is compared with the centres of all runs at once, so a task takes few of them
    parts = max(1, ceil(days.count() / POINTS_PER_TASK))
    points = settle(fixed_points(standardized(days, columns), columns, day).repartition(parts, day), "points")
    found = best_kmeans(points, candidates, day=day)
    values = F.expr(f"transform(v, x -> x / {UNIT}) AS values")

    def scored(k: int) -> tuple[DataFrame, float]:
        named = settle(labelled(points.select(day, "v", values), found[k], day, "values"), "labelled_days")
        return named.select(day, "prediction"), mean_silhouette(named, day, "prediction", "values").first()["silhouette"]

    # the candidates are independent jobs, submitted side by side
    with ThreadPoolExecutor(len(candidates)) as pool:
        tried = dict(zip(candidates, pool.map(scored, candidates), strict=True))
    scores = {k: score for k, (_, score) in tried.items()}
    # a table without days has no score
    best = max(sorted(candidates), key=lambda k: -2.0 if scores[k] is None else scores[k])
    return best, scores, tried[best][0]


def pattern_table(labelled: DataFrame, day: str = "date") -> DataFrame:
    """(date, pattern_type): clusters renumbered by their earliest day, so the
    numbers do not depend on the random start."""
    firsts = labelled.groupBy("prediction").agg(F.min(day).alias("first"))
    # one row per cluster
    numbered = firsts.select("prediction", (F.row_number().over(Window.orderBy("first")) - 1).alias("pattern_type"))
    return labelled.join(numbered, "prediction").select(day, F.col("pattern_type").cast("int").alias("pattern_type"))
