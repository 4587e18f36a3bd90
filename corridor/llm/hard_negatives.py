"""Hard negatives for the positives of anchor vectors, by slots of scores.

Vectors are whole numbers, a score is their inner product, higher scores come first, ties by the
smaller id. An anchor's positives are its best other rows of the same label. The negatives of a
positive are the best rows of other labels whose score lies in a window that ends at the positive's
score and begins at a share of it.

The positives' scores, in descending order, split the scores below the highest into disjoint slots,
each up to one limit and above the next. Every block of rows keeps its best ``n_negatives`` of each
slot, and so does the merge of blocks; rows below all windows are left out. A window is a run of
slots from its own limit down, cut at its lower end, so the best of all windows, which overlap,
follow from merging the slots' lists from the lowest up: a slot's list goes before what the lower
slots gave, and the first ``n_negatives`` stay.

Anchors and rows are dealt to blocks and meet on block pairs, an equi-join whose tasks hold one block
of each; a label of many rows has many blocks. Scores are never shuffled, only the best of a block.

Rows without id, label or vector, or with a missing or non-finite component, take no part. A shorter
vector counts as ending in zeros. Rows are told apart even if they repeat an id: an anchor row is not
its own positive, but another row of its id may be, and each anchor row gives its own results. Scores
must fit 64 bits; else the job fails rather than rounding.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.session import settle

ANCHOR_BLOCK = 8192
ROW_BLOCK = 8192
#: Scores computed at once in a task.
TILE = 1 << 20

BEST_SCHEMA = "anchor bigint, slot int, id bigint, score bigint"


def whole_vectors(rows: DataFrame, id_column: str, label_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """(row, id, label, vector): each component times ``scale``, rounded down; rows that take no part are gone."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = rows.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & F.col(vector_column).isNotNull() & finite)
    scaled = taken.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("bigint").alias("label"),
        F.transform(vector, lambda x: x * float(scale)).alias("vector"),
    )
    return settle(scaled.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    """The whole-number vectors as doubles, filled up with zeros."""
    lists = table.column(name).combine_chunks()
    lengths = np.asarray(lists.value_lengths())
    out = np.zeros((len(lengths), width))
    values = np.floor(np.asarray(lists.flatten()))
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products: in doubles while every partial sum is exact there, else in Python's numbers."""
    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in a], dtype=object) @ np.array([[int(x) for x in row] for row in b], dtype=object).T
    if exact.size and max(map(abs, exact.ravel())) >= 2**63:
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def _first(keys: tuple[np.ndarray, ...], groups: np.ndarray, most: int) -> np.ndarray:
    """Indices of the first ``most`` of each group in the order of ``keys`` (last key first); groups come first."""
    order = np.lexsort((*keys, groups))
    ordered = groups[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, int)
    place = np.arange(len(ordered)) - np.repeat(begins, np.diff(np.r_[begins, len(ordered)]))
    return order[place < most]


def _best_pairs(n_best: int, same_label: bool):
    """For a block pair: each anchor's best rows, of its label as one slot, or of other labels by slot."""

    def best(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[np.ndarray] = []
        if anchors.num_rows and rows.num_rows:
            width = max(int(np.asarray(t.column("vector").combine_chunks().value_lengths()).max()) for t in (anchors, rows))
            a, b = _matrix(anchors, "vector", width), _matrix(rows, "vector", width)
            a_row, a_label = (anchors.column(x).to_numpy() for x in ("row", "label"))
            b_row, b_label, b_id = (rows.column(x).to_numpy() for x in ("row", "label", "id"))
            step = max(1, TILE // len(b))
            limits = None if same_label else np.asarray(anchors.column("limits").to_pylist(), dtype=object)
            for k in range(0, len(a), step):
                score = _products(a[k : k + step], b)
                same = a_label[k : k + step, None] == b_label[None, :]
                if same_label:
                    i, j = np.nonzero(same & (a_row[k : k + step, None] != b_row[None, :]))
                    slot = np.zeros(len(i), dtype=np.int64)
                    s = score[i, j]
                else:
                    own = [np.asarray(x, dtype=np.int64) for x in limits[k : k + step]]
                    top, low = np.array([x[0] for x in own]), np.array(anchors.column("least").to_numpy()[k : k + step])
                    i, j = np.nonzero(~same & (score <= top[:, None]) & (score >= low[:, None]))
                    s = score[i, j]
                    # the slot of the smallest limit that is not below the score
                    padded = np.full((len(own), max(map(len, own))), np.iinfo(np.int64).min)
                    for row, x in zip(padded, own, strict=True):
                        row[: len(x)] = x
                    slot = (padded[i] >= s[:, None]).sum(axis=1) - 1
                group = i * (n_best + 1) + slot if same_label else i * (padded.shape[1] + 1) + slot
                first = _first((b_id[j], -s), group, n_best)
                found.append(np.stack([a_row[k + i[first]], slot[first], b_id[j[first]], s[first]]))
        out = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = ["anchor", "slot", "id", "score"]
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)

    return best


def _paired(anchors: DataFrame, rows: DataFrame, by: list[str], n_anchors: Column, n_rows: Column, best) -> DataFrame:
    """Every block of anchors with every block of rows of the same ``by``: blocks are keys of an equi-join."""
    dealt = F.pmod(F.xxhash64("id", "row"), F.greatest(F.col("n"), F.lit(1)))
    left = anchors.withColumn("n", n_anchors).withColumn("a_block", dealt)
    left = left.withColumn("r_block", F.explode(F.sequence(F.lit(0).cast("bigint"), n_rows - 1))).drop("n")
    right = rows.withColumn("n", n_rows).withColumn("r_block", dealt)
    right = right.withColumn("a_block", F.explode(F.sequence(F.lit(0).cast("bigint"), n_anchors - 1))).drop("n")
    # both sides may come from one table: the right one's columns are its own
    right = right.select(*(F.col(name).alias(name) for name in right.columns))
    keys = [*by, "a_block", "r_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, BEST_SCHEMA)


def _kept(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each anchor and slot; blocks' lists are cut before they are shuffled."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def positives(vectors: DataFrame, anchors: DataFrame, n_positives: int) -> DataFrame:
    """(anchor, place, id, score): each anchor row's best other rows of its label."""
    sizes = vectors.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("all"))
    asked = anchors.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("asked"))
    # labels with an anchor, with the blocks their anchors and rows are dealt to
    labels = settle(sizes.join(asked, "of").select(
        "of", F.ceil(F.col("asked") / ANCHOR_BLOCK).alias("n_anchors"), F.ceil(F.col("all") / ROW_BLOCK).alias("n_rows")
    ), "labels")
    left = anchors.join(labels, anchors["label"] == labels["of"]).drop("of")
    right = vectors.join(labels, vectors["label"] == labels["of"]).drop("of")
    found = _paired(left, right, ["label"], F.col("n_anchors"), F.col("n_rows"), _best_pairs(n_positives, True))
    return _kept(found, n_positives).select("anchor", "place", "id", "score")


def _window_floor(score: str, floor: tuple[int, int]) -> Column:
    """The share of a score that is not negative, rounded up, in whole numbers that do not overflow."""
    part, whole = floor
    return F.expr(f"({score} div {whole}) * {part} + ({score} % {whole} * {part} + {whole - 1}) div {whole}")


def slot_limits(found: DataFrame, floor: tuple[int, int]) -> DataFrame:
    """(anchor, limits, least): the different positive scores, descending, and the lowest score any window reaches.

    ``floor`` is the share of a positive's score, as a fraction, at which its window begins.
    """
    reach = F.when(F.col("score") >= 0, _window_floor("score", floor))  # windows of negative scores are empty
    limits = found.groupBy("anchor").agg(
        F.reverse(F.array_sort(F.collect_set("score"))).alias("limits"), F.min(reach).alias("least")
    )  # at most as many as positives
    return limits.filter("least IS NOT NULL")


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, floor: tuple[int, int] = (4, 5),
         id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    ``is_anchor`` is a condition on ``id`` and ``label``.
    """
    vectors = whole_vectors(rows, id_column, label_column, vector_column, scale)
    anchors = vectors.filter(is_anchor)
    found = settle(positives(vectors, anchors, n_positives), "positives")
    limits = settle(slot_limits(found, floor), "limits")
    asked = settle(anchors.join(limits, anchors["row"] == limits["anchor"]).drop("anchor"), "anchors")

    n_rows, n_asked = vectors.count(), asked.count()
    blocks = [F.lit(max(1, ceil(n / most))).cast("bigint") for n, most in ((n_asked, ANCHOR_BLOCK), (n_rows, ROW_BLOCK))]
    kept = _kept(_paired(asked, vectors, [], blocks[0], blocks[1], _best_pairs(n_negatives, False)), n_negatives)

    # at most n_negatives a slot and as many slots as positives
    lists = kept.groupBy("anchor").agg(F.collect_list(F.struct("slot", "place", "id", "score")).alias("kept"))
    slots = F.sequence(F.size("limits") - 1, F.lit(0))  # from the lowest limit up

    def merged(done: Column, slot: Column) -> Column:
        """What the windows from this slot down begin with: the slot's own list, then the lower slots'."""
        own = F.filter(F.array_sort("kept"), lambda x: x["slot"] == slot)
        lower = F.coalesce(F.get(done, F.lit(0)), F.array().cast("array<struct<slot:int,place:int,id:bigint,score:bigint>>"))
        return F.concat(F.array(F.slice(F.concat(own, lower), 1, n_negatives)), done)

    empty = F.array().cast("array<array<struct<slot:int,place:int,id:bigint,score:bigint>>>")
    answers = lists.join(limits.select(F.col("anchor").alias("of"), "limits"), F.col("anchor") == F.col("of")).select(
        "anchor", "limits", F.aggregate(slots, empty, merged).alias("from_slot")
    )
    pairs = found.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).alias("p")
    joined = pairs.join(answers.alias("n"), F.col("p.anchor") == F.col("n.anchor"))
    window = F.filter(
        F.get("from_slot", (F.array_position("limits", F.col("positive_score")) - 1).cast("int")),
        lambda x: x["score"] >= _window_floor("positive_score", floor),
    )
    listed = joined.select(
        F.col("p.anchor").alias("row"), "place", "positive_id", "positive_score",
        F.posexplode(F.when(F.col("positive_score") >= 0, window)).alias("k", "negative"),
    ).alias("l")
    names = anchors.select(F.col("row").alias("of"), F.col("id").alias("anchor_id"))
    return listed.join(names, F.col("l.row") == F.col("of")).select(
        "anchor_id", "positive_id", (F.col("k") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
        "positive_score", F.col("negative.score").alias("negative_score"), F.col("place").alias("positive_rank"),
    )
