"""Exact deduplication by sorting content.

Rows are range-partitioned by (first bytes of the normalised text, its SHA-256, id) at sampled
splitters, sorted on disk within each range, and neighbours are compared in full. The id in the
key lets a group of copies of any size be cut over several ranges; the runs at both ends of a
range are then joined across ranges, two per range at most.

Null texts count as empty; rows without an id sort after all ids; rows alike in everything count
one by one, and one of them stays. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.session import settle

#: Deleted before texts are compared. Fixed values.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
BLANK_PATTERN = r"[\x20\x09-\x0D]"
KEY_BYTES = 48
ROWS_OUT = 4096

RUN_FIELDS = [
    T.StructField("run_part", T.IntegerType()),
    T.StructField("run_no", T.LongType()),
    T.StructField("run_keep_id", T.LongType()),
    T.StructField("run_chars", T.LongType()),
    T.StructField("run_size", T.LongType()),
    T.StructField("run_stays", T.BooleanType()),
    T.StructField("run_sha256", T.StringType()),
    T.StructField("run_edge", T.BinaryType()),
]
ARROW = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.binary()]


def sorted_content(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows, range-partitioned and sorted so that equal texts are neighbours."""
    plain = F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")), BLANK_PATTERN, "")
    keyed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.substring(plain.cast("binary"), 1, KEY_BYTES).alias("head"),
        F.sha2(plain, 256).alias("sha"),
    )
    key = [F.col("head"), F.col("sha"), F.col(f"row.{id_column}").asc_nulls_last()]
    return keyed.repartitionByRange(*key).sortWithinPartitions(*key)


def _runs(id_column: str, text_column: str, only_kept: bool):
    """Neighbouring comparisons within one range; a run's ids are held, its texts are not."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        current, members, best, schema = None, [], None, None
        out: list[tuple] = []

        def closed(last: bool) -> None:
            edge = current if number == 0 or last else None
            rank, keep_at, keep_row, sha = best
            for k, (doc_id, row) in enumerate(((rank[2], keep_row),) if only_kept else members):
                stays = only_kept or k == keep_at
                out.append((row, part, number, rank[2], -rank[0], len(members), stays, sha, edge if stays else None))

        def flush() -> pa.RecordBatch:
            rows = [pa.array([x[0] for x in out], type=schema)]
            rows += [pa.array([x[i + 1] for x in out], type=kind) for i, kind in enumerate(ARROW)]
            out.clear()
            return pa.RecordBatch.from_arrays(rows, names=["row", *(f.name for f in RUN_FIELDS)])

        for batch in batches:
            full = batch.schema.field("row").type
            schema = full if only_kept else pa.struct([full.field(id_column)])
            for row, sha in zip(batch.column("row").to_pylist(), batch.column("sha").to_pylist(), strict=True):
                text, doc_id = row[text_column] or "", row[id_column]
                plain = text.encode().translate(None, BLANKS)
                if plain != current:
                    if current is not None:
                        closed(last=False)
                        number += 1
                    current, members, best = plain, [], None
                    if len(out) >= ROWS_OUT:
                        yield flush()
                rank = (-len(text), doc_id is None, doc_id)
                if best is None or rank[:2] < best[0][:2] or rank[:2] == best[0][:2] and not rank[1] and doc_id < best[0][2]:
                    best = (rank, len(members), row if only_kept else None, sha)
                members.append((doc_id, None if only_kept else {id_column: doc_id}))
        if current is not None:
            closed(last=True)
        if out:
            yield flush()

    return scan


def _joined_ends(runs: DataFrame) -> DataFrame:
    """One row per run at an end of a range: what holds for its text over all ranges."""
    ends = runs.filter("run_edge IS NOT NULL")
    rank = F.struct(
        (-F.col("run_chars")).alias("chars"), F.col("run_keep_id").isNull().alias("no_id"),
        F.col("run_keep_id").alias("id"), F.col("run_part").alias("part"), F.col("run_no").alias("no"),
    )
    one = ends.groupBy("run_edge").agg(F.sum("run_size").alias("size"), F.min(rank).alias("best"))
    return (
        ends.select("run_edge", "run_part", "run_no")
        .join(one, "run_edge")
        .select(
            F.col("run_part").alias("end_part"), F.col("run_no").alias("end_no"), F.col("size").alias("end_size"),
            F.col("best.id").alias("end_keep_id"),
            ((F.col("best.part") == F.col("run_part")) & (F.col("best.no") == F.col("run_no"))).alias("end_stays"),
        )
    )


def _run_table(docs: DataFrame, id_column: str, text_column: str, only_kept: bool) -> tuple[DataFrame, DataFrame]:
    docs = docs.withColumn(id_column, F.col(id_column).cast("long"))
    ordered = sorted_content(docs if only_kept else docs.select(id_column, text_column), id_column, text_column)
    row = ordered.schema["row"].dataType
    if not only_kept:
        row = T.StructType([row[id_column]])
    schema = T.StructType([T.StructField("row", row), *RUN_FIELDS])
    runs = settle(ordered.select("row", "sha").mapInArrow(_runs(id_column, text_column, only_kept), schema), "runs")
    ends = settle(_joined_ends(runs), "run_ends")
    # At most two rows for each range, so the broadcast is bounded by the number of tasks.
    same = (F.col("run_part") == F.col("end_part")) & (F.col("run_no") == F.col("end_no"))
    return runs, runs.drop("run_edge").join(F.broadcast(ends), same, "left")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with its group: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without blanks. Of equal texts the one with most code points in the
    original stays, then the one with the smallest id.
    """
    _, runs = _run_table(docs, id_column, text_column, only_kept=False)
    return runs.select(
        F.col(f"row.{id_column}").alias("doc_id"),
        F.when(F.col("end_size").isNotNull(), F.col("end_keep_id")).otherwise(F.col("run_keep_id")).alias("keep_id"),
        F.coalesce("end_size", "run_size").alias("group_size"),
        (F.col("run_stays") & F.coalesce("end_stays", F.lit(True))).alias("kept"),
        F.col("run_sha256").alias("text_sha256"),
    )


def distinct_content(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    _, runs = _run_table(docs, id_column, text_column, only_kept=True)
    kept = runs.filter(F.coalesce("end_stays", F.lit(True)))
    return kept.select(*(F.col("row").getField(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def sha256(text: str | None) -> str:
    """The digest of one normalised text, as in the result."""
    return hashlib.sha256((text or "").encode().translate(None, BLANKS)).hexdigest()
