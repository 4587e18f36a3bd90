"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. The plan is made on counts of pieces by
length, never on pieces: lengths from long to short, each put into the sequences with the least
room that still takes it, whole ranges of alike sequences at a time. The result is a table of
(length, ranks) -> (sequences, offset); its size depends on the number of lengths. Pieces then
take planned slots by joining on their rank within their length. Ranks are dealt inside the task
that cut the pieces, plus the counts of the tasks before it, so no length gathers in one place.

Null texts count as empty: one piece, the end id alone. Repeated rows and ids are packed one by
one. An empty table gives no pieces.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corridor.llm.text import text_groups
from corridor.llm.tokenize import WordIds
from corridor.session import settle

CAPACITY = 4096

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, task_rank bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id",
               text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """Stored pieces of every document: PIECES and, if asked for, ids."""
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = WordIds(tokenizer), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, dtype=np.int64)
        for part, texts in text_groups(batches, text_column):
            rows, packed = [], []
            for doc_id, ids in zip(part.column(id_column).to_pylist(), encode([x.decode() for x in texts]), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    some = ids[at : at + 4 * capacity]
                    n = len(some) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(some), task, int(met[n])))
                    met[n] += 1
                    if keep_ids:
                        packed.append(np.frombuffer(some, "<u4").astype(np.int64))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"]
            if keep_ids:
                columns, names = [*columns, pa.array(packed, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id_column).cast("long").alias(id_column), text_column)
    return settle(rows.mapInArrow(cut, PIECES + ", ids array<bigint>" * keep_ids), "pieces")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: (length, first rank, end rank, first sequence, per sequence, offset).

    Ranks first <= r < end of a length go to sequence ``first sequence + (r - first) // per`` at
    ``offset + (r - first) % per * length``.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free tokens: [first, end) sequences
    slots, sequences = [], 0
    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        rank, left = 0, histogram[length]
        free = length
        while left and free <= capacity:
            if not room[free]:
                free += 1
                continue
            first, end = room[free].pop()
            per = free // length
            full = min(end - first, left // per)
            if full:
                slots.append((length, rank, rank + full * per, first, per, capacity - free))
                room[free - per * length].append((first, first + full))
                rank, left, first = rank + full * per, left - full * per, first + full
            if first < end and left and left < per:
                slots.append((length, rank, rank + left, first, left, capacity - free))
                room[free - left * length].append((first, first + 1))
                rank, left, first = rank + left, 0, first + 1
            if first < end:
                room[free].append((first, end))
        per = capacity // length
        for size, count in ((per, left // per), (left % per, 1)) if left else ():
            if size and count:
                slots.append((length, rank, rank + size * count, sequences, size, 0))
                room[capacity - size * length].append((sequences, sequences + count))
                rank, sequences = rank + size * count, sequences + count
    return slots


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank within their length: the task's own rank after the counts of earlier tasks."""
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_base"))
    base = settle(base, "rank_bases")
    # It grows with the tasks, so it is never broadcast; a key has the rows of one task and length at most.
    return pieces.join(base.hint("merge"), ["task", "length"]).withColumn("rank", F.col("rank_base") + F.col("task_rank"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` rows with sequence_id and offset."""
    spark = pieces.sparkSession
    # At most ``capacity`` rows: one per length.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    names = "slot_length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, per bigint, slot_offset bigint"
    slots = spark.createDataFrame(plan(histogram, capacity), names)
    # Its size depends on the number of lengths alone.
    taken = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    within = F.col("rank") - F.col("first_rank")
    return (
        ranked(pieces)
        .join(F.broadcast(slots), taken)
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(within / F.col("per")).cast("long"))
        .withColumn("offset", F.col("slot_offset") + within % F.col("per") * F.col("length"))
        .select(*(c for c in pieces.columns if c not in ("task", "task_rank")), "sequence_id", "offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences (sequence_id, doc_ids, ids) of pieces cut with ``keep_ids``; a group holds at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids")
    )
