"""Files published under flat names, loaded day by day once a day's parts are all there.

A published name holds its day and, where a day comes in several files, its part:
``20240115_Viajes_distritos.csv.gz``. A ledger table keeps every file seen; a day is loaded in one
piece when the ledger holds all parts asked for, and again when a part of it is published anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corridor.operators.loads import create_if_absent, replace_days, replace_partitions
from corridor.sources.delimited import plain_path

# What a listing of files gives; the content is never read from it.
LISTED = "path string, modificationTime timestamp, length bigint, content binary"
LEDGER = "path string, day date, part string, published timestamp, batch string"
# The day, then the part; a pattern for days of one file has () for the part.
NAME = r"/(\d{8})_([^/]+?)\.csv(?:\.gz)?$"


def named_files(listing: DataFrame, name: str = NAME) -> DataFrame:
    """(path, day, part, published) of the files whose path matches ``name``; others and dates that
    do not exist are left out."""
    return listing.select(
        "path",
        F.try_to_date(F.regexp_extract("path", name, 1), "yyyyMMdd").alias("day"),
        F.regexp_extract("path", name, 2).alias("part"),
        F.col("modificationTime").alias("published"),
    ).filter(F.col("day").isNotNull())


def current_files(ledger: DataFrame) -> DataFrame:
    """(day, part, path): of a part published several times the newest file."""
    newest = F.max_by("path", F.struct("published", "path"))
    return ledger.groupBy("day", "part").agg(newest.alias("path"))


def complete_days(ledger: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(day) for which every part has come."""
    wanted = F.col("part").isin(list(parts))
    return (
        ledger.filter(wanted).groupBy("day").agg(F.countDistinct("part").alias("n"))
        .filter(F.col("n") == len(set(parts))).select("day")
    )


def missing_parts(ledger: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(day, part) that has not come, of days some part of which has."""
    held = ledger.groupBy("day").agg(F.collect_set("part").alias("held"))
    wanted = F.array(*(F.lit(part) for part in sorted(set(parts))))
    return held.select("day", F.explode(F.array_except(wanted, "held")).alias("part"))


def ingest_published(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    ledger: str,
    checkpoint: str,
    parts: Sequence[str],
    name: str = NAME,
    day_column: str = "date",
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    fmt: str = "csv",
    files_per_batch: int = 1000,
    **options: object,
) -> None:
    """Take in every file that arrived since the last call, then stop.

    The stream lists files and reads none. A micro-batch writes its files to the ledger under its own
    number, so one that runs twice after a failure leaves the same ledger. Days that got a file and
    have all ``parts`` are then read whole from their newest files, in one job, and replace
    themselves in ``table``; days that lack a part are left as they are. ``schema`` is the files'
    without ``day_column``, which comes from the name. A replaced file needs a path of its own, as
    the stream sees a path once; files stay where they are while their day may be loaded again. Files
    of parts not asked for are noted and not loaded.
    """
    # numbers of batches start anew with a checkpoint
    prefix = md5(checkpoint.encode()).hexdigest()[:16]
    create_if_absent(spark.createDataFrame([], LEDGER), ledger, ["batch"])

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch_id = f"{prefix}-{number}"
        came = named_files(batch, name).withColumn("batch", F.lit(batch_id))
        seen = replace_partitions(came, ledger, [batch_id], "batch").filter(F.col("part").isin(list(parts)))
        touched = seen.filter(F.col("batch") == batch_id).select("day").distinct()
        ready = complete_days(seen.join(touched, "day", "left_semi"), parts)
        # as many rows as files of the days a batch completes
        files = current_files(seen.join(ready, "day", "left_semi")).select("path", F.col("day").cast("string")).collect()
        if not files:
            return
        paths = sorted(plain_path(row["path"]) for row in files)
        rows = session.read.schema(schema).format(fmt).options(**options).load(paths)
        day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), name, 1), "yyyyMMdd")
        replace_days(transform(rows.withColumn(day_column, day)), table, {row["day"] for row in files}, day_column)

    listing = spark.readStream.format("binaryFile").schema(LISTED).option("maxFilesPerTrigger", files_per_batch)
    stream = listing.load(landing).select("path", "modificationTime")
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # the batches ran in the stream's own session: drop this one's file listings
    spark.catalog.refreshTable(ledger)
    spark.catalog.refreshTable(table)
