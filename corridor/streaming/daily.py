"""Daily files arriving in a folder, each day loaded once and replaceable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corridor.operators.loads import replace_days


def ingest_days(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    day_column: str = "date",
    transform: Callable[[DataFrame], DataFrame] = lambda day_rows: day_rows,
    fmt: str = "csv",
    files_per_batch: int = 1000,
    **options: object,
) -> None:
    """Load every file that arrived since the last call, then stop.

    Files land under ``<landing>/<day_column>=YYYY-MM-DD/``. The stream only
    signals which days got new files; its checkpoint is the ledger of files
    seen. Each of those days is then read again as a whole and replaces its
    partition, so a day may span any number of files and micro-batches, and a
    batch that is run twice changes nothing.
    """

    def read(reader):
        return reader.schema(schema).format(fmt).options(**options)

    def replace(batch: DataFrame, _: int) -> None:
        arrived = sorted(str(row[0]) for row in batch.select(day_column).distinct().collect())
        if not arrived:
            return
        session = batch.sparkSession
        folders = [f"{landing}/{day_column}={day}" for day in arrived]
        whole = read(session.read).option("basePath", landing).load(folders)
        replace_days(transform(whole), table, arrived, day_column)

    stream = read(spark.readStream).option("maxFilesPerTrigger", files_per_batch).load(landing)
    query = (
        stream.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # the batches ran in the stream's own session: drop this one's file listing
    spark.catalog.refreshTable(table)
