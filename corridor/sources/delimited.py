"""Delimited text: daily trip files and dimension files."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The two delimiters the files use; the first wins a tie.
DELIMITERS = (";", "|")


def read_lenient(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = "|",
    quote: str = '"',
    glob: str | None = None,
) -> DataFrame:
    """All-string rows; rows with too few or too many fields are dropped.

    The parser's column pruning is off for this read: with it, a query that
    needs few columns would keep malformed rows a wider query drops.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("encoding", "UTF-8")
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", False)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def read_dimension(spark: SparkSession, path: str, columns: list[str], sep: str = "|") -> DataFrame:
    """A headered reference file, cut to the named columns. Names come from the
    header, nothing is inferred: codes stay strings and keep leading zeros."""
    return spark.read.option("header", True).option("sep", sep).csv(path).select(*columns)


def delimiters(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(file, delimiter): the more frequent candidate in each file's first line.

    One pass over all files; each file folds to its first line on the map side.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("place"),
        "value",
    )
    semicolon, pipe = DELIMITERS
    first = F.min_by("value", "place")
    counted = lines.groupBy("file").agg(first.alias("line")).select(
        "file",
        F.regexp_count("line", F.lit(";")).alias("semicolons"),
        F.regexp_count("line", F.lit(r"\|")).alias("pipes"),
    )
    return counted.select(
        "file", F.when(F.col("pipes") > F.col("semicolons"), pipe).otherwise(semicolon).alias("delimiter")
    )


def read_detected(spark: SparkSession, path: str | list[str], schema: StructType, glob: str | None = None) -> DataFrame:
    """Files of either delimiter as one table, with a ``delimiter`` column: one
    read per delimiter in use.

    Only the (file, delimiter) list comes to the driver, as a file listing does.
    """
    by_delimiter: dict[str, list[str]] = {}
    for row in delimiters(spark, path, glob).collect():
        by_delimiter.setdefault(row["delimiter"], []).append(_as_path(row["file"]))
    parts = [
        read_lenient(spark, files, schema, sep, quote="").withColumn("delimiter", F.lit(sep))
        for sep, files in sorted(by_delimiter.items())
    ]
    empty = spark.createDataFrame([], schema).withColumn("delimiter", F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, parts) if parts else empty


def _as_path(file: str) -> str:
    """A file's address as a path to read: the metadata escapes it like a URL, and
    the reader takes some characters for patterns."""
    return plain_path(unquote(file))


def plain_path(path: str) -> str:
    """A path in which the reader takes no character for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
