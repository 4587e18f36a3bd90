"""Nested statistical JSON: documents of metadata entries and data points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.functions.scalars import item, number_or_null
from corridor.schemas import SERIES_DOCUMENT
from corridor.sources import json_arrays

# The metadata entries (1-based position, field, value) that pick
# a series out of the published files.
SECTION = (1, "T3_Variable", "Secciones")
INCOME_SERIES = [SECTION, (3, "Nombre", "Renta neta media por persona")]
POPULATION_SERIES = [
    SECTION,
    (2, "Nombre", "16 y más años"),
    (3, "Nombre", "Total"),
    (4, "Nombre", "Total"),
    (5, "Nombre", "Total"),
]


def read_documents(spark: SparkSession, path: str, one_array_per_file: bool = True) -> DataFrame:
    """The documents of JSON arrays, gzip or plain.

    A published file is one array, over many lines or in one; ``json_arrays`` cuts its
    elements out by many tasks. Files landed with one array (or document) per line are
    split by lines.
    """
    if one_array_per_file:
        return json_arrays.documents(spark, path, SERIES_DOCUMENT)
    return spark.read.schema(SERIES_DOCUMENT).json(path)


def meta_is(position: int, field: str, value: str) -> Column:
    """Whether a metadata entry has a value; a missing entry is NULL."""
    return item(F.col("MetaData"), position)[field] == value


def with_meta(documents: DataFrame, wanted: list[tuple[int, str, str]]) -> DataFrame:
    for entry in wanted:
        documents = documents.filter(meta_is(*entry))
    return documents


def data_points(documents: DataFrame) -> DataFrame:
    """One row per data point; documents without any vanish."""
    points = documents.select(
        item(F.col("MetaData"), 1)["Codigo"].alias("codigo"), F.explode("Data").alias("point")
    )
    return points.select(
        "codigo", F.col("point.Fecha").alias("fecha"), F.col("point.Valor").alias("valor")
    )


def extract_series(documents: DataFrame, wanted: list[tuple[int, str, str]]) -> DataFrame:
    """(codigo, fecha, valor); a value that is not a number is NULL."""
    return data_points(with_meta(documents, wanted)).withColumn("valor", number_or_null(F.col("valor")))
