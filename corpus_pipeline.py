"""A corpus pipeline of five stages, each written as Parquet and read again as the next one's input.

Language identification drops what it rejects, exact and near copies leave one of each group,
contaminated documents go, and what is left is packed into sequences. The first four stages return
the columns of ``documents``; the last returns one row per piece with its place.

Rows with null, empty or letterless text have no language and go in the first stage. Rows that repeat
an id are judged each by its own text. All columns pass through the first four stages under their own
names, whatever they are called; empty tables give empty results.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import content_sort, decontaminate, jaccard_join, language, packing
from corridor.session import settle

TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can be told; centroids are learnt from the rows' own texts and languages."""
    model = language.learn(docs)
    # names that no column of the input has
    names = tuple(f"{name}_{uuid4().hex}" for name in ("lang", "score", "rejected"))
    return language.identify(docs, model, names=names).filter(~F.col(names[2])).select(*docs.columns)


def exact_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return content_sort.distinct_content(docs)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return jaccard_join.without_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that do not hold benchmark passages by a twentieth of their words or more."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and place."""
    return packing.pack(packing.cut_pieces(docs, public_tokenizers.path(TOKENIZER), END_ID))


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_distinct),
    ("near_dedup", near_distinct),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Language centroids, chosen paths and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
