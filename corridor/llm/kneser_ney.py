"""Quality by an interpolated modified Kneser-Ney model of characters, trained on trusted text.

N-grams of up to ``ORDER`` characters, packed into one integer of 12 bits each, are counted over all
trusted texts and summed by Spark. Counts of the highest order are raw, those below count distinct
left neighbours; each order has its three discounts from its own counts of counts, and is
interpolated with the next lower one. The result is a table of (n-gram, probability, weight of
backing off from it), dealt by n-gram.

Scoring joins counts to documents by shards: the documents of one piece of input file are a block,
a block asks for each of its distinct n-grams once, the join answers with the ones the model knows,
and the block is scored with its answers alone. No task holds the model, and what is shuffled grows
with the input. Perplexity is per character over the whole text. A text is kept when its perplexity
is at most the quantile over the trusted texts of its language and of its band of length: the fewer
characters, the wider perplexities spread.

Null and empty texts have no perplexity and are not kept. Where a language has few trusted texts in
a band, and for rows without language, the quantile is over all languages' texts of that band; if
these are few too, over the language's texts of any length, and at last over all. Repeated rows are scored one by one. Without trusted
texts every probability is uniform. Characters beyond the first 3,840 share 255 codes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.llm.text import text_groups
from corridor.session import settle

ORDER = 4
BITS = 12
DIRECT = 0xF00
TAG = 60
QUANTILE = 0.99
LEAST_TRUSTED = 50
#: Characters at which a new band of length begins.
BANDS = (64, 256, 1024, 4096, 16384)
#: Trusted ids are broadcast up to this many (16 MB), joined by shuffling beyond.
MOST_BROADCAST = 2_000_000
#: Bytes of input file that make a block.
BLOCK_BYTES = 16 << 20


def packed(text: str, order: int = ORDER) -> np.ndarray:
    """For every character the last ``order`` ones up to it, 0 standing before the text."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.where(points < DIRECT, np.maximum(points, 1), DIRECT + points % (0xFFF - DIRECT))
    padded = np.r_[np.zeros(order - 1, np.int64), codes]
    total = np.zeros(len(codes), np.int64)
    for k in range(order):
        total = (total << BITS) | padded[k : k + len(codes)]
    return total


def mask(order: int) -> int:
    return (1 << BITS * order) - 1


def count_grams(docs: DataFrame, text_column: str = "text", order: int = ORDER) -> DataFrame:
    """(g, c): how often each n-gram of the highest order ends at a character; summed in the task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def summed() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts.astype(np.int64))], names=["g", "c"])

        for _, texts in text_groups(batches, text_column):
            waiting += [packed(x.decode(), order) for x in texts]
            size += sum(map(len, waiting[-len(texts) :]))
            if size > 8 << 20:
                yield summed()
                size = 0
        if size:
            yield summed()

    return settle(docs.select(text_column).mapInArrow(count, "g bigint, c bigint").groupBy("g").agg(F.sum("c").alias("c")), "grams")


def discounts(grams: DataFrame) -> list[float]:
    """D1, D2 and D3+ from the counts of counts, as in the modified method; kept within 0 and the count."""
    n = [x or 0 for x in grams.agg(*(F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4))).first()]
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found, strict=True)]


def train(trusted: DataFrame, text_column: str = "text", order: int = ORDER) -> DataFrame:
    """The stored model: key (order in the top bits, then the n-gram), p, and weight for backing off from it."""
    levels = {order: count_grams(trusted, text_column, order)}
    for n in range(order - 1, 0, -1):
        shorter = levels[n + 1].groupBy(F.col("g").bitwiseAND(mask(n)).alias("g")).agg(F.count("*").alias("c"))
        levels[n] = settle(shorter, "grams")
    letters = levels[1].count() + 1
    lower = settle(trusted.sparkSession.range(1).select(F.col("id").alias("g"), F.lit(1.0 / letters).alias("p")), "uniform")
    model = None
    for n in range(1, order + 1):
        d1, d2, d3 = discounts(levels[n])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.shiftright("g", BITS)
        contexts = levels[n].groupBy(context.alias("context")).agg(F.sum("c").alias("total"), (F.sum(cut) / F.sum("c")).alias("weight"))
        contexts = settle(contexts, "contexts")
        # The lower order is complete now that its weights for backing off are known. What stands before
        # a text is a context and never an n-gram of its own: it has a weight and no probability (0).
        known = lower.join(contexts.select(F.col("context").alias("g"), "weight"), "g", "full").select(
            F.col("g").bitwiseOR(F.lit((n - 1) << TAG)).alias("key"),
            F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("weight", F.lit(1.0)).alias("weight"),
        )
        model = known if model is None else model.union(known)
        rows = levels[n].select("g", "c", context.alias("context"), F.col("g").bitwiseAND(mask(n - 1)).alias("suffix"))
        joined = rows.join(contexts, "context").join(lower.select(F.col("g").alias("suffix"), F.col("p").alias("below")), "suffix")
        lower = settle(joined.select("g", ((F.col("c") - cut) / F.col("total") + F.col("weight") * F.col("below")).alias("p")), "order")
    model = model.union(lower.select(F.col("g").bitwiseOR(F.lit(order << TAG)).alias("key"), "p", F.lit(1.0).alias("weight")))
    return settle(model, "model")


def asked_keys(grams: np.ndarray, order: int = ORDER) -> np.ndarray:
    """All n-grams and contexts that scoring these windows may look up."""
    keys = [np.zeros(1, np.int64)]
    for n in range(order, 0, -1):
        grams = np.unique(grams & mask(n))
        keys += [grams | (n << TAG), np.unique(grams >> BITS) | ((n - 1) << TAG)]
    return np.unique(np.concatenate(keys))


def log_probability(grams: np.ndarray, keys: np.ndarray, p: np.ndarray, weight: np.ndarray, order: int = ORDER) -> float:
    """The log-probability of the windows' last characters under the answers (keys ascending)."""
    if not len(grams) or not len(keys):
        return 0.0

    def at(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
        return place, keys[place] == wanted

    total = 0.0
    for n in range(order, -1, -1):
        place, known = at((grams & mask(n)) | (n << TAG))
        known &= p[place] > 0
        total += float(np.log(p[place[known]]).sum())
        grams = grams[~known]
        if n and len(grams):
            place, known = at(((grams & mask(n)) >> BITS) | ((n - 1) << TAG))
            total += float(np.log(weight[place[known]]).sum())
    return total


def block_of(docs: DataFrame, id_column: str) -> F.Column:
    """The piece of input file a row comes from, cut further where pieces are large."""
    size = docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    digits = "".join(c for c in size if c.isdigit())
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(size.lower().rstrip("b")[-1], 1)
    pieces = max(1, math.ceil(int(digits) * unit / BLOCK_BYTES))
    return F.concat_ws(
        " ", F.input_file_name(), F.input_file_block_start().cast("string"), F.pmod(F.xxhash64(id_column), F.lit(pieces)).cast("string")
    )


def score(docs: DataFrame, model: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_chars, log_prob, perplexity and the columns of ``carry`` of every row, rows without id too.

    ``docs`` has to be read from files (else it is stored first).
    """
    if not docs.inputFiles():
        docs = settle(docs, "docs")
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), block_of(docs, id_column).alias("block"),
        F.struct(F.lit(0).alias("_"), *carry).alias("carried"),
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has a few blocks at a time, each at most BLOCK_BYTES of file.
        asked: dict[str, list[np.ndarray]] = {}
        for part, texts in text_groups(batches):
            fresh: dict[str, list[np.ndarray]] = {}
            for block, text in zip(part.column("block").to_pylist(), texts, strict=True):
                fresh.setdefault(block, []).append(packed(text.decode(), order))
            for block, grams in fresh.items():
                merged = np.unique(np.concatenate(grams))
                asked[block] = [np.union1d(asked[block][0], merged) if block in asked else merged]
        for block, (grams,) in asked.items():
            keys = asked_keys(grams, order)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(keys), pa.string()), pa.array(keys)], names=["block", "key"])

    def answer(key, asked: pa.Table, found: pa.Table) -> pa.Table:
        keys = found.column("key").to_numpy()
        place = np.argsort(keys)
        keys, p, weight = keys[place], found.column("p").to_numpy()[place], found.column("weight").to_numpy()[place]
        out = []
        for batch in asked.to_batches(max_chunksize=1024):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                grams = packed(text or "", order)
                total = log_probability(grams, keys, p, weight, order)
                out.append((doc_id, len(grams), total, math.exp(-total / len(grams)) if len(grams) else None))
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        scores = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.table([*scores, asked.column("carried")], names=["doc_id", "n_chars", "log_prob", "perplexity", "carried"])

    numbers = T.StructType().add("doc_id", "long").add("n_chars", "long").add("log_prob", "double").add("perplexity", "double")
    questions = rows.select("text", "block").mapInArrow(ask, "block string, key bigint")
    answers = settle(questions.join(model, "key"), "answers")
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        answer, numbers.add("carried", rows.schema["carried"].dataType)
    )
    return scored.select("doc_id", "n_chars", "log_prob", "perplexity", *(F.col("carried")[c].alias(c) for c in carry))


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled good."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(F.broadcast(good) if good.count() <= MOST_BROADCAST else good, "doc_id")


def band() -> F.Column:
    """The band of length of a row by its n_chars."""
    return sum(((F.col("n_chars") >= least).cast("int") for least in BANDS), F.lit(0))


def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(lang, band, threshold) from trusted rows with lang, n_chars and perplexity.

    A row without lang holds for all languages, one without band for all lengths. Only what
    ``LEAST_TRUSTED`` rows or more stand behind has a row, and all together.
    """
    trusted = scored.filter("perplexity IS NOT NULL").select("lang", band().alias("band"), "perplexity")
    found = trusted.cube("lang", "band").agg(
        F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"), F.count("*").alias("n"),
        F.grouping("lang").alias("any_lang"), F.grouping("band").alias("any_band"),
    )
    enough = (F.col("n") >= LEAST_TRUSTED) & (F.col("lang").isNotNull() | (F.col("any_lang") == 1))
    return found.filter(enough | (F.col("any_lang") + F.col("any_band") == 2)).select("lang", "band", "threshold")


def with_thresholds(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with the threshold of each row, null where nothing is trusted."""
    # One row for each band and one for the rest.
    general = {r["band"]: r["threshold"] for r in limits.filter("lang IS NULL").collect()}
    shared = [F.when(F.col("band") == k, F.lit(v)) for k, v in general.items() if k is not None]
    banded = limits.filter("lang IS NOT NULL AND band IS NOT NULL").withColumnRenamed("threshold", "banded")
    whole = limits.filter("lang IS NOT NULL AND band IS NULL").select("lang", F.col("threshold").alias("whole"))
    limit = F.coalesce("banded", *shared, "whole", F.lit(general.get(None)).cast("double")).alias("threshold")
    rows = scored.withColumn("band", band()).join(banded, ["lang", "band"], "left").join(whole, "lang", "left")
    return rows.select(*scored.columns, limit)
