"""Toxicity by a convolutional text classifier trained in numpy.

Words (letters only, lower-cased) and their first letters are hashed into one embedding table and
the rows added: two rows for the whole word, so that sharing one row with a toxic word counts half,
and one for each beginning, so that inflected forms share what is learned. Filters of several widths
slide over the words, are cut below zero, and the two largest values of each over the whole text go
into a logistic unit: once may be chance. Gradients flow through the places of the maxima only.

The fit uses a bounded sample of labelled rows, ``most_rows`` for each label, taken by the hash of
the id; scoring reads every whole text. Neither labels nor any other column enter a score.
``thresholds`` finds, for each language, the score from which a text is called toxic.

Null, empty and wordless texts get the score of no words at all. Rows are scored one by one, so
repeated rows get equal scores. Without labels of both kinds every score is the share of toxic
labels, or 0 without any.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.text import text_groups

BUCKETS = 1 << 18
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
BEGINNINGS = (3, 4, 5, 6, 7)
PARTS = 2 + len(BEGINNINGS)
POOL = 2
MOST_ROWS = 1000
EPOCHS = 6
BATCH = 32
RATE = 0.03
#: Words a worker holds filter values of; emptied beyond that, which changes no score.
MOST_KEPT = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def hashed(word: str) -> list[int]:
    """The table rows of a word; row BUCKETS is zero and stands for beginnings as long as the word or longer."""
    data = word.encode()
    rows = [zlib.crc32(data) % BUCKETS, zlib.crc32(data, 0x5BD1E995) % BUCKETS]
    return rows + [zlib.crc32(word[:k].encode(), k) % BUCKETS if k < len(word) else BUCKETS for k in BEGINNINGS]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _largest(values: np.ndarray) -> np.ndarray:
    """The places of the POOL largest values of each column, the largest first."""
    top = np.argpartition(values, -POOL, axis=0)[-POOL:]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(values, top, axis=0), axis=0), axis=0)


@dataclass
class Classifier:
    table: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, SIZE, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    known: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray | None = None

    def slices(self) -> dict[int, list[slice]]:
        """Where each width and place within it has its filter values in a word's row."""
        place, found = 0, {}
        for w in WIDTHS:
            found[w] = [slice(place + k * FILTERS, place + (k + 1) * FILTERS) for k in range(w)]
            place += w * FILTERS
        return found

    def _learn(self, unknown: list[str]) -> None:
        embedded = self.table[np.array([hashed(w) for w in unknown])].sum(axis=1)
        fresh = np.concatenate([embedded @ self.filters[w][k] for w in WIDTHS for k in range(w)], axis=1).astype(np.float32)
        n = len(self.known)
        if self.rows is None or n + len(fresh) > len(self.rows):
            grown = np.zeros((max(2 * (n + len(fresh)), 1024), fresh.shape[1]), dtype=np.float32)
            if self.rows is not None:
                grown[: len(self.rows)] = self.rows
            self.rows = grown
        self.rows[n : n + len(fresh)] = fresh
        self.known.update(zip(unknown, range(n, n + len(fresh)), strict=True))

    def pooled(self, texts: list[list[str]]) -> np.ndarray:
        """The POOL largest values of every filter over each text, the largest first."""
        if len(self.known) > MOST_KEPT:
            self.known.clear()
        if not self.known:
            self._learn([""])  # row 0 stands for no word
            self.rows[0] = 0
        unknown = list(set().union(*texts) - self.known.keys())
        if unknown:
            self._learn(unknown)
        pad, numbers, begins = [0] * max(WIDTHS), [], []
        for words in texts:
            begins.append(len(numbers))
            numbers += map(self.known.__getitem__, words)
            numbers += pad
        values, n = self.rows[np.array(numbers, dtype=np.int64)], len(numbers)
        result = []
        for w, parts in self.slices().items():
            total = values[:, parts[0]].copy()
            for k in range(1, w):
                total[: n - k] += values[k:, parts[k]]
            top = [np.sort(np.partition(total[b:e], -POOL, axis=0)[-POOL:], axis=0)[::-1] for b, e in zip(begins, [*begins[1:], n], strict=True)]
            result.append(np.maximum(np.stack(top) + self.bias[w], 0))
        return np.concatenate(result, axis=2).reshape(len(texts), -1)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        logit = self.pooled([words_of(x) for x in texts]) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Classifier:
    """Minibatch Adagrad on the logistic loss, labels weighted to equal shares."""
    random = np.random.default_rng(seed)
    y = np.asarray(labels, dtype=np.float64)
    n_filters = POOL * FILTERS * len(WIDTHS)
    model = Classifier(
        np.r_[random.normal(0, 0.05, (BUCKETS, SIZE)), np.zeros((1, SIZE))].astype(np.float32),
        {w: random.normal(0, 0.5 / np.sqrt(w), (w, SIZE, FILTERS)) for w in WIDTHS},
        {w: np.zeros(FILTERS) for w in WIDTHS},
        np.abs(random.normal(0.3, 0.05, n_filters)),
        -1.0,
    )
    share = y.mean() if len(y) else 0.0
    if share in (0.0, 1.0):
        model.out[:], model.out_bias = 0, 30.0 if share else -30.0
        return model
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    pad = max(WIDTHS)
    split = [words_of(x) for x in texts]
    number = {w: k for k, w in enumerate(sorted(set().union(*split)))}
    parts_of = np.array([*map(hashed, number), [BUCKETS] * PARTS])  # the last row stands for no word
    encoded = [np.array([number[w] for w in x], dtype=np.int64) for x in split]
    seen_table = np.full(BUCKETS + 1, 1e-3)
    seen = {name: 1e-3 for name in ("out", "out_bias", *(("f", w) for w in WIDTHS), *(("b", w) for w in WIDTHS))}

    def step(name, value, gradient):
        seen[name] = seen[name] + gradient**2
        return value - RATE * gradient / np.sqrt(seen[name])

    for _ in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), BATCH):
            some = order[at : at + BATCH]
            parts, begins, n = [], [], 0
            for k in some:
                begins.append(n)
                parts += [encoded[k], np.full(pad, len(number))]
                n += len(encoded[k]) + pad
            met, at_met = np.unique(np.concatenate(parts), return_inverse=True)
            embedded = model.table[parts_of[met]].sum(axis=1)[at_met]
            pooled, places = [], []
            ends = np.r_[begins[1:], n]
            for w in WIDTHS:
                total = embedded @ model.filters[w][0]
                for k in range(1, w):
                    total[: n - k] += embedded[k:] @ model.filters[w][k]
                top = np.stack([b + _largest(total[b:e]) for b, e in zip(begins, ends, strict=True)])
                pooled.append(np.take_along_axis(total[None], top, axis=1) + model.bias[w])
                places.append(top)  # (texts, POOL, FILTERS)
            hidden = np.concatenate(pooled, axis=2).reshape(len(some), -1)
            active = np.maximum(hidden, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out + model.out_bias, -30, 30)))
            error = (p - y[some]) * weight[some] / len(some)
            back = error[:, None] * model.out * (hidden > 0)
            touched, moves = [], []
            filter_steps = {}
            back = back.reshape(len(some), POOL, -1)
            for c, w in enumerate(WIDTHS):
                mine = back[:, :, c * FILTERS : (c + 1) * FILTERS]
                gradient = np.zeros_like(model.filters[w])
                for k in range(w):
                    at_word = np.minimum(places[c] + k, n - 1)
                    vectors = embedded[at_word]  # (texts, POOL, FILTERS, SIZE)
                    gradient[k] = np.einsum("tpf,tpfs->sf", mine, vectors)
                    touched.append(at_word.ravel())
                    moves.append((mine[..., None] * model.filters[w][k].T).reshape(-1, SIZE))
                filter_steps[w] = gradient, mine.sum(axis=(0, 1))
            model.out = step("out", model.out, active.T @ error)
            model.out_bias = float(step("out_bias", model.out_bias, error.sum()))
            for w, (gradient, shift) in filter_steps.items():
                model.filters[w] = step(("f", w), model.filters[w], gradient)
                model.bias[w] = step(("b", w), model.bias[w], shift)
            touched, moves = np.concatenate(touched), np.concatenate(moves)
            moved = (moves != 0).any(axis=1)
            rows = parts_of[met[at_met[touched[moved]]]].ravel()
            rows, inverse = np.unique(rows, return_inverse=True)
            moves = np.repeat(moves[moved], PARTS, axis=0)
            total = np.zeros((len(rows), SIZE))
            np.add.at(total, inverse, moves)
            seen_table[rows] += (total**2).mean(axis=1)
            total[rows == BUCKETS] = 0
            model.table[rows] -= (3 * RATE * total / np.sqrt(seen_table[rows])[:, None]).astype(np.float32)
    # Classes were weighted to equal shares; the bias goes back to the share in the sample.
    model.out_bias += float(np.log(share / (1 - share)))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``most_rows`` labelled ids for each label, those with the smallest hash."""
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").distinct()
    chosen = None
    for label in (0, 1):
        some = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
        chosen = some if chosen is None else chosen.union(some)
    # Twice ``most_rows`` ids at most, so the broadcast and what comes back are bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return [r["text"] or "" for r in rows], [r["toxic"] for r in rows]


def score(docs: DataFrame, model: Classifier, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``carry`` columns and score of every whole text."""
    spark = docs.sparkSession
    # The model's size is fixed by BUCKETS and SIZE.
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), *carry, F.col(text_column).alias("text"))
    kinds = {f.name: f.dataType for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = shared.value
        for part, texts in text_groups(batches, "text"):
            scores = classifier.scores([x.decode() for x in texts])
            columns = [part.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=["doc_id", *carry, "score"])

    schema = ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in ("doc_id", *carry)) + ", score double"
    return rows.mapInArrow(run, schema)


def thresholds(scored: DataFrame, least_rows: int = 20, group: str = "lang") -> DataFrame:
    """Per language the lowest score with the best F1 on labelled rows (columns ``group``, score, toxic).

    Scores are folded to hundredths first, so a language is at most 101 rows. Languages with fewer
    than ``least_rows`` toxic rows get the threshold over all languages.
    """
    folded = scored.filter("toxic IS NOT NULL").select(
        F.col(group), F.round("score", 2).alias("at"), F.col("toxic").cast("long").alias("toxic")
    )
    cells = folded.groupBy(group, "at").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).toPandas()
    everything = cells.groupby("at", as_index=False)[["bad", "n"]].sum()

    def best(part) -> float:
        part = part.sort_values("at", ascending=False)
        caught, called = part["bad"].cumsum(), part["n"].cumsum()
        f1 = 2 * caught / (called + part["bad"].sum())
        top = f1.max()
        return float(part["at"][f1 >= top - 1e-12].mean()) if len(part) else 0.7

    general = best(everything) if len(everything) and everything["bad"].sum() else 0.7
    rows = [(None, general)]
    for name, part in cells.groupby(group):
        rows.append((name, best(part) if part["bad"].sum() >= least_rows else general))
    return scored.sparkSession.createDataFrame(rows, f"{group} string, threshold double")
