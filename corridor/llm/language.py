"""Language identification by nearest centroids.

A text is the TF-IDF vector of its letter n-grams (one to three letters, hashed into a fixed number
of dimensions, words set apart), scaled to length one. Each language has several centroids, found by
clustering its vectors on the sphere; the nearest by cosine names the language. Texts farther from
every centroid than the calibrated distance are rejected.

Every learnable row teaches: document frequencies, centroids and the calibrated distances are taken
over all of them, and rows alike in id, text and language count once in the last two. The n-gram counts
of a text are packed and written once; each step of the clustering is one job over them, whose tasks
return sums in whole numbers, so that the model does not depend on the order of rows or on their split.
What a job returns is bounded by dimensions, centroids and languages.

Null texts and texts without letters
are ``und`` with score 0 and rejected; without learnable rows every text is. Equal texts get equal
results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.llm.text import text_groups
from corridor.session import settle

DIMENSIONS = 1 << 14
ORDERS = (1, 2, 3)
CENTROIDS = 4
ROUNDS = 8
UNKNOWN = "und"
#: A text is rejected when its cosine is below this share of the lowest hundredth of its language's rows'.
SLACK = 0.25
#: Parts of one in which components are summed: whole numbers give the same sum in any order.
PARTS = 1 << 30
#: Parts of one in which cosines are counted for the lowest hundredth.
STEPS = 1 << 16
#: Bytes of packed vectors unpacked at once, and cells sent at once.
GROUP = 512 << 10

_GAPS = re.compile(r"[\W\d_]+")
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def grams(text: str) -> np.ndarray:
    """The counts of all n-grams by dimension; all zero without letters."""
    letters = _GAPS.sub(" ", text.lower()).strip()
    if not letters:
        return np.zeros(DIMENSIONS, dtype=np.float32)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le"), dtype=np.uint32)
    found, total = [], np.zeros(len(codes), dtype=np.uint32)
    for k in range(max(ORDERS)):
        n = len(codes) - k
        if n <= 0:
            break
        total = (total[:n] ^ codes[k:]) * _STEPS[k]
        if k + 1 in ORDERS:
            mixed = total ^ (total >> np.uint32(15))
            found.append((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1))
    return np.bincount(np.concatenate(found), minlength=DIMENSIONS).astype(np.float32)


@dataclass
class Centroids:
    languages: list[str]
    owner: np.ndarray
    weight: np.ndarray
    centers: np.ndarray  # (DIMENSIONS, number of centroids)
    floor: dict[str, float]

    def vector(self, text: str) -> np.ndarray:
        return scaled(np.log1p(grams(text)) * self.weight)

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine and whether it is rejected."""
        vector = self.vector(text)
        if not self.languages or not vector.any():
            return UNKNOWN, 0.0, True
        cosine = vector @ self.centers
        best = int(cosine.argmax())
        language, score = self.languages[self.owner[best]], float(min(1.0, max(0.0, cosine[best])))
        return language, score, score < self.floor[language]


def scaled(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=-1, keepdims=True), 1e-12)


def packed(counts: np.ndarray) -> bytes:
    """The dimensions that occur, as gaps, and their counts; nothing without letters."""
    at = np.flatnonzero(counts)
    if not len(at):
        return b""
    planes = np.r_[np.diff(at, prepend=0), counts[at]].astype("<u4").view(np.uint8).reshape(-1, 4).T
    squeeze = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return squeeze.compress(planes.tobytes()) + squeeze.flush()


def unpacked(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and counts."""
    planes = np.frombuffer(zlib.decompress(vector), np.uint8).reshape(4, -1)
    gaps, counts = planes.T.copy().view("<u4").reshape(2, -1)
    return np.cumsum(gaps, dtype=np.int64), counts


def vectors(rows: DataFrame, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    """(language, vector, copies): the packed n-grams of all rows; those alike in id, text and language are one row."""
    keyed = rows.select(
        F.col(id_column).alias("id"), F.col(lang_column).alias("language"),
        F.unhex(F.sha2(F.col(text_column), 256)).alias("digest"), F.col(text_column).alias("vector"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches, "vector"):
            column = pa.array([packed(grams(text.decode())) for text in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], column], names=part.schema.names)

    schema = T.StructType([*keyed.schema.fields[:3], T.StructField("vector", T.BinaryType())])
    alike = keyed.mapInArrow(pack, schema).groupBy("id", "language", "digest", "vector").agg(F.count("*").alias("copies"))
    return alike.select("language", "vector", "copies")


def totals(rows: DataFrame, size: int, add) -> np.ndarray:
    """The sum over all tasks of what ``add`` counts for each of ``size`` cells, given groups of rows as ``unpacked``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for part, packs in text_groups(batches, "vector", GROUP):
            found = [unpacked(x) for x in packs]
            sizes = np.array([len(at) for at, _ in found])
            cells, n = add(part, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), sizes)
            # whole numbers below 2^53, which doubles add without error
            total += np.bincount(cells, n, minlength=size).astype(np.int64)
        filled = np.flatnonzero(total)
        for i in range(0, len(filled), GROUP):
            at = filled[i : i + GROUP]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])

    sums = rows.mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, dtype=np.int64)
    total[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return total


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many texts each dimension occurs, copies and all."""
    return totals(rows, DIMENSIONS, lambda part, at, _, sizes: (at, np.repeat(part.column("copies").to_numpy(), sizes)))


@dataclass
class Clusters:
    """Centers of each language so far: (languages, centers, dimensions), below zero where a language has fewer."""

    languages: list[str]
    weight: np.ndarray
    centers: np.ndarray

    def __post_init__(self) -> None:
        # rows of all centers' components, to be picked by language and dimension
        self.table = np.ascontiguousarray(self.centers.transpose(0, 2, 1)).reshape(-1, self.centers.shape[1])
        self.number = {name: k for k, name in enumerate(self.languages)}

    def components(self, at: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Vectors of length one."""
        value = (np.log1p(counts.astype(np.float32)) * self.weight[at]).astype(np.float64)
        return value / np.repeat(np.sqrt(np.add.reduceat(value**2, np.cumsum(sizes) - sizes)), sizes)

    def nearest(self, part: pa.RecordBatch, at, counts, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each row its language's number, nearest center and cosine; components of all rows."""
        own = np.array([self.number[name] for name in part.column("language").to_pylist()])
        value = self.components(at, counts, sizes)
        shares = self.table[np.repeat(own, sizes) * DIMENSIONS + at] * value[:, None]
        cosine = np.add.reduceat(shares, np.cumsum(sizes) - sizes, axis=0)
        return own, cosine.argmax(axis=1), cosine.max(axis=1), value


def moved(rows: DataFrame, clusters: Clusters) -> np.ndarray:
    """Each center after one round: the direction of the sum of the vectors nearest to it; without any it stays."""
    centers = clusters.centers
    shared = rows.sparkSession.sparkContext.broadcast(clusters)

    def add(part, at, counts, sizes):
        own, best, _, value = shared.value.nearest(part, at, counts, sizes)
        return np.repeat(own * centers_each + best, sizes) * DIMENSIONS + at, np.rint(value * PARTS)

    centers_each = centers.shape[1]
    sums = totals(rows, centers.size, add).reshape(centers.shape).astype(np.float64)
    shared.unpersist()
    return np.where(sums.any(axis=-1, keepdims=True), scaled(sums), centers)


def farthest(rows: DataFrame, clusters: Clusters) -> dict[str, bytes]:
    """Of each language the packed vector farthest from its nearest center, the least of several as far."""
    shared = rows.sparkSession.sparkContext.broadcast(clusters)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, tuple[int, bytes]] = {}
        for part, packs in text_groups(batches, "vector", GROUP):
            found = [unpacked(x) for x in packs]
            sizes = np.array([len(at) for at, _ in found])
            cosine = shared.value.nearest(part, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), sizes)[2]
            near = np.rint(cosine * PARTS).astype(np.int64).tolist()
            for name, *candidate in zip(part.column("language").to_pylist(), near, packs, strict=True):
                least[name] = min(least.get(name, tuple(candidate)), tuple(candidate))
        columns = [(name, *candidate) for name, candidate in least.items()]
        kinds = (pa.string(), pa.int64(), pa.binary())
        arrays = [pa.array([row[k] for row in columns], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["language", "near", "vector"])

    each = rows.mapInArrow(find, "language string, near bigint, vector binary")
    least = each.groupBy("language").agg(F.min(F.struct("near", "vector")).alias("least")).select("language", "least.vector")
    found = {r[0]: bytes(r[1]) for r in least.collect()}  # one row for each language
    shared.unpersist()
    return found


def clustered(rows: DataFrame, languages: list[str], most: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> Clusters:
    """``most`` centroids of each language by cosine, started from the mean and then the farthest vectors."""
    found = Clusters(languages, weight, np.zeros((len(languages), 1, DIMENSIONS)))
    found = Clusters(languages, weight, moved(rows, found))
    for taken in range(1, int(most.max())):
        far, added = farthest(rows, found), np.full((len(languages), 1, DIMENSIONS), -1.0)
        for k, name in enumerate(languages):
            if taken < most[k]:
                at, counts = unpacked(far[name])
                added[k, 0] = 0
                added[k, 0, at] = found.components(at, counts, np.array([len(at)]))
        found = Clusters(languages, weight, np.concatenate([found.centers, added], axis=1))
    for _ in range(rounds):
        before, found = found, Clusters(languages, weight, moved(rows, found))
        if np.array_equal(before.centers, found.centers):
            break
    return found


def lowest_hundredth(rows: DataFrame, clusters: Clusters) -> np.ndarray:
    """Of each language the cosine to the nearest center that a hundredth of its rows is below, to a ``STEPS``-th."""
    shared = rows.sparkSession.sparkContext.broadcast(clusters)

    def add(part, at, counts, sizes):
        own, _, cosine, _ = shared.value.nearest(part, at, counts, sizes)
        return own * (STEPS + 1) + np.rint(np.clip(cosine, 0, 1) * STEPS).astype(np.int64), np.ones(len(own))

    passed = totals(rows, len(clusters.languages) * (STEPS + 1), add).reshape(-1, STEPS + 1).cumsum(axis=1)
    shared.unpersist()
    place = 0.01 * (passed[:, -1] - 1)
    below, above = ([int(np.searchsorted(row, p, side="right")) for row, p in zip(passed, side, strict=True)] for side in (np.floor(place), np.ceil(place)))
    return (below + (place - np.floor(place)) * (np.array(above) - below)) / STEPS


def draw(rows: DataFrame, id_column: str, text_column: str, lang_column: str, most_rows: int) -> DataFrame:
    """About ``most_rows`` rows of each language, by a hash of id and text; rows alike in both count once."""
    # Languages are few; a sample by hash needs no ranking of a language in one task.
    key = F.xxhash64(id_column, text_column, F.lit("language"))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_column).agg(F.approx_count_distinct(key, 0.02)).collect()}
    share = F.lit(0.0)
    for name, count in counts.items():
        share = F.when(F.col(lang_column) == name, min(1.0, most_rows / max(count, 1))).otherwise(share)
    columns = [id_column, text_column, lang_column]
    drawn = rows.select(*columns, (F.pmod(key, F.lit(10**15)) / 1e15).alias("draw")).filter(F.col("draw") < share)
    return drawn.select(*columns).dropDuplicates()


def learn(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
          centroids: int = CENTROIDS) -> Centroids:
    """Fit on all rows with text and language; rows without either are left out."""
    rows = rows.filter(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull())
    known = settle(vectors(rows, id_column, text_column, lang_column), "vectors")
    lettered = F.length("vector") > 0
    # one row for each language
    facts = known.groupBy("language").agg(F.sum("copies"), F.count_if(lettered)).collect()
    numbers = {name: filled for name, _, filled in sorted(facts) if filled}
    # no more tasks than run at once, since each returns sums of one size
    known = known.filter(lettered).coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    weight = np.log((1 + sum(n for _, n, _ in facts)) / (1 + document_frequencies(known))).astype(np.float32) + 1
    if not numbers:
        return Centroids([], np.zeros(0, np.int64), weight, np.zeros((DIMENSIONS, 0), np.float32), {})
    languages, most = [*numbers], np.minimum([*numbers.values()], centroids)
    clusters = clustered(known, languages, most, weight)
    floor = SLACK * lowest_hundredth(known, clusters)
    return Centroids(
        languages, np.repeat(np.arange(len(languages)), most), weight,
        np.concatenate([own[:n] for own, n in zip(clusters.centers, most, strict=True)]).T.astype(np.float32).copy(),
        dict(zip(languages, floor.tolist(), strict=True)),
    )


def identify(docs: DataFrame, model: Centroids, text_column: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """The rows with predicted language, cosine and rejection added; columns of those names are replaced."""
    # A fixed number of dimensions by a few centroids for each language.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(*names)
    out = (pa.string(), pa.float64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for part, texts in text_groups(batches, text_column):
            found = list(zip(*(centroids.nearest(x.decode()) for x in texts), strict=True))
            added = [pa.array(c, t) for c, t in zip(found, out, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *names])

    added = [T.StructField(n, t()) for n, t in zip(names, (T.StringType, T.DoubleType, T.BooleanType), strict=True)]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))
