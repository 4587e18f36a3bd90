"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the documents into segments of bounded text and stores, for each segment, the
positions of every term (term ids ascending, positions ascending within a term) and where its
documents begin. Documents of a segment are one position apart, so no phrase crosses two. A query
is sent to every segment, as in any index dealt by documents: nothing is shuffled, a hot passage or
word is only as long a list as its segment, and a lost executor rereads stored segments.

``find_phrases`` intersects offset-adjusted lists from the rarest term on; ``find_near`` asks for
all terms within some words, in any order.

Words are runs of digits, letters and non-ASCII characters with A-Z lower-cased, held as 64-bit
hashes. Null or wordless texts have no words and never match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.text import text_groups, words
from corridor.session import settle

WINDOW = 13
SEGMENT_BYTES = 6 << 20
#: Phrases sent to the segments at once; more are sent in as many blocks, over the same index.
BLOCK_BYTES = 32 << 20

INDEX_SCHEMA = "doc_ids array<bigint>, begins binary, terms binary, ends binary, positions binary"
FOUND_SCHEMA = (
    "segment bigint, doc int, doc_id bigint, n_words bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>"
)
NEAR_SCHEMA = "doc_id bigint, item_id string, position bigint"


def _segments(vocabulary: np.ndarray | None, id_column: str, text_column: str):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches, text_column, SEGMENT_BYTES):
            hashes, bounds = words(texts)
            doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
            position = np.arange(len(hashes), dtype=np.int64) + doc  # one free place between documents
            if vocabulary is not None:
                known = np.isin(hashes, vocabulary, kind="sort")
                hashes, position = hashes[known], position[known]
            order = np.argsort(hashes, kind="stable")
            terms, first = np.unique(hashes[order], return_index=True)
            ends = np.r_[first[1:], len(order)] if len(terms) else first
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column(id_column).cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                    pa.array([(bounds + np.arange(len(bounds))).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([terms.astype(np.uint64).tobytes()], pa.binary()),
                    pa.array([ends.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([position[order].astype(np.int32).tobytes()], pa.binary()),
                ],
                names=["doc_ids", "begins", "terms", "ends", "positions"],
            )

    return build


def build_index(docs: DataFrame, terms: np.ndarray | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One stored row per segment; with ``terms`` (hashes) only those words get lists, all keep their places."""
    vocabulary = None if terms is None else np.unique(terms)
    index = docs.select(id_column, text_column).mapInArrow(_segments(vocabulary, id_column, text_column), INDEX_SCHEMA)
    return settle(index.withColumn("segment", F.monotonically_increasing_id()), "postings")


class Segment:
    """One segment's lists, as a task reads them."""

    def __init__(self, row: dict):
        self.number, self.doc_ids = row["segment"], row["doc_ids"]
        self.begins = np.frombuffer(row["begins"], np.int32)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.r_[0, np.frombuffer(row["ends"], np.int32)]
        self.positions = np.frombuffer(row["positions"], np.int32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word's list, or -1."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.terms, hashes).clip(max=len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def postings(self, place: int) -> np.ndarray:
        return self.positions[self.ends[place] : self.ends[place + 1]]

    def counts(self, places: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(places), dtype=np.int64)
        return np.where(places < 0, 0, self.ends[places + 1] - self.ends[places])

    def phrase(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Where the words stand one after another: lists intersected from the rarest word on."""
        order = np.argsort(counts, kind="stable")
        begins = self.postings(places[order[0]]) - order[0]
        for k in order[1:]:
            if not len(begins):
                break
            other = self.postings(places[k])
            wanted = begins + k
            at = np.searchsorted(other, wanted)
            begins = begins[(at < len(other)) & (other[at.clip(max=len(other) - 1)] == wanted)]
        return begins

    def near(self, places: np.ndarray, counts: np.ndarray, within: int) -> np.ndarray:
        """Places of the rarest word with every other word at most ``within`` places away, same document."""
        order = np.argsort(counts, kind="stable")
        anchors = self.postings(places[order[0]])
        doc = np.searchsorted(self.begins, anchors, side="right") - 1
        low = np.maximum(anchors - within, self.begins[doc])
        high = np.minimum(anchors + within, self.begins[doc + 1] - 2)
        stays = np.ones(len(anchors), dtype=bool)
        for k in order[1:]:
            other = self.postings(places[k])
            stays &= np.searchsorted(other, low) < np.searchsorted(other, high, side="right")
        return anchors[stays]


class Windows:
    """All windows of a block of items side by side, to be met with a segment at once."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        lengths = np.array([len(h) for _, h in items], dtype=np.int64)
        self.names = [name for name, _ in items]
        self.hashes = np.concatenate([h for _, h in items]) if items else np.zeros(0, np.uint64)
        # the words of all items, each once, and where every word of every item stands among them
        self.terms, self.place = np.unique(self.hashes, return_inverse=True)
        counts = np.maximum(lengths - window, 0) + 1
        self.item = np.repeat(np.arange(len(items)), counts)
        within = np.arange(len(self.item)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.begin = np.repeat(np.cumsum(lengths) - lengths, counts) + within
        self.size = np.repeat(np.minimum(lengths, window), counts)

    def whole(self, segment: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows all of whose words the segment holds, and the places and counts of all items' words."""
        places = segment.places(self.terms)[self.place]
        counts = segment.counts(places)
        missing = np.r_[0, np.cumsum(counts == 0)]
        return np.flatnonzero(missing[self.begin + self.size] == missing[self.begin]), places, counts


def _finder(items: list[tuple[str, np.ndarray]], window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Windows(items, window)
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                step = np.zeros(int(segment.begins[-1]) + window + 2, dtype=np.int64)
                found: list[set[str]] = [set() for _ in segment.doc_ids]
                held, places, counts = asked.whole(segment)
                for w in held:
                    b, size = asked.begin[w], asked.size[w]
                    begins = segment.phrase(places[b : b + size], counts[b : b + size])
                    if len(begins):
                        step[begins] += 1  # the begins of one window differ
                        step[begins + size] -= 1
                        for d in np.unique(np.searchsorted(segment.begins, begins, side="right") - 1):
                            found[d].add(asked.names[asked.item[w]])
                covered = np.r_[False, np.cumsum(step) > 0, False]
                edges = np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)
                at = np.searchsorted(segment.begins, edges[:, 0], side="right") - 1
                cut = np.searchsorted(at, np.arange(len(segment.doc_ids) + 1))
                spans = [
                    [{"begin": int(b), "end": int(e)} for b, e in edges[cut[d] : cut[d + 1]] - segment.begins[d]]
                    for d in range(len(segment.doc_ids))
                ]
                n = len(segment.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment.number] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(np.diff(segment.begins).astype(np.int64) - 1),
                        pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                    ],
                    names=["segment", "doc", "doc_id", "n_words", "spans", "items"],
                )

    return find


def block_count(items: DataFrame, text_column: str, most: int) -> int:
    total = items.agg(F.sum(F.length(F.col(text_column).cast("binary")))).first()[0] or 0
    return max(1, math.ceil(total / most))


def phrase_blocks(items: DataFrame, id_column: str, text_column: str, most: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """(id as text, word hashes) of items that have words, in blocks of about ``most`` bytes, each brought in by itself."""
    blocks = block_count(items, text_column, most)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64(text_column), F.lit(blocks)) == k) if blocks > 1 else items
        rows = part.select(F.col(id_column).cast("string"), text_column).collect()
        hashed = [(row[0] or "", words([(row[1] or "").encode()])[0]) for row in sorted(rows, key=lambda r: (r[0] or "", r[1] or ""))]
        yield [x for x in hashed if len(x[1])]


def find_phrases(index: DataFrame, items: DataFrame, id_column: str = "item_id", text_column: str = "text",
                 window: int = WINDOW, most: int = BLOCK_BYTES) -> DataFrame:
    """Every document with its words in any ``window`` consecutive words of an item.

    doc_id, n_words, spans (begin and end in words, disjoint, ascending), items (ids as text,
    ascending). An item of fewer words, but not none, is one window. Rows of one id are one item.
    """
    blocks = phrase_blocks(items, id_column, text_column, most)
    if block_count(items, text_column, most) == 1:
        return index.mapInArrow(_finder(next(blocks), window), FOUND_SCHEMA)
    found = index.mapInArrow(_finder([], window), FOUND_SCHEMA)
    # Each block's matches are written before the next block is fetched.
    for block in blocks:
        found = found.union(settle(index.mapInArrow(_finder(block, window), FOUND_SCHEMA).filter("size(items) > 0"), "matches"))
    return found.groupBy("segment", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def covered_words(spans: str) -> str:
    """SQL for the number of words in ascending spans that may overlap."""
    zero = "named_struct('upto', 0L, 'n', 0L)"
    step = "named_struct('upto', greatest(a.upto, s.end), 'n', a.n + greatest(0L, s.end - greatest(a.upto, s.begin)))"
    return f"aggregate({spans}, {zero}, (a, s) -> {step}, a -> a.n)"


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items, spans, contaminated (a twentieth of its words hit, or more)."""
    vocabulary = None
    # With one block its vocabulary is bounded by BLOCK_BYTES; else all words are indexed.
    if block_count(benchmark, "text", BLOCK_BYTES) == 1:
        block = next(phrase_blocks(benchmark, "item_id", "text", BLOCK_BYTES))
        vocabulary = np.concatenate([h for _, h in block] or [np.zeros(0, np.uint64)])
    index = build_index(docs, vocabulary, id_column, text_column)
    hit = find_phrases(index, benchmark, most=BLOCK_BYTES).withColumn("n_hit", F.expr(covered_words("spans")))
    return hit.select(
        F.col("doc_id"), F.col("n_words"), F.col("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.col("segment"), F.col("doc"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that are not contaminated, with all columns.

    Decisions are by id and text, so of rows that share an id each is judged by its own text. Only
    keys of contaminated rows are joined; Spark broadcasts them if their stored table is small.
    """
    key = F.xxhash64(id_column, text_column)
    judged = contamination(docs.select(key.alias("row_key"), text_column), benchmark, "row_key", text_column)
    bad = settle(judged.filter("contaminated").select(F.col("doc_id").alias("row_key")).distinct(), "contaminated")
    return docs.join(bad, key == bad["row_key"], "left_anti")


def find_near(index: DataFrame, items: DataFrame, within: int, id_column: str = "item_id", text_column: str = "text",
              most: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, position of the item's rarest word wherever all its words stand within ``within`` words of it."""

    def finder(block):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    segment, out = Segment(row), []
                    for name, hashes in block:
                        places = segment.places(np.unique(hashes))
                        counts = segment.counts(places)
                        if counts.min():
                            at = segment.near(places, counts, within)
                            doc = np.searchsorted(segment.begins, at, side="right") - 1
                            out += [(segment.doc_ids[d], name, int(p - segment.begins[d])) for d, p in zip(doc, at, strict=True)]
                    columns = list(zip(*out, strict=True)) or [(), (), ()]
                    kinds = (pa.int64(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "position"]
                    )

        return find

    blocks = phrase_blocks(items, id_column, text_column, most)
    if block_count(items, text_column, most) == 1:
        return index.mapInArrow(finder(next(blocks)), NEAR_SCHEMA)
    found = None
    for block in blocks:
        near = settle(index.mapInArrow(finder(block), NEAR_SCHEMA), "near")
        found = near if found is None else found.union(near)
    return found
