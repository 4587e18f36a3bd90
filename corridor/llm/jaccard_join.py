"""Word-shingle Jaccard self-join along chosen paths.

Every text is the set of its runs of five words. Equal sets are one class and joined once. A class
is embedded as minhash values; a node of the recursion picks two of them by its own hash, and each
class goes to the child named by its value there, so two sets go the same way with the probability
of their similarity. Nodes of at most ``SMALL`` classes are compared in full, larger ones are split
again down to ``DEPTH``. A pair misses one run with a probability computed by ``missed``; runs are
repeated until what all of them and the comparison of sketches miss (``missed_in_all``) is below one
minus the target recall.

Nodes still large at the end are compared in blocks: every pair of blocks is a task of its own, so
no group of near copies gathers in one place and none is cut off. Pairs never leave the task that
compares them. A pair met in several nodes counts in the first one both share. Sketches are compared
first, far below the threshold; only classes with a likely partner have their sets brought there and
compared exactly. What leaves are link counts and a spanning forest, joined by star contraction.

Null texts and texts without words have no set: no links, each its own group. Texts of fewer than
five words are one run. Rows alike in id and text count one by one. Shingles are 64-bit hashes, of
which sketches use the upper half. n different texts of one run each have two equal sets with a
probability of about n^2 / 2^65: 3e-8 for a million, 0.03 for a thousand million.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.text import mixed, text_groups, words
from corridor.session import settle

WORDS = 5
SIMILAR = 0.8
RECALL = 0.999
SKETCH = 64
CHILDREN = 2
DEPTH = 3
SMALL = 96
BLOCK = 256
#: Sketches are ruled out from this far below the threshold, or farther where the recall asks for it.
DOUBT = 0.2
MOST_RUNS = 10_000

_random = np.random.default_rng(20_011)
_FACTORS = _random.integers(1, 1 << 62, WORDS, dtype=np.uint64) | np.uint64(1)
_MASKS = _random.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32)
_STEPS = _random.integers(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)

RECORDS = "doc_id bigint, text_hash bigint, set_key string, n_shingles int, sketch binary"


def missed(similar: float = SIMILAR, depth: int = DEPTH) -> float:
    """The probability that a pair of this similarity shares no node at the last level of one run."""
    lost = 0.0
    for _ in range(depth):
        lost = (1 - similar * (1 - lost)) ** CHILDREN
    return lost


def agreeing(similar: float) -> list[float]:
    """The probability of each number of equal sketch values, for a pair of this similarity."""
    return [math.comb(SKETCH, k) * similar**k * (1 - similar) ** (SKETCH - k) for k in range(SKETCH + 1)]


def least_agreeing(similar: float = SIMILAR, recall: float = RECALL) -> int:
    """Equal sketch values from which a pair is compared; those with fewer are half of what may be missed at most."""
    least, chances = max(0, math.ceil((similar - DOUBT) * SKETCH - 1e-9)), agreeing(similar)
    while least and sum(chances[:least]) > (1 - recall) / 2:
        least -= 1
    return least


def missed_in_all(runs: int, recall: float = RECALL, similar: float = SIMILAR) -> float:
    """The probability that a pair of this similarity is not compared: all runs and the filter go by one sketch."""
    least = least_agreeing(similar, recall)
    return sum(p * (missed(k / SKETCH) ** runs if k >= least else 1) for k, p in enumerate(agreeing(similar)))


def runs_needed(recall: float = RECALL, similar: float = SIMILAR) -> int:
    for runs in range(1, MOST_RUNS + 1):
        if missed_in_all(runs, recall, similar) <= 1 - recall:
            return runs
    raise ValueError(f"sketches of {SKETCH} values do not find pairs of similarity {similar} with a recall of {recall}")


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All five-word runs as 64-bit hashes, and where each text's begin."""
    hashes, bounds = words(texts)
    n = np.diff(bounds)
    padded = np.r_[hashes, np.zeros(WORDS, np.uint64)]
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes), np.uint64)
        for k in range(WORDS):
            within = np.arange(len(hashes)) + k < np.repeat(bounds[1:], n)
            total += np.where(within, padded[k : k + len(hashes)] * _FACTORS[k], np.uint64(0))
        runs = mixed(total)
    # A text of fewer words keeps its first position, the run of all of them.
    counts = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], n)
    return runs[place < np.repeat(counts, n)], np.r_[0, np.cumsum(counts)]


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for part, texts in text_groups(batches):
        runs, bounds = shingles(texts)
        sets = [np.unique(runs[b:e]) for b, e in zip(bounds, bounds[1:], strict=False)]
        sketch = np.zeros((len(texts), SKETCH), np.uint32)
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            upper = (runs >> np.uint64(32)).astype(np.uint32)
            for t in range(SKETCH):
                sketch[some, t] = np.minimum.reduceat((upper ^ _MASKS[t]) * _STEPS[t], bounds[some])
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("text_hash"),
                pa.array([xxhash.xxh3_128_hexdigest(x.tobytes()) for x in sets], pa.string()),
                pa.array([len(x) for x in sets], pa.int32()),
                pa.array([x.tobytes() for x in sketch], pa.binary()),
            ],
            names=["doc_id", "text_hash", "set_key", "n_shingles", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_groups(batches):
        runs, bounds = shingles(texts)
        sets = [np.unique(runs[b:e]).tobytes() for b, e in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([part.column("class"), pa.array(sets, pa.binary())], names=["class", "payload"])


def _children(path, times: int) -> F.Column:
    """The ``times`` children of a node for one class: its sketch values at places the node picks."""
    spot = F.xxhash64(path, F.lit("pick"))
    odd = F.lit(2) * F.pmod(F.shiftright(spot, 20), F.lit(SKETCH // 2)) + 1
    picks = [F.pmod(F.pmod(spot, F.lit(SKETCH)) + k * odd, F.lit(SKETCH)).cast("int") for k in range(times)]
    return F.array(*(F.xxhash64(path, i, F.substring(F.col("sketch"), 4 * i + 1, F.lit(4))) for i in picks))


def leaves(classes: DataFrame, runs: int) -> DataFrame:
    """(path, class, size): the nodes to compare in full; a node is shared by at least two classes."""
    roots = F.array(*(F.lit(r).cast("long") for r in range(runs)))
    rows = classes.select("class", "sketch", F.explode(roots).alias("path")).select(
        "class", F.explode(_children(F.col("path"), CHILDREN)).alias("path")
    )
    found = None
    for depth in range(1, DEPTH + 1):
        shared = settle(rows.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1"), "node_sizes")
        live = settle(rows.join(shared, "path"), "nodes")
        done = live if depth == DEPTH else live.filter(F.col("size") <= SMALL)
        found = done if found is None else found.union(done)
        large = live.filter(F.col("size") > SMALL).select("class", "path")
        if depth == DEPTH or large.isEmpty():
            return found
        rows = settle(
            large.join(classes.select("class", "sketch"), "class").select("class", F.explode(_children(F.col("path"), CHILDREN)).alias("path")),
            "paths",
        )
    return found


def _blocked(members: DataFrame) -> DataFrame:
    """Each member of a node once for every pair of blocks its own block is in: (path, i, j, block, ...)."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class", F.lit("block")), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j")),
    )
    return (
        members.withColumn("blocks", blocks).withColumn("block", own)
        .withColumn("pair", F.explode(pairs)).withColumn("i", F.col("pair.i")).withColumn("j", F.col("pair.j"))
        .drop("pair", "blocks", "size")
    )


def _first_shared(group: list[dict], path: int) -> np.ndarray:
    """Which pairs share no node that comes before this one; pairs are counted in the first they share."""
    before = [[p for p in row["nodes"] if p < path] for row in group]
    names = {p: k for k, p in enumerate({p for x in before for p in x})}
    met = np.zeros((len(group), max(1, len(names))), np.float32)
    for k, x in enumerate(before):
        met[k, [names[p] for p in x]] = 1
    return met @ met.T < 0.5


def _comparable(group: list[dict], path: int, i: int, j: int) -> np.ndarray:
    """The pairs this task has to look at, upper triangle only."""
    look = np.triu(_first_shared(group, path), 1)
    if i != j:
        block = np.array([row["block"] for row in group])
        look &= block[:, None] != block[None, :]
    return look


def _likely(least: int):
    def agree(group: list[dict], path: int, i: int, j: int) -> Iterator[tuple]:
        """Members with a partner whose sketch has ``least`` equal values or more."""
        look = _comparable(group, path, i, j)
        if look.any():
            sketch = np.stack([np.frombuffer(row["payload"], np.uint32) for row in group])
            for a in np.flatnonzero(look.any(axis=1)):
                look[a] &= (sketch == sketch[a]).sum(axis=1) >= least
            for a in np.flatnonzero(look.any(axis=0) | look.any(axis=1)):
                row = group[a]
                yield path, i, j, row["block"], row["class"], row["nodes"]

    return agree


def _linked(similar: float):
    def compare(group: list[dict], path: int, i: int, j: int) -> Iterator[tuple]:
        """(class, links counted here, the smallest class joined to it here)."""
        group = [next(rows) for _, rows in groupby(sorted(group, key=itemgetter("class")), key=itemgetter("class"))]
        look = _comparable(group, path, i, j)
        sets = [np.frombuffer(row["payload"], np.uint64) for row in group]
        sizes = np.array([len(x) for x in sets], np.float64)
        tokens, number, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes.astype(int))
        often = seen[number] > 1
        rank = (np.cumsum(seen > 1) - 1)[number[often]]
        owner, shared = owner[often], np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(rank, kind="stable")
        rank, owner = rank[order], owner[order]
        for at in range(0, int(rank[-1]) + 1 if len(rank) else 0, 4096):
            b, e = np.searchsorted(rank, (at, at + 4096))
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[b:e], rank[b:e] - at] = 1
            shared += part @ part.T
        linked = look & (shared >= similar * (sizes[:, None] + sizes[None, :] - shared) - 1e-6)
        links = linked.sum(axis=0) + linked.sum(axis=1)
        root = list(range(len(sets)))

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for a, b in zip(*np.nonzero(linked), strict=True):
            x, y = sorted((top(int(a)), top(int(b))))
            root[y] = x
        for k in np.flatnonzero(links):
            yield group[k]["class"], int(links[k]), group[top(int(k))]["class"]

    return compare


def _by_node(work: Callable, kinds: list[tuple[str, pa.DataType]]):
    """Runs ``work`` on each (path, i, j) of sorted rows; a group is two blocks at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])

        for (path, i, j), group in groupby(rows, key=itemgetter("path", "i", "j")):
            group = list(group)
            if len(group) > 1:
                out += work(group, path, i, j)
            if len(out) >= 4096:
                yield flush()
        if out:
            yield flush()

    return run


def _in_nodes(rows: DataFrame) -> DataFrame:
    return rows.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b): star contraction until nothing changes."""
    edges = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")), "least")
        # Larger neighbours hang on the smallest neighbour ...
        edges = settle(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct(), "large_star")
        # ... and then each node and its smaller neighbours.
        least = settle(edges.groupBy("a").agg(F.min("b").alias("root")), "least")
        hung = edges.join(least, "a").filter("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        edges = settle(hung.union(least.select("a", F.col("root").alias("b"))).distinct(), "small_star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similar: float = SIMILAR,
                recall: float = RECALL) -> DataFrame:
    """Every row with its group and links.

    doc_id, text_hash, class_id (smallest id of its group), set_id (smallest id with an equal set),
    n_links (other sets with a similarity of ``similar`` or more), n_shingles, stays (the row of the
    smallest id of its group; one of rows alike).
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_hash")
    )
    records = settle(rows.mapInArrow(_records, RECORDS).withColumn("row", F.monotonically_increasing_id()), "records")
    with_set = records.filter("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "text_hash")).alias("first")
    classes = settle(with_set.groupBy("set_key").agg(first).select("set_key", "first", F.col("first.row").alias("class")), "classes")
    sketches = settle(records.select(F.col("row").alias("class"), "sketch").join(classes.select("class"), "class"), "sketches")

    found = leaves(sketches, runs_needed(recall, similar))
    # A class is in a bounded number of nodes: runs times CHILDREN to the power of DEPTH.
    nodes = found.groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("path", "size"))).alias("in_nodes")
    ).withColumn("nodes", F.col("in_nodes.path"))
    members = settle(nodes.join(sketches, "class").withColumnRenamed("sketch", "payload"), "members")
    spread = members.select("class", "nodes", "payload", F.explode("in_nodes").alias("at")).select(
        "class", "nodes", "payload", F.col("at.path").alias("path"), F.col("at.size").alias("size")
    )
    place = [("path", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("block", pa.int32()), ("class", pa.int64())]
    likely = _in_nodes(_blocked(spread)).mapInArrow(
        _by_node(_likely(least_agreeing(similar, recall)), [*place, ("nodes", pa.list_(pa.int64()))]),
        "path bigint, i int, j int, block int, class bigint, nodes array<bigint>",
    )
    likely = settle(likely, "likely")

    # Only classes with a likely partner have their sets made again, from the row that stands for them.
    wanted = likely.select("class").distinct().join(classes, "class").select(
        "class", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")
    )
    wanted = settle(wanted, "wanted")
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_hash"] == wanted["text_hash"])
    # Both sides are dealt by id and text at every size; only the keys are held in memory.
    sets = rows.join(wanted.hint("shuffle_hash"), same).select("class", "text").mapInArrow(_sets, "class bigint, payload binary")
    compared = _in_nodes(likely.join(settle(sets, "sets"), "class")).mapInArrow(
        _by_node(_linked(similar), [("class", pa.int64()), ("links", pa.int64()), ("joined", pa.int64())]),
        "class bigint, links bigint, joined bigint",
    )
    compared = settle(compared, "links")
    links = compared.groupBy("class").agg(F.sum("links").alias("n_links"))
    groups = settle(components(compared.select(F.col("class").alias("a"), F.col("joined").alias("b"))), "components")

    named = classes.join(groups, classes["class"] == groups["node"], "left").join(links, "class", "left").select(
        "set_key", "first", F.coalesce("root", "class").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    named = settle(named, "named")
    heads = settle(named.groupBy("root").agg(F.min("first").alias("head")), "heads")
    classed = settle(
        named.join(heads, "root").select(
            F.col("set_key").alias("key"), F.col("first.doc_id").alias("set_id"), "n_links",
            F.col("head.doc_id").alias("class_id"), F.col("head.row").alias("head_row"),
        ),
        "classed",
    )
    out = records.join(classed, (records["set_key"] == classed["key"]) & (records["n_shingles"] > 0), "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("set_id")).alias("set_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_shingles",
        (alone | (F.col("row") == F.col("head_row"))).alias("stays"),
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all columns; rows alike in id and text once."""
    groups = near_groups(docs, id_column, text_column).filter("stays")
    staying = settle(groups.select(F.col("doc_id").alias("stay_id"), F.col("text_hash").alias("stay_hash")).distinct(), "staying")
    same = docs[id_column].cast("long").eqNullSafe(staying["stay_id"]) & (F.xxhash64(docs[text_column]) == staying["stay_hash"])
    return docs.join(staying, same, "left_semi")
