"""The trie of conversation openings, summed by an Euler tour.

A node is a distinct sequence of first turns; it is named by its smallest conversation and its depth.
Every node has an enter and an exit arc, and the tour goes from an enter arc to the enter arc of the
first child (else to the own exit arc) and from an exit arc to the enter arc of the next sibling (else
to the parent's exit arc). The tour is a linked list, and ranking it gives every arc its place and the
sums of the weights of all arcs up to it; what a subtree holds is the difference of the sums at its
two arcs.

List ranking: nodes lie sorted by parent in blocks, so that a tour stays in a block for long. In a
block runs of arcs that follow each other there are ranked by pointer doubling, and a run becomes one
element of a shorter list. That list is contracted in rounds: an element whose coin is tails takes in
the element after it if that one's coin is heads, by one grouping, without a join. A quarter goes in
each round, whatever the list looks like. The bounded rest is ranked in one task, and the rounds are
undone in reverse. Siblings are ordered by the sort alone, so a node of very many children is spread
over blocks.

Turns are compared by two 64-bit hashes of role and text with the depth; a path is the exclusive or
of its turns' hashes, so it is found in blocks of turns, and a conversation of very many turns is not
one task's. n paths have two that are equal by chance with a probability of about n^2 / 2^129.

Null role or text is empty; turns of one number are ordered by role and text; rows without a
conversation take no part. A conversation may have no turns of its own; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.session import settle

#: Turns of a conversation whose path hash is found in one go.
TURN_BLOCK = 4096
#: Nodes of a block of the tour.
NODE_BLOCK = 1 << 16
#: Elements of the contracted list that one task ranks.
LIST_END = 1 << 14

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = ("arcs", "leaves", "saved")


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, a, b, words) of every turn in order, from 1, and (conv_id, turns) of every conversation.

    Rows are sorted in ranges, so a long conversation is cut; ranges count for themselves and start
    from what the ranges before hold of the conversation. Texts are shuffled once and then left behind.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    light = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.xxhash64("role", "text").alias("a"), F.xxhash64("text", F.lit(1), "role").alias("b"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            begins = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            place = np.arange(len(conv)) - np.repeat(begins, np.diff(np.r_[begins, len(conv)])) + 1
            if conv[0] == last:
                place[: begins[1] if len(begins) > 1 else len(conv)] += held
            last, held = conv[-1], place[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int64()), pa.array(np.full(len(conv), part), pa.int32())],
                names=["conv_id", "a", "b", "words", "place", "part"],
            )

    local = settle(light.mapInArrow(number, "conv_id bigint, a bigint, b bigint, words bigint, place bigint, part int"), "turns")
    held = local.groupBy("conv_id", "part").agg(F.max("place").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = settle(held.withColumn("earlier", F.coalesce(F.sum("held").over(earlier), F.lit(0))), "held")
    # only conversations cut by a range, at most one for each range
    cut = sums.filter("earlier > 0").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "earlier")
    joined = local.join(cut, (local["conv_id"] == cut["c"]) & (local["part"] == cut["p"]), "left")
    turns = joined.select("conv_id", (F.col("place") + F.coalesce("earlier", F.lit(0))).alias("place"), "a", "b", "words")
    return turns, sums.groupBy("conv_id").agg(F.sum("held").alias("turns"))


def with_shared_openings(turns: DataFrame, sizes: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of conversation c - c % ``every``, then c's own after its first h.

    h is crc32 of c in decimal, modulo ``most``. Returns (conv_id, depth, a, b, words) and (conv_id, turns).
    """
    source = F.col("conv_id") - F.col("conv_id") % every
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = sizes.select("conv_id", F.col("turns").alias("own"), source.alias("source"), opening.alias("h"))
    sources = sizes.select(F.col("conv_id").alias("s"), F.col("turns").alias("there"))
    plans = convs.join(sources, convs["source"] == sources["s"], "left").select(
        "conv_id", "source", "h", "own", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")
    )
    plans = settle(plans, "plans")
    # at most most - 1 turns a source, and every conversations a source
    firsts = turns.filter((F.col("place") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "from")
    shared = firsts.join(plans, (firsts["from"] == plans["source"]) & (firsts["place"] <= plans["taken"])).select(
        plans["conv_id"], F.col("place").alias("depth"), "a", "b", "words"
    )
    kept = plans.select(F.col("conv_id").alias("c"), "h", "taken")
    own = turns.join(kept, turns["conv_id"] == kept["c"]).filter("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "a", "b", "words"
    )
    lengths = plans.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))
    return own.unionByName(shared), lengths


def paths(turns: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """(conv_id, depth, words, x, y, px, py): the hashes of the first ``depth`` turns and of one turn less."""
    terms = turns.select(
        "conv_id", "depth", "words", F.xxhash64("depth", "a", "b").alias("ta"), F.xxhash64("b", "depth", "a").alias("tb"),
        F.floor(F.col("depth") / block).alias("part"),
    )
    inside = Window.partitionBy("conv_id", "part").orderBy("depth")
    local = terms.withColumns({"x": F.bit_xor("ta").over(inside), "y": F.bit_xor("tb").over(inside)})
    whole = terms.groupBy("conv_id", "part").agg(F.bit_xor("ta").alias("wa"), F.bit_xor("tb").alias("wb"))
    # one row for each block of a conversation
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.bit_xor("wa").over(before).alias("sa"), F.bit_xor("wb").over(before).alias("sb")
    ).filter("p > 0 AND sa IS NOT NULL")
    joined = local.join(starts, (local["conv_id"] == starts["c"]) & (local["part"] == starts["p"]), "left")
    zero = F.lit(0).cast("bigint")
    x, y = (F.col(name).bitwiseXOR(F.coalesce(start, zero)) for name, start in (("x", "sa"), ("y", "sb")))
    return joined.select(
        "conv_id", "depth", "words", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("ta")).alias("px"), y.bitwiseXOR(F.col("tb")).alias("py")
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end in a node, ascending.

    A digest takes its input in order, so a node's ids stream through one task; they are not held.
    """
    keys = ["depth", "x", "y"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            depth, x, y, conv = (c.to_numpy() for c in batch.columns)
            if not len(conv):
                continue
            out = []
            changed = (depth[1:] != depth[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            begins = np.flatnonzero(np.r_[True, changed])
            for i, j in zip(begins, np.r_[begins[1:], len(conv)], strict=True):
                key = (int(depth[i]), int(x[i]), int(y[i]))
                text = ",".join(map(str, conv[i:j].tolist())).encode()
                if key == last:
                    state.update(b"," + text)
                    continue
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = key, hashlib.sha256(text)
            yield _batch(out)
        if last is not None:
            yield _batch([(*last, state.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*keys, "ends_sha256"])

    rows = ends.select(*(F.col(k).cast("bigint") for k in keys), "conv_id")
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "conv_id")
    return ordered.mapInArrow(digest, "depth bigint, x bigint, y bigint, ends_sha256 string")


def trie_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, words, ends_sha256) of every node."""
    way = settle(paths(turns), "paths")
    zero = F.lit(0).cast("bigint")
    root = lengths.select("conv_id", zero.alias("depth"), zero.alias("words"), *(zero.alias(k) for k in ("x", "y", "px", "py")))
    at_root = settle(root.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0"), "root")
    own = way.groupBy("depth", "x", "y").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
        F.min("px").alias("px"), F.min("py").alias("py"),
    )
    own = settle(own, "nodes")
    # a conversation ends in the node of its last turn
    last = lengths.select(F.col("conv_id").alias("c"), "turns")
    ends = way.join(last, (way["conv_id"] == last["c"]) & (way["depth"] == last["turns"])).select("depth", "x", "y", "conv_id")
    ends = ends.unionByName(lengths.filter("turns = 0").select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id"))
    digests = ends_digest(ends)
    children = own.groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count("*").alias("n_children")
    )
    all_nodes = own.unionByName(at_root.select(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id", "n_convs", zero.alias("words"),
        F.lit(None).cast("bigint").alias("px"), F.lit(None).cast("bigint").alias("py"),
    ))
    keys = ["depth", "x", "y"]
    known = all_nodes.join(children, keys, "left").join(digests, keys, "left")
    # children of the root, however many, need no join; other parents are one row each
    deeper = known.filter("depth > 1").alias("n")
    parents = own.select(F.col("depth").alias("d"), F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("conv_id").alias("parent_conv_id"))
    found = deeper.join(
        parents, (F.col("n.depth") - 1 == F.col("d")) & (F.col("n.px") == F.col("qx")) & (F.col("n.py") == F.col("qy"))
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "words", "ends_sha256"]
    # one row, or none for an empty table
    first = [row[0] for row in at_root.select("conv_id").collect()]
    top = F.when(F.col("depth") == 1, F.lit(first[0] if first else None).cast("bigint"))
    shallow = known.filter("depth <= 1").withColumn("parent_conv_id", top)
    none = F.sha2(F.lit(""), 256)
    return found.select(*columns).unionByName(shallow.select(*columns)).withColumns(
        {"n_children": F.coalesce("n_children", zero), "ends_sha256": F.coalesce("ends_sha256", none)}
    )


def _ordered_siblings(nodes: DataFrame, block: int) -> DataFrame:
    """The nodes in blocks, by parent and then by conversation, with the next sibling's conversation."""
    count = nodes.count()
    order = ["parent_conv_id", "depth", "conv_id"]
    ranged = nodes.repartitionByRange(max(1, ceil(count / block)), *order).sortWithinPartitions(*order)
    light = ranged.select(*order, *(c for c in nodes.columns if c not in order))

    names = [*light.columns, "sibling", "part", "open"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row is given out when the row after it is known; the last row of a block stays open."""
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches(([held] if held is not None else []) + [batch]).combine_chunks()
            held = table.slice(table.num_rows - 1).to_batches()[0]
            if table.num_rows > 1:
                yield linked(table, part)
        if held is not None:
            yield linked(pa.Table.from_batches([held]), part, True)

    def linked(table: pa.Table, part: int, last: bool = False) -> pa.RecordBatch:
        n = 1 if last else table.num_rows - 1
        following = np.full(n, -1, dtype=np.int64)
        known = np.zeros(n, dtype=bool)
        if not last:
            parent = np.asarray(table.column(0).fill_null(0))
            without = np.asarray(table.column(0).is_null())
            depth, conv = np.asarray(table.column(1)), np.asarray(table.column(2))
            known = (parent[1:] == parent[:-1]) & (depth[1:] == depth[:-1]) & ~without[1:]
            following = conv[1:]
        rows = table.slice(0, n).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(following, pa.int64(), mask=~known), pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, last))],
            names=names,
        )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in light.schema) + ", sibling bigint, part int, open boolean"
    placed = settle(light.mapInArrow(link, schema), "siblings")
    # one row for each block
    heads = placed.groupBy("part").agg(F.min(F.struct(*order)).alias("head"))
    following = heads.select(F.col("part").alias("p"), F.lead("head").over(Window.orderBy("part")).alias("head"))
    open_rows = placed.filter("open").join(following, placed["part"] == following["p"], "left")
    same = (F.col("head.parent_conv_id") == F.col("parent_conv_id")) & (F.col("head.depth") == F.col("depth"))
    closed = open_rows.withColumn("sibling", F.when(same, F.col("head.conv_id"))).select(*placed.columns)
    return placed.filter("NOT open").unionByName(closed).drop("open")


ARC_SCHEMA = """conv_id bigint, d2 bigint, head_conv bigint, head_d2 bigint, next_conv bigint, next_d2 bigint, last boolean,
    arcs bigint, leaves bigint, saved bigint"""


def _block_runs(table: pa.Table) -> pa.Table:
    """Both arcs of a block's nodes: the first arc of the run they lie on, and the sums from there to them.

    An arc is (conversation, 2 * depth), plus 1 for an exit arc. The last arc of a run names the arc after it.
    """

    def column(name: str) -> tuple[np.ndarray, np.ndarray]:
        c = table.column(name)
        return np.asarray(c.fill_null(0)).astype(np.int64), np.asarray(c.is_null())

    conv, depth = column("conv_id")[0], column("depth")[0]
    (parent, orphan), (child, childless), (sibling, youngest) = column("parent_conv_id"), column("child"), column("sibling")
    n = len(conv)
    enter, leave = 2 * depth, 2 * depth + 1
    arc_conv, arc_d2 = np.r_[conv, conv], np.r_[enter, leave]
    next_conv = np.r_[np.where(childless, conv, child), np.where(youngest, parent, sibling)]
    next_d2 = np.r_[np.where(childless, leave, enter + 2), np.where(youngest, leave - 2, enter)]
    ends = np.r_[np.zeros(n, bool), youngest & orphan]
    weight = np.zeros((2 * n, 3), dtype=np.int64)
    weight[:, 0] = 1
    weight[:n, 1] = childless
    weight[:n, 2] = column("saving")[0]

    order = np.lexsort((arc_d2, arc_conv))
    keys = np.empty(2 * n, dtype=[("c", np.int64), ("d", np.int64)])
    keys["c"], keys["d"] = arc_conv[order], arc_d2[order]
    wanted = np.empty(2 * n, dtype=keys.dtype)
    wanted["c"], wanted["d"] = next_conv, next_d2
    at = np.searchsorted(keys, wanted).clip(max=2 * n - 1)
    inside = (keys[at] == wanted) & ~ends
    after = np.where(inside, order[at], -1)
    before = np.full(2 * n, -1)
    before[after[inside]] = np.flatnonzero(inside)
    # pointer doubling towards the first arc of the run
    total, far, head = weight.copy(), before.copy(), np.where(before < 0, np.arange(2 * n), before)
    while (far >= 0).any():
        moving = np.flatnonzero(far >= 0)
        to = far[moving]
        total[moving] += total[to]
        head[moving], far[moving] = head[to], far[to]
    return pa.table(
        {
            "conv_id": arc_conv, "d2": arc_d2, "head_conv": arc_conv[head], "head_d2": arc_d2[head],
            "next_conv": pa.array(next_conv, mask=ends | inside), "next_d2": pa.array(next_d2, mask=ends | inside),
            "last": ~inside, "arcs": total[:, 0], "leaves": total[:, 1], "saved": total[:, 2],
        }
    )


def _coin(conv: Column, d2: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(conv, d2, F.lit(turn)), F.lit(2)) == 1


def rank_list(runs: DataFrame, end: int = LIST_END) -> DataFrame:
    """(conv, d2, arcs, leaves, saved): the sums of all elements before each one of a linked list.

    ``runs``: (conv, d2, next_conv, next_d2, arcs, leaves, saved), the next null for the last one.
    """
    removed: list[DataFrame] = []
    left = settle(runs, "list")
    turn = 0
    while left.count() > end:
        heads = _coin(F.col("next_conv"), F.col("next_d2"), turn)
        tails = ~_coin(F.col("conv"), F.col("d2"), turn)
        goes = F.col("next_conv").isNotNull() & tails & heads
        # an element either stays under its own name or waits at the one after it, which cannot go itself
        keyed = left.withColumns({
            "key_conv": F.when(goes, F.col("next_conv")).otherwise(F.col("conv")),
            "key_d2": F.when(goes, F.col("next_d2")).otherwise(F.col("d2")), "waits": goes,
        })

        def of(waits: bool, name: str) -> Column:
            return F.max(F.when(F.col("waits") == waits, F.col(name)))

        met = keyed.groupBy("key_conv", "key_d2").agg(
            *(of(True, name).alias(f"w_{name}") for name in ("conv", "d2", *WEIGHTS)),
            *(of(False, name).alias(f"o_{name}") for name in ("next_conv", "next_d2", *WEIGHTS)),
        )
        met = settle(met, "contracted")
        taken = F.col("w_conv").isNotNull()
        removed.append(met.filter(taken).select("key_conv", "key_d2", "w_conv", "w_d2", *(f"w_{name}" for name in WEIGHTS)))
        left = met.select(
            F.coalesce("w_conv", "key_conv").alias("conv"), F.coalesce("w_d2", "key_d2").alias("d2"),
            F.col("o_next_conv").alias("next_conv"), F.col("o_next_d2").alias("next_d2"),
            *((F.col(f"o_{name}") + F.coalesce(f"w_{name}", F.lit(0))).alias(name) for name in WEIGHTS),
        )
        turn += 1

    def rank(table: pa.Table) -> pa.Table:
        """At most ``end`` elements, by pointer doubling from the last one back."""
        conv, d2 = np.asarray(table.column("conv")), np.asarray(table.column("d2"))
        n = len(conv)
        order = np.lexsort((d2, conv))
        keys = np.empty(n, dtype=[("c", np.int64), ("d", np.int64)])
        keys["c"], keys["d"] = conv[order], d2[order]
        wanted = np.empty(n, dtype=keys.dtype)
        wanted["c"], wanted["d"] = (np.asarray(table.column(c).fill_null(0)) for c in ("next_conv", "next_d2"))
        some = ~np.asarray(table.column("next_conv").is_null())
        after = order[np.searchsorted(keys, wanted).clip(max=n - 1)]
        before = np.full(n, -1)
        before[after[some]] = np.flatnonzero(some)
        own = np.stack([np.asarray(table.column(c)) for c in WEIGHTS], axis=1)
        total, far = own.copy(), before.copy()
        while (far >= 0).any():
            moving = np.flatnonzero(far >= 0)
            to = far[moving]
            total[moving] += total[to]
            far[moving] = far[to]
        return pa.table({"conv": conv, "d2": d2, **{c: (total - own)[:, k] for k, c in enumerate(WEIGHTS)}})

    schema = "conv bigint, d2 bigint, arcs bigint, leaves bigint, saved bigint"
    ranked = settle(left.groupBy(F.lit(0).alias("all")).applyInArrow(rank, schema), "ranked")
    for gone in reversed(removed):
        # an element taken in comes right after the one that took it, whose own weight at that time is known
        found = gone.join(ranked, (gone["w_conv"] == ranked["conv"]) & (gone["w_d2"] == ranked["d2"])).select(
            F.col("key_conv").alias("conv"), F.col("key_d2").alias("d2"), *((F.col(c) + F.col(f"w_{c}")).alias(c) for c in WEIGHTS)
        )
        ranked = settle(ranked.unionByName(found), "ranked")
    return ranked


def tour_sums(nodes: DataFrame, block: int = NODE_BLOCK, end: int = LIST_END) -> DataFrame:
    """The nodes with n_leaves and saved_tokens of their subtrees, and the places of their two arcs."""
    saving = (F.col("n_convs") - 1) * F.col("words")
    first = nodes.filter("depth > 0").groupBy("parent_conv_id", "depth").agg(F.min("conv_id").alias("child"))
    first = first.select(F.col("parent_conv_id").alias("q"), (F.col("depth") - 1).alias("d"), "child")
    joined = nodes.join(first, (nodes["conv_id"] == first["q"]) & (nodes["depth"] == first["d"]), "left")
    ordered = _ordered_siblings(joined.select("parent_conv_id", "depth", "conv_id", "child", saving.alias("saving")), block)
    arcs = settle(ordered.groupBy("part").applyInArrow(_block_runs, ARC_SCHEMA), "arcs")
    runs = arcs.filter("last").select(
        F.col("head_conv").alias("conv"), F.col("head_d2").alias("d2"), "next_conv", "next_d2", *WEIGHTS
    )
    starts = rank_list(runs, end).select(
        F.col("conv").alias("s_conv"), F.col("d2").alias("s_d2"), *(F.col(c).alias(f"s_{c}") for c in WEIGHTS)
    )
    placed = arcs.join(starts, (arcs["head_conv"] == starts["s_conv"]) & (arcs["head_d2"] == starts["s_d2"]))
    placed = placed.select("conv_id", "d2", *((F.col(c) + F.col(f"s_{c}")).alias(c) for c in WEIGHTS))

    def at(leaving: bool, name: str) -> Column:
        return F.max(F.when((F.col("d2") % 2 == 1) == leaving, F.col(name)))

    # one row for each node, its two arcs side by side
    both = placed.groupBy(F.col("conv_id").alias("c"), F.floor(F.col("d2") / 2).alias("d")).agg(
        *(at(leaving, name).alias(f"{name}_{'to' if leaving else 'from'}") for name in WEIGHTS for leaving in (False, True))
    )
    met = nodes.join(both, (nodes["conv_id"] == both["c"]) & (nodes["depth"] == both["d"]))
    # sums at the enter arc hold the node's own weight already
    leaf = (F.col("n_children") == 0).cast("bigint")
    return met.select(
        *nodes.columns, (F.col("leaves_to") - F.col("leaves_from") + leaf).alias("n_leaves"),
        (F.col("saved_to") - F.col("saved_from") + saving).alias("saved_tokens"),
        F.col("arcs_from").alias("enter"), F.col("arcs_to").alias("exit"),
    )


def opening_trie(turns: DataFrame, lengths: DataFrame, block: int = NODE_BLOCK, end: int = LIST_END) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, enter, exit of every node."""
    nodes = settle(trie_nodes(turns, lengths), "trie")
    return tour_sums(nodes, block, end).drop("words")
