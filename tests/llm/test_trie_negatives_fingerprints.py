"""Prefix trie, hard negatives and fingerprints against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from corridor.llm import hard_negatives, prefix_trie, winnowing

TURNS = "conv_id bigint, turn bigint, role string, text string, place int, a string, part string, depth int"


def conversations(spark, rows):
    """Turns with extra columns that the operator uses as names of its own."""
    return spark.createDataFrame([(*r, 7, "a", "p", 9) for r in rows], TURNS).repartition(3)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def brute_trie(rows):
    whole, members = rebuilt(rows), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def words(path):
        return len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0

    below = defaultdict(lambda: [0, 0])
    for path, convs in members.items():
        for d in range(len(path) + 1):
            below[path[:d]][0] += not children[path]
            below[path[:d]][1] += (len(convs) - 1) * words(path)
    return sorted(
        (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]), *below[path],
         hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path)).encode()).hexdigest())
        for path, convs in members.items()
    )


def trie_of(spark, rows, **sizes):
    turns, lengths = prefix_trie.numbered_turns(conversations(spark, rows))
    return prefix_trie.opening_trie(*prefix_trie.with_shared_openings(turns, lengths), **sizes)


@pytest.fixture(scope="module")
def odd_turns():
    pick = random.Random(5)
    rows = [(c, t, pick.choice(["u", "s", None]), pick.choice(["hi", "go on", None, "", "a\tb  c"])) for c in range(90) for t in range(pick.randint(0, 5))]
    rows += [(200 + c, t, "u", "same") for c in range(60) for t in range(3)]  # a third open alike
    rows += [(-17, 0, "u", "x y"), (-17, None, None, None), (-17, 0, "u", "x y"), (-17, 0, "u", "a")]  # ties, repeats, null turn
    rows += [(None, 0, "u", "lost"), (None, None, None, None)]
    rows += [(400, t, "u", f"long {t % 3}") for t in range(60)] + [(401, 0, "u", "日本語 x")] + [(420, 0, "s", "y" * 5000)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block": 16, "end": 8}])
def test_trie(spark, odd_turns, sizes):
    got = trie_of(spark, odd_turns, **sizes).collect()
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(tuple(r[c] for c in columns) for r in got) == brute_trie(odd_turns)
    # the arcs are one closed tour: places 1 to twice the nodes, children inside their parents
    assert sorted([r["enter"] for r in got] + [r["exit"] for r in got]) == list(range(1, 2 * len(got) + 1))
    spans = {(r["conv_id"], r["depth"]): (r["enter"], r["exit"]) for r in got}
    for r in got:
        if r["depth"]:
            outer = spans[r["parent_conv_id"], r["depth"] - 1]
            assert outer[0] < r["enter"] < r["exit"] < outer[1]


def test_trie_of_nothing_and_of_one(spark):
    assert trie_of(spark, []).count() == 0
    assert trie_of(spark, [(None, 1, "u", "x")]).count() == 0
    # a conversation whose turns are all given to an opening that is not there has none
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    (row,) = trie_of(spark, [(lone, 0, "u", "x")]).collect()
    assert (row["conv_id"], row["depth"], row["parent_conv_id"], row["n_convs"], row["n_leaves"]) == (lone, 0, None, 1, 1)


def test_paths_in_blocks_of_turns(spark):
    rows = [(c, d, d * c % 7, d % 5, 1) for c in (1, 2) for d in range(1, 40)]
    turns = spark.createDataFrame(rows, "conv_id bigint, depth bigint, a bigint, b bigint, words bigint")
    whole, cut = (sorted(map(tuple, prefix_trie.paths(turns, block).collect())) for block in (1000, 4))
    assert whole == cut


@pytest.mark.parametrize("end", [4, 1000])
def test_list_ranking_in_any_order(spark, end):
    pick = random.Random(1)
    names = [(i, pick.randint(0, 5)) for i in range(300)]
    pick.shuffle(names)
    weights = [(1, pick.randint(0, 3), pick.randint(0, 9)) for _ in names]
    following = [*names[1:], (None, None)]
    rows = [(*n, *f, *w) for n, f, w in zip(names, following, weights, strict=True)]
    pick.shuffle(rows)
    runs = spark.createDataFrame(rows, "conv bigint, d2 bigint, next_conv bigint, next_d2 bigint, arcs bigint, leaves bigint, saved bigint")
    got = {(r["conv"], r["d2"]): tuple(r)[2:] for r in prefix_trie.rank_list(runs, end).collect()}
    sums = (0, 0, 0)
    for name, w in zip(names, weights, strict=True):
        assert got[name] == sums
        sums = tuple(x + y for x, y in zip(sums, w, strict=True))


VECTORS = "vec_id bigint, embedding array<float>, label int, row string, id string, score int"


def brute_negatives(rows):
    kept = [
        (i, [math.floor(256 * x) for x in v], g) for i, v, g in rows
        if i is not None and v is not None and g is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for k, (i, v, g) in enumerate(kept):
        if i % 10:
            continue
        others = sorted((-score(v, w), j, q) for m, (j, w, q) in enumerate(kept) if m != k)
        for s, j in [(-s, j) for s, j, q in others if q == g][:5]:
            hits = [(j2, -n) for n, j2, q in others if q != g and 80 * s <= -100 * n <= 100 * s][:5]
            out += [(i, j, r, j2, s, n) for r, (j2, n) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 8192, 1 << 20), (7, 16, 64)])
def test_hard_negatives(spark, monkeypatch, blocks):
    for name, size in zip(("ANCHOR_BLOCK", "ROW_BLOCK", "TILE"), blocks, strict=True):
        monkeypatch.setattr(hard_negatives, name, size)
    pick = random.Random(3)
    # few different components, so that scores tie; half of the rows have one label
    rows = [(i, [pick.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)], pick.choice([1, 1, 1, 2, 3])) for i in range(300)]
    rows += [(310, None, 1), (320, [1.0, None, 0.0, 0.0], 1), (330, [float("nan")] * 4, 1), (340, [float("inf")] * 4, 2), (350, [0.5] * 4, None)]
    rows += [(None, [0.5] * 4, 1), (360, [], 1), (361, [0.5, 0.25], 2), (370, [0.5] * 4, 9), (10, rows[10][1], rows[10][2]), (20, [0.5] * 4, 3)]
    table = spark.createDataFrame([(*r, "r", "i", 5) for r in rows], VECTORS).repartition(4)
    got = hard_negatives.mine(table, F.col("id") % 10 == 0)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == brute_negatives(rows)
    assert hard_negatives.mine(table.limit(0), F.col("id") % 10 == 0).count() == 0


def test_large_components_stay_exact(spark):
    big = float(2**23 + 1)
    rows = [(0, [big, 1.0], 1), (1, [big, 0.00390625], 1), (2, [big - 1, 1.0], 2), (3, [1.0, big], 2)]
    table = spark.createDataFrame([(*r, "r", "i", 5) for r in rows], VECTORS)
    got = hard_negatives.mine(table, F.col("id") == 0).select("negative_id", "positive_score", "negative_score").collect()
    assert [tuple(r) for r in got] == [(2, (2**31 + 256) ** 2 + 256, (2**31 + 256) * 2**31 + 2**16)]


def brute_marks(text, gram, window):
    raw = text.encode()
    if not raw:
        return []
    grams = [raw[i : i + gram] for i in range(len(raw) - gram + 1)] or [raw]
    hashes = [xxhash.xxh64_intdigest(x, 42) % 2**49 for x in grams]
    signed = [h - 2**49 if h >= 2**48 else h for h in hashes]
    kept = []
    for s in range(max(1, len(hashes) - window + 1)):
        j = min(range(s, min(s + window, len(hashes))), key=lambda j: (signed[j], -j))
        if kept[-1:] != [j]:
            kept.append(j)
    return [(hashes[j], j) for j in kept]


@pytest.mark.parametrize(("gram", "window", "part"), [(12, 16, 8192), (5, 4, 7), (3, 6, 20), (4, 1, 5)])
def test_marks(spark, gram, window, part):
    pick = random.Random(7)
    texts = ["", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語 🎉 Ωδός " * 5, "x" * gram, "ab" * window]
    texts += ["".join(pick.choice("ab c") for _ in range(pick.randint(1, 90))) for _ in range(30)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "k int, text string")
    got = rows.select("k", winnowing.marks(F.col("text"), gram, window, part).alias("m")).collect()
    for r in got:
        assert [tuple(x) for x in r["m"]] == brute_marks((texts[r["k"]] if r["k"] < len(texts) else ""), gram, window)


def test_shared_runs_share_a_mark():
    pick = random.Random(11)
    size = winnowing.guaranteed(5, 4)
    for _ in range(200):
        run = "".join(pick.choice("abcd") for _ in range(size))
        one, two = (brute_marks("".join(pick.choice("abcd") for _ in range(20)) + run + "zz", 5, 4) for _ in range(2))
        assert {h for h, _ in one} & {h for h, _ in two}


DOCS = "doc_id bigint, text string, block string, id string, beyond string, marks int, own int"


@pytest.mark.parametrize("block_bytes", [1 << 22, 300])
def test_fingerprints_beside_edits(spark, block_bytes):
    pick = random.Random(9)
    texts = ["".join(pick.choice("abcdé ") for _ in range(pick.choice([0, 1, 5, 30, 31, 80, 400]))) for _ in range(60)]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(5, None), (6, ""), (9, texts[3]), (9, texts[3]), (12, "abc"), (12, "abd")]
    rows += [(None, "no id at all"), (None, None), (1000, "日本語テスト 🎉🎉" * 3), (1001, "lang " * 4000)]
    table = spark.createDataFrame([(*r, "b", "i", "y", 1, 2) for r in rows], DOCS).repartition(3)
    got = winnowing.compared_with_edits(table, block_bytes=block_bytes).collect()
    plain = sorted(((i is not None, i or 0, t or "") for i, t in rows), key=lambda r: (not r[0], -r[1], r[2]))

    def mark_text(found):
        return " ".join(f"{h | 1 << 49:X}:{at}" for h, at in found)

    def alike(a, b):
        x, y = {h for h, _ in a}, {h for h, _ in b}
        return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0

    want = []
    for k, (has, i, text) in enumerate(plain):
        following = plain[(k + 1) % len(plain)][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (brute_marks(x, winnowing.GRAM, winnowing.WINDOW) for x in (text, edited, following))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want.append((i if has else -1, len(text), sha, mark_text(a), mark_text(b), round(alike(a, b), 12), round(alike(a, c), 12)))
    columns = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    found = [(-1 if r["doc_id"] is None else r["doc_id"], *(r[c] for c in columns), round(r["near_edited"], 12), round(r["near_next"], 12)) for r in got]
    assert sorted(found) == sorted(want)


def test_fingerprints_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], DOCS)
    assert winnowing.compared_with_edits(none).count() == 0 and winnowing.fingerprints(none).count() == 0
    one = spark.createDataFrame([(1, "a single text that follows itself", "b", "i", "y", 1, 2)], DOCS)
    (row,) = winnowing.compared_with_edits(one).collect()
    assert row["near_next"] == 1.0 and row["edited_sha256"] != hashlib.sha256(b"").hexdigest()
    assert winnowing.fingerprints(one).first()["fingerprint"] == row["fingerprint"]
