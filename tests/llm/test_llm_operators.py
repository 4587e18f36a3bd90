"""Each operator against a brute-force version on rows with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corridor.llm import (
    content_sort,
    decontaminate,
    jaccard_join,
    kneser_ney,
    language,
    main_text,
    packing,
    prefix_counts,
    token_shards,
    toxicity,
)

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")

#: Columns whose names clash with the operators' own.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, start int, row string, kept string, score string"


def table(spark, rows):
    """(doc_id, text, lang) as documents with extra columns."""
    full = [(i, t, g, "s", len(t or ""), 1, "r", "k", "x") for i, t, g in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed: int, n: int, stems: str = "ab") -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(stems) + "".join(pick.choice("elorintas") for _ in range(pick.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    base = prose(1, 60)
    return [
        (1, base, "en"), (2, base, "en"), (2, base, "en"), (3, base.replace(" ", "  ") + "\n", None), (4, None, "en"), (5, "", "en"),
        (6, " \t\n", None), (None, "Only one. <|endoftext|> Don't, İstanbul ΟΔΟΣ", "en"), (8, prose(2, 9000), "en"),
        (9, "a b c", "fr"), (10, "a b c", "fr"), (11, "日本語 テスト 🎉🎉", None), (12, prose(3, 60) + " " + base, "en"), (12, "x", "en"),
    ]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_prefix_counts_at_every_prefix(spark, odd_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    got = prefix_counts.prefix_counts(table(spark, odd_rows), PIECE_FILE).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == sorted(
        (i or 0, len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in odd_rows
    )
    model = prefix_counts.PrefixModel(PIECE_FILE)
    for _, text, _ in odd_rows:
        text = (text or "")[:150]
        counts = np.cumsum(np.frombuffer(model.text_steps(text), np.int8), dtype=int)
        assert counts.tolist() == [len(library.encode(text[:k])) for k in range(1, len(text) + 1)]
    assert prefix_counts.prefix_counts(empty(spark), PIECE_FILE).count() == 0


def test_prefix_questions(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    text = prose(4, 30)
    counted = prefix_counts.prefix_counts(table(spark, [(1, text, None)]), PIECE_FILE)
    got = counted.selectExpr("steps", "20L AS chars", "15L AS budget").select(
        prefix_counts.tokens_at("steps", "chars").alias("n"), prefix_counts.longest_prefix("steps", "budget").alias("k")
    )
    row = got.first()
    assert row.n == len(library.encode(text[:20]))
    assert row.k == max(k for k in range(len(text) + 1) if len(library.encode(text[:k])) <= 15)


def test_shards_round_trip(spark, odd_rows):
    library = Tokenizer.from_file(WORD_FILE)
    folder = token_shards.shard_folder(spark)
    manifest = token_shards.write_shards(table(spark, odd_rows), folder, WORD_FILE, end_id=2)
    got = token_shards.read_shards(manifest, folder).orderBy("start").collect()
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 2]
    assert [r.doc_id or 0 for r in got] == sorted(i or 0 for i, _, _ in odd_rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((i, tuple(ids(t))) for i, t, _ in odd_rows)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    some = token_shards.read_shards(manifest, folder, wanted={8, 9}).collect()
    assert Counter((r.doc_id, r.start) for r in some) == Counter((r.doc_id, r.start) for r in got if r.doc_id in (8, 9))
    nothing = token_shards.shard_folder(spark)
    assert token_shards.read_shards(token_shards.write_shards(empty(spark), nothing, WORD_FILE, 2), nothing).count() == 0


def test_damaged_frames_are_noticed(tmp_path):
    import pyarrow.fs

    path = str(tmp_path / "one.zst")
    store = pyarrow.fs.LocalFileSystem()
    with store.open_output_stream(path, compression=None) as out:
        writer = token_shards.ShardWriter(out, frame_bytes=64)
        for k in range(20):
            writer.add(k, np.arange(k, dtype="<u4").tobytes())
        writer.close()
    with store.open_input_file(path) as file:
        shard = token_shards.ShardReader(file)
        assert [np.frombuffer(shard.document(k), "<u4").tolist() for k in range(20)] == [list(range(k)) for k in range(20)]
    data = bytearray(open(path, "rb").read())
    data[int(shard.offsets[2]) + 12] ^= 255
    open(path, "wb").write(data)
    with store.open_input_file(path) as file:
        shard = token_shards.ShardReader(file)
        shard.frame(0)
        with pytest.raises(Exception):  # noqa: B017  the library's or the seek table's checksum
            shard.frame(2)


def test_packing(spark, odd_rows):
    library = Tokenizer.from_file(WORD_FILE)
    pieces = packing.cut_pieces(table(spark, odd_rows), WORD_FILE, end_id=1, keep_ids=True)
    packed = packing.pack(pieces)
    got = packed.collect()
    want = Counter()
    for i, t, _ in odd_rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.update((i, k // 4096, k, tuple(ids[k : k + 4096])) for k in range(0, len(ids), 4096))
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got) == want
    rows = defaultdict(list)
    for r in got:
        rows[r.sequence_id].append((r.offset, r.length))
    for placed in rows.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(placed))]
        assert [o for o, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 4096
    whole = {r.sequence_id: len(r.ids) for r in packing.sequences(packed).collect()}
    assert whole == {k: sum(n for _, n in v) for k, v in rows.items()}
    assert packing.pack(packing.cut_pieces(empty(spark), WORD_FILE, 1)).count() == 0


def test_plan_equals_best_fit_decreasing_on_pieces():
    pick = random.Random(5)
    for _ in range(20):
        lengths = [pick.randint(1, 50) for _ in range(300)]
        slots = packing.plan(dict(Counter(lengths)), 50)
        free: list[int] = []
        for n in sorted(lengths, reverse=True):
            fits = [k for k, room in enumerate(free) if room >= n]
            if fits:
                free[min(fits, key=lambda k: free[k])] -= n
            else:
                free.append(50 - n)
        used = defaultdict(int)
        for length, first, end, sequence, per, _ in slots:
            for r in range(first, end):
                used[sequence + (r - first) // per] += length
        assert len(used) == len(free) and max(used.values()) <= 50
        assert sum(e - f for _, f, e, *_ in slots) == len(lengths)


def test_content_sort(spark, odd_rows):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t, _ in odd_rows:
        groups[plain(t)].append((-len(t or ""), i is None, i))
    got = content_sort.exact_groups(table(spark, odd_rows)).collect()
    want = Counter()
    for i, t, _ in odd_rows:
        best = min(groups[plain(t)])
        want[i, best[2], len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = content_sort.distinct_content(table(spark, odd_rows))
    assert kept.schema.names == empty(spark).schema.names and kept.count() == len(groups)
    assert content_sort.exact_groups(empty(spark)).count() == 0


def test_a_group_over_many_ranges(spark):
    rows = [(k, "same text", None) for k in range(3000)] + [(5000 + k, prose(k, 8), None) for k in range(200)]
    got = content_sort.exact_groups(table(spark, rows)).collect()
    same = [r for r in got if r.doc_id < 5000]
    assert {(r.keep_id, r.group_size) for r in same} == {(0, 3000)} and [r.doc_id for r in same if r.kept] == [0]


def _sets(rows):
    found = {}
    for k, (_, text, _) in enumerate(rows):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found[k] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else None
    return found


def test_jaccard_join(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rows = list(odd_rows)
    for g in range(6):
        words = prose(100 + g, 90).split()
        for c in range(14):
            changed = list(words)
            changed[random.Random(f"{g} {c}").randrange(90)] = f"new{c}"
            rows.append((1000 + 100 * g + c, " ".join(changed), "en"))
    sets = _sets(rows)
    different = list({s for s in sets.values() if s})
    links, near = Counter(), {s: {s} for s in different}
    for a, b in itertools.combinations(different, 2):
        if len(a & b) >= 0.8 * len(a | b):
            links[a] += 1
            links[b] += 1
            near[a].add(b)
            near[b].add(a)

    def group(s):
        seen, waiting = {s}, [s]
        while waiting:
            fresh = near[waiting.pop()] - seen
            seen |= fresh
            waiting += fresh
        return seen

    ids = defaultdict(list)
    for k, s in sets.items():
        ids[s].append(rows[k][0])
    got = jaccard_join.near_groups(table(spark, rows))
    want = Counter()
    for k, s in sets.items():
        if s is None:
            want[rows[k][0], rows[k][0], 0] += 1
        else:
            every = [i for x in group(s) for i in ids[x] if i is not None]
            want[rows[k][0], min(every, default=None), links[s]] += 1
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == want
    kept = jaccard_join.without_near_copies(table(spark, rows))
    groups = {frozenset(group(s)) for s in different}
    assert len({(r.doc_id, r.text) for r in kept.collect()}) == len(groups) + len({(rows[k][0], rows[k][1]) for k, s in sets.items() if s is None})
    assert jaccard_join.near_groups(empty(spark)).count() == 0


def test_jaccard_join_below_the_default(spark):
    # Pairs share 100 of 196 runs of five words, just above a half; no two pairs share one.
    rows = []
    for g in range(60):
        words = [f"g{g}w{k}" for k in range(104)]
        rows += [(2 * g + c, " ".join([*words, *(f"g{g}c{c}w{k}" for k in range(48))]), "en") for c in range(2)]
    got = jaccard_join.near_groups(table(spark, rows), similar=0.5).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == Counter((k, k - k % 2, 1) for k in range(120))
    assert not any(r.n_links for r in jaccard_join.near_groups(table(spark, rows)).collect())


def test_short_texts_alike_in_half_a_hash(spark):
    texts = [f"short text {k}" for k in range(200_000)]
    runs, _ = jaccard_join.shingles([t.encode() for t in texts])
    assert len(runs) == len(texts) == len(np.unique(runs))
    upper, counts = np.unique(runs >> np.uint64(32), return_counts=True)
    alike = np.flatnonzero(np.isin(runs >> np.uint64(32), upper[counts > 1]))
    assert len(alike) >= 2
    rows = [(int(k), texts[k], "en") for k in alike]
    got = jaccard_join.near_groups(table(spark, rows)).collect()
    assert all(r.doc_id == r.class_id == r.set_id and r.stays and not r.n_links for r in got)
    assert jaccard_join.without_near_copies(table(spark, rows)).count() == len(rows)


def test_all_that_the_sketch_misses_counts():
    for similar in (0.3, 0.5, 0.6, 0.8, 0.95):
        runs = jaccard_join.runs_needed(similar=similar)
        assert jaccard_join.missed_in_all(runs, similar=similar) <= 1 - jaccard_join.RECALL
        assert sum(jaccard_join.agreeing(similar)[: jaccard_join.least_agreeing(similar)]) < 1 - jaccard_join.RECALL
    assert (jaccard_join.runs_needed(), jaccard_join.least_agreeing()) == (3, 39)


def test_runs_reach_the_recall():
    assert jaccard_join.missed() ** jaccard_join.runs_needed() <= 1 - jaccard_join.RECALL


def test_components_of_chains(spark):
    edges = [(k + 1, k) for k in range(0, 40)] + [(100 + k, 100) for k in range(1, 30)] + [(7, 7)]
    got = jaccard_join.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in got} == {(k, 0) for k in range(41)} | {(100 + k, 100) for k in range(30)}


def test_decontamination(spark, odd_rows):
    passage = prose(50, 20)
    items = [(1, passage), (2, prose(51, 5)), (3, None), (4, "..."), (5, prose(52, 40)), (5, prose(53, 14)), (None, prose(54, 6))]
    rows = [*odd_rows, (20, f"Start, {passage.upper()}! end", "en"), (21, prose(60, 3000) + " " + passage, "en"),
            (22, " ".join(passage.split()[:13]), "en"), (23, " ".join(passage.split()[:12]), "en"), (24, prose(51, 5) + " " + prose(51, 5), "en"),
            (25, prose(54, 6), None)]
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = Counter()
    for i, text, _ in rows:
        w, hit, met = find(text), set(), set()
        for item, asked in items:
            a = find(asked)
            size = min(13, len(a))
            for k in range(len(a) - size + 1 if a else 0):
                for j in range(len(w) - size + 1):
                    if w[j : j + size] == a[k : k + size]:
                        hit |= set(range(j, j + size))
                        met.add("" if item is None else str(item))
        want[i, len(w), len(hit), ",".join(sorted(met)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(table(spark, rows), benchmark)
    assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got.collect()) == want
    blocks = decontaminate.find_phrases(decontaminate.build_index(table(spark, rows)), benchmark, most=60)
    again = Counter((r.doc_id, ",".join(r["items"])) for r in blocks.collect())
    assert again == Counter({(k[0], k[3]): 0 for k in want} | Counter((k[0], k[3]) for k in want.elements()))
    clashing = table(spark, rows).selectExpr("*", "0 AS row_key")
    kept = decontaminate.clean_rows(clashing, benchmark)
    assert kept.columns == clashing.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k in want.elements() if not k[4])
    assert decontaminate.contamination(empty(spark), benchmark).count() == 0
    assert decontaminate.contamination(table(spark, rows), benchmark.limit(0)).filter("n_hit > 0").count() == 0


def test_benchmark_blocks_are_settled_one_by_one(spark, monkeypatch):
    rows = [(k, prose(k, 40), "en") for k in range(30)] + [(None, None, None)]
    benchmark = spark.createDataFrame([(k, rows[k][1][20:150]) for k in range(8)], "item_id bigint, text string")
    whole = sorted(map(str, decontaminate.contamination(table(spark, rows), benchmark).drop("segment", "doc").collect()))
    events, fetch, settle = [], decontaminate.phrase_blocks, decontaminate.settle

    def fetched(*args):
        for block in fetch(*args):
            events.append("fetch")
            yield block

    monkeypatch.setattr(decontaminate, "phrase_blocks", fetched)
    monkeypatch.setattr(decontaminate, "settle", lambda *args: (events.append("settle"), settle(*args))[1])
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 250)
    got = decontaminate.contamination(table(spark, rows), benchmark).drop("segment", "doc")
    assert events.count("fetch") > 2 and ("fetch", "fetch") not in itertools.pairwise(events)
    assert sorted(map(str, got.collect())) == whole


def test_language_sample(spark):
    rows = [(None, f"unnamed text {k}", "aa") for k in range(3000)] + [(7, f"text {k} of one id", "bb") for k in range(3000)]
    rows += [(8, "the same text", "cc")] * 3000 + [(k, f"text {k}", "dd") for k in range(20)]
    got = Counter(r.lang for r in language.draw(table(spark, rows), "doc_id", "text", "lang", 100).collect())
    assert 60 < got["aa"] < 150 and 60 < got["bb"] < 150 and got["cc"] == 1 and got["dd"] == 20


def test_near_words(spark):
    rows = [(1, "alpha one two beta", None), (2, "alpha one two three four five beta", None), (3, "beta alpha", None), (4, None, None)]
    items = spark.createDataFrame([(7, "alpha beta")], "item_id bigint, text string")
    got = decontaminate.find_near(decontaminate.build_index(table(spark, rows)), items, within=3)
    assert {r.doc_id for r in got.collect()} == {1, 3}


def test_language(spark):
    rows = [(k, prose(k, 40, "ab"), "aa") for k in range(60)] + [(100 + k, prose(k, 40, "xyz").replace("a", "ü"), "bb") for k in range(60)]
    held = [(900, prose(7000, 30, "ab"), None), (901, prose(7001, 30, "xyz").replace("a", "ü"), None), (902, None, "aa"), (903, "12 ?", "bb"), (904, "", None)]
    docs = table(spark, rows + held)
    model = language.learn(docs)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 904)] == ["aa", "bb", "und", "und", "und"]
    assert all(got[i].lang_pred == g and 0 < got[i].score <= 1 and not got[i].rejected for i, _, g in rows)
    assert all(got[i].score == 0 and got[i].rejected for i in (902, 903, 904))
    nothing = language.learn(empty(spark))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_language_learns_from_every_row(spark):
    rows = [(k, prose(k, 12, "ab"), "aa") for k in range(1500)] + [(5000 + k, prose(k, 12, "xyz"), "bb") for k in range(10)]
    rare = [(9000, prose(9000, 12).translate(str.maketrans("elorintasb", "βγδζθκλμνξ")), "aa")]
    docs = table(spark, rows + rare)
    model = language.learn(docs)
    # the one row of other letters has a centroid of its own
    assert model.nearest(rare[0][1])[:2] == ("aa", pytest.approx(1))
    # the split and order of rows change nothing
    split = language.learn(docs.repartition(7))
    assert (split.centers == model.centers).all() and split.floor == model.floor
    # what the rows say when clustered at once
    frequency = sum(language.grams(text) > 0 for _, text, _ in rows + rare)
    assert np.allclose(model.weight, np.log((1 + len(rows + rare)) / (1 + frequency)) + 1, atol=1e-5)
    texts = [text for _, text, name in rows + rare if name == "aa"]
    nearest = [max(model.vector(text) @ model.centers[:, model.owner == 0]) for text in texts]
    assert abs(model.floor["aa"] - language.SLACK * np.quantile(nearest, 0.01)) < 1e-4


def test_toxicity_on_held_out_rows(spark):
    pick = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        words = prose(3000 + k, pick.randint(5, 120)).split()
        toxic = k % 4 == 0
        for _ in range(2 * toxic):
            words.insert(pick.randint(0, len(words)), pick.choice(["vileone", "viletwo", "wretch"]))
        rows.append((k, " ".join(words), "en"))
        labels.append((k, int(toxic)))
    model = toxicity.fit([t for _, t, _ in rows[:300]], [y for _, y in labels[:300]])
    extra = [(1000, None, "en"), (1001, "", None), (1002, "12", "en"), (1003, "", None)]
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, rows + extra), model).collect()}
    assert np.mean([(got[k] >= 0.5) == bool(y) for k, y in labels[300:]]) > 0.95
    assert got[1000] == got[1001] == got[1002] < 0.5
    labelled = spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id bigint, toxic int")
    texts, known = toxicity.labelled_sample(table(spark, rows), labelled, most_rows=40)
    assert Counter(known) == {0: 40, 1: 40}
    scored = toxicity.score(table(spark, rows), model, carry=("lang",)).join(labelled, "doc_id")
    assert {r.lang for r in toxicity.thresholds(scored).collect()} == {None, "en"}
    flat = toxicity.fit(["a", "b"], [0, 0])
    assert flat.scores(["a", ""]).max() < 1e-9 and toxicity.fit([], []).scores(["a"])[0] < 1e-9


def _brute_model(texts, order):
    """Interpolated modified Kneser-Ney straight from the definition, over tuples."""
    raw = Counter()
    for t in texts:
        padded = [0] * (order - 1) + [max(1, ord(c)) for c in t]
        raw.update(tuple(padded[k : k + order]) for k in range(len(t)))
    counts = {order: raw}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    letters = len(counts[1]) + 1

    def cut(n, c):
        k = [sum(v == x for v in counts[n].values()) for x in (1, 2, 3, 4)]
        if not k[0] or not k[1]:
            return [0.5, 0.75, 0.9][min(c, 3) - 1]
        y = k[0] / (k[0] + 2 * k[1])
        d = [x - (x + 1) * y * k[x] / k[x - 1] if k[x - 1] else x / 2 for x in (1, 2, 3)]
        return min(max(d[min(c, 3) - 1], 0.05), min(c, 3) - 0.05)

    cuts = {n: {c: cut(n, c) for c in (1, 2, 3)} for n in counts}
    by_context = {n: defaultdict(dict) for n in counts}
    for n, found in counts.items():
        for g, c in found.items():
            by_context[n][g[:-1]][g[-1]] = c

    def p(n, g):
        if n == 0:
            return 1 / letters
        seen = by_context[n].get(g[:-1])
        below = p(n - 1, g[1:])
        if not seen:
            return below
        total = sum(seen.values())
        weight = sum(cuts[n][min(c, 3)] for c in seen.values()) / total
        own = seen.get(g[-1], 0)
        return (own - cuts[n][min(own, 3)]) / total + weight * below if own else weight * below

    return p


def test_kneser_ney(spark, tmp_path):
    texts = [prose(k, 30) for k in range(12)]
    rows = [(k, t, "en") for k, t in enumerate(texts)]
    others = [(50, "qqq zzz!", "en"), (51, None, None), (52, "", "en"), (53, prose(99, 20), "fr"), (53, prose(98, 5), "fr"), (54, "日本", "en")]
    trusted = table(spark, rows)
    model = kneser_ney.train(trusted)
    path = str(tmp_path / "docs.parquet")
    table(spark, rows + others).write.parquet(path)
    got = Counter((r.doc_id, r.n_chars, None if r.perplexity is None else round(r.perplexity, 6)) for r in kneser_ney.score(spark.read.parquet(path), model).collect())
    order, p = kneser_ney.ORDER, _brute_model(texts, kneser_ney.ORDER)
    want = Counter()
    for i, t, _ in rows + others:
        codes = [0] * (order - 1) + [ord(c) if ord(c) < 0xF00 else 0xF00 + ord(c) % 0xFF for c in t or ""]
        total = sum(np.log(p(order, tuple(codes[k : k + order]))) for k in range(len(t or "")))
        want[i, len(t or ""), round(float(np.exp(-total / len(t))), 6) if t else None] += 1
    assert got == want
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 1), (2, 0), (None, 1)], "doc_id bigint, quality int")
    assert {r.doc_id for r in kneser_ney.trusted_rows(trusted, labels).collect()} == {0, 1}
    unnamed = str(tmp_path / "unnamed.parquet")
    table(spark, [(None, texts[0], "en"), (None, texts[0], "fr"), (7, texts[0], None), (7, texts[0], "en")]).write.parquet(unnamed)
    carried = kneser_ney.score(spark.read.parquet(unnamed), model, carry=("lang", "start")).collect()
    assert Counter((r.doc_id, r.lang, r.start) for r in carried) == Counter([(None, "en", 1), (None, "fr", 1), (7, None, 1), (7, "en", 1)])
    assert len({r.perplexity for r in carried}) == 1
    untaught = kneser_ney.train(empty(spark))
    assert kneser_ney.score(trusted, untaught).filter("perplexity IS NULL").count() == 0
    assert kneser_ney.score(empty(spark), model).count() == 0


def test_kneser_ney_thresholds(spark):
    schema = "lang string, n_chars bigint, perplexity double"
    trusted = [("en", 2000, 4 + k / 100) for k in range(100)] + [("en", 20, 9 + k / 100) for k in range(100)]
    trusted += [("de", 2000, 3.0)] * 60 + [("de", 20, 2.0)] * 3 + [(None, 90_000, 1.0), ("fr", 0, None)]
    limits = kneser_ney.thresholds(spark.createDataFrame(trusted, schema))
    asked = [("en", 2000), ("en", 20), ("de", 1024), ("de", 20), ("de", 90_000), (None, 4095), ("fr", 63), ("fr", 300)]
    rows = spark.createDataFrame([(*x, 5.5) for x in asked], schema)
    got = {(r.lang, r.n_chars): r.threshold for r in kneser_ney.with_thresholds(rows, limits).collect()}
    # Of its band and language; of its band; of its language; of all. No limit is above a trusted text.
    assert got == {
        ("en", 2000): 4.98, ("en", 20): 9.98, ("de", 1024): 3.0, ("de", 20): 9.98, ("de", 90_000): 3.0, (None, 4095): 4.98,
        ("fr", 63): 9.98, ("fr", 300): 9.97,
    }
    none = kneser_ney.thresholds(spark.createDataFrame([], schema))
    assert {r.threshold for r in kneser_ney.with_thresholds(rows, none).collect()} == {None}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><p>Site name, a long slogan that reads like text, really.</p></header><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, as you know, and so on, for a better site.</p></div>
%s
<aside><p>Read more, much more, of our other pages here, today.</p></aside><form><p>Your mail, please, for our letters.</p></form>
<section id="comments"><article class="comment"><p>First, I must say, this is a long comment, longer than the article.</p></article></section>
<footer>&copy; 2024, all of it, ours.</footer>"""


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><h1>Head</h1><p><b>One &amp; two,<br>three.<p>Four\n  five.</p><div class=ad>Buy, buy, buy now.</div><p>x</p></article>",
         "Head\n\nOne & two, three.\n\nFour five.\n\nx"),
        ("<div class=content><h2>Head</h2><div class=body><p>A first paragraph, of some length, to be kept whole.</p><p>Short.</p>"
         "<blockquote>Quoted, as it is.</blockquote></div></div>",
         "Head\n\nA first paragraph, of some length, to be kept whole.\n\nShort.\n\nQuoted, as it is."),
        ("<main><p>Text, in main.<ul><li>one<li>two</ul><!-- no --></main>", "Text, in main.\n\none\n\ntwo"),
    ],
)
def test_main_text(body, text):
    assert main_text.main_text(PAGE % body) == text


LONG = ("A long sentence, of many words, with commas, that goes on, and on, until it is long. " * 4).strip()
LINKS = "<ul><li><a href=/1>First source</a><li><a href=/2>Second source</a><li><a href=/3>Third source</a></ul>"


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<main><section><p>{LONG}</p><p>{LONG}</p></section><section><p>short end</p></section></main>", [LONG, LONG, "short end"]),
        (f"<div><section><p>{LONG}</p><p>{LONG}</p></section>bare <b>text</b><section><div>short end</div></section>{LINKS}<a href=/m>More</a></div>",
         [LONG, LONG, "bare text", "short end"]),
        (f"<article><p>{LONG}</p>{LINKS}</article>", [LONG, "First source", "Second source", "Third source"]),
        (f"<article><p>{LONG}</p><p>Then <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x = 1</annotation></math> holds.</p></article>",
         [LONG, "Then x=1 holds."]),
        (f"<article class='post comments-open'><p>{LONG}</p></article>", [LONG]),
        (f"<div class='with-replies discussion'><article><p>{LONG}</p></article></div>", [LONG]),
        (f"<article><p>{LONG}</p></article><div class=replies><article><p>{LONG} {LONG}</p></article></div>", [LONG]),
        # names that tell a layout or a subject, not a part
        (f"<div class='has-sidebar content'><p>{LONG}</p><p>{LONG}</p></div>", [LONG, LONG]),
        (f"<div class='page sidebar-right'><p>{LONG}</p><p>{LONG}</p></div>", [LONG, LONG]),
        (f"<article><h2 id='related-work'>Related work</h2><p>{LONG}</p><section id='menu-design'><p>Of menus.</p></section>"
         f"<div id='sharing-economy'><p>Of sharing.</p></div></article>", ["Related work", LONG, "Of menus.", "Of sharing."]),
        (f"<article><h2 class='share related'>Shares</h2><p>{LONG}</p><div class='related-posts'><p>Read this.</p></div>"
         f"<div id='share'><p>Tell others.</p></div></article>", ["Shares", LONG]),
        (f"<article><div class='widget post-content'><p>{LONG}</p><p>{LONG}</p></div><p>end</p></article>", [LONG, LONG, "end"]),
        (f"<div class='sidebar'><p>{LONG} {LONG} {LONG}</p></div><article><p>{LONG}</p></article>", [LONG]),
        # containers that are not direct siblings
        (f"<div><div><p>{LONG}</p></div></div><div><div><p>{LONG}</p></div></div>", [LONG, LONG]),
        (f"<div><div><div><p>{LONG}</p><p>{LONG}</p></div></div></div><div><p>A shorter end, but an end.</p></div>{LINKS}",
         [LONG, LONG, "A shorter end, but an end."]),
    ],
)
def test_main_text_is_whole(body, text):
    assert main_text.main_text(PAGE % body) == "\n\n".join(text)


def test_pages(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "<p>" * 3000 + "deep", "x"), (3, None, "<div>" * 3000 + "deep, text", "x"), (4, "u", "no <markup", "x"), (5, "u", "<!-- open", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in main_text.extract(pages).collect())
    assert got == Counter(
        [(1, "u", "", 0), (2, "u", "", 0), (3, None, "deep", 4), (3, None, "deep, text", 10), (4, "u", "no <markup", 10), (5, "u", "", 0)]
    )
    assert main_text.extract(pages.limit(0)).count() == 0
