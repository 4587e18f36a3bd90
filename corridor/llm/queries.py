"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import (
    content_sort,
    decontaminate,
    hard_negatives,
    jaccard_join,
    kneser_ney,
    language,
    main_text,
    packing,
    prefix_counts,
    prefix_trie,
    token_shards,
    toxicity,
    winnowing,
)
from corridor.session import settle
from corridor.workload.registry import query

TOKEN_LIMIT = 4096
TOXIC_FROM = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int) -> F.Column:
    """crc32 of the id as text, modulo ``divisor``; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query("op1_prefix_token_counts")
def prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_counts.prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "steps")


@query("op2_toxicity_cnn")
def toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # Only rows outside the held-out third teach; the language only names a row's threshold afterwards.
    open_labels = labels.filter(remainder(3) != 1)
    model = toxicity.fit(*toxicity.labelled_sample(docs, open_labels))
    scored = settle(toxicity.score(docs, model, carry=("lang",)), "scores")
    limits = settle(toxicity.thresholds(scored.join(open_labels.select("doc_id", "toxic"), "doc_id")), "thresholds")
    # One row for each language with enough toxic labels and one for the rest.
    general = limits.filter("lang IS NULL").select(F.col("threshold").alias("general"))
    own = limits.filter("lang IS NOT NULL")
    judged = scored.join(own, "lang", "left").withColumn("threshold", F.coalesce("threshold", F.lit(general.first()[0])))
    return judged.select(
        "doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "lang", "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )


@query("op3_language_centroids")
def language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.filter(remainder(4) != 2))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


@query("op4_kneser_ney_quality")
def kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    model = kneser_ney.train(kneser_ney.trusted_rows(docs, table(spark, sf_dir, "labels")))
    scored = settle(kneser_ney.score(docs, model, carry=("lang",)), "perplexities")
    limits = settle(kneser_ney.thresholds(scored.join(good, "doc_id", "left_semi")), "limits")
    judged = kneser_ney.with_thresholds(scored, limits)
    return judged.select(
        "doc_id", "lang", "n_chars", "log_prob", "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"),
    )


@query("op5_seekable_token_shards")
def seekable_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_shards.shard_folder(spark)
    docs = table(spark, sf_dir, "documents")
    manifest = token_shards.write_shards(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_shards.read_shards(manifest, folder, with_ids=False)


@query("op6_main_text")
def extracted_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


@query(
    "op7_content_sort_dedup",
    """
    WITH plain AS (
      SELECT doc_id, coalesce(length(text), 0) AS n,
             regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS same
      FROM documents
    ), placed AS (
      SELECT doc_id, same,
             first_value(doc_id) OVER w AS keep_id,
             row_number() OVER w AS place,
             count(*) OVER (PARTITION BY same) AS group_size
      FROM plain
      WINDOW w AS (PARTITION BY same ORDER BY n DESC, doc_id NULLS LAST)
    )
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(same) AS text_sha256
    FROM placed
    """,
)
def content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(table(spark, sf_dir, "documents"))


@query("op8_histogram_packing")
def histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


@query("op9_chosen_path_jaccard")
def chosen_path_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_join.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "class_id", "set_id", "n_links", "n_shingles")


def _window_words(name: str, key: str) -> str:
    return f"""SELECT {key}, row_number() OVER () AS row_no,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM {name}"""


@query(
    "op10_positional_decontamination",
    f"""
    WITH d AS ({_window_words("documents", "doc_id")}),
    b AS ({_window_words("benchmark", "item_id")}),
    asked AS (
      SELECT DISTINCT item_id, least(13, len(w)) AS size,
             array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS phrase
      FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS u(k)
      WHERE len(w) > 0
    ),
    sizes AS (SELECT DISTINCT size FROM asked),
    spots AS (
      SELECT row_no, k, size, array_to_string(w[k : k + size - 1], ' ') AS phrase
      FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)
    ),
    met AS (SELECT row_no, k, size, item_id FROM spots JOIN asked USING (size, phrase)),
    hit AS (
      SELECT row_no, count(DISTINCT place) AS n_hit
      FROM (SELECT row_no, unnest(range(k, k + size)) AS place FROM met) GROUP BY row_no
    ),
    items AS (
      SELECT row_no, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT row_no, coalesce(CAST(item_id AS VARCHAR), '') AS id FROM met) GROUP BY row_no
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (row_no) LEFT JOIN items USING (row_no)
    """,
)
def positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query(
    "op11_conversation_prefix_trie",
    """
    WITH turns AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
      FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
      SELECT conv_id, conv_id - conv_id % 20 AS source,
             -- crc32 of the decimal id, bit by bit; its last two bits are those of h
             xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT),
                            list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda state, byte: list_reduce(
                 list_prepend(xor(state, byte), CAST(range(8) AS BIGINT[])),
                 lambda bits, step: CASE WHEN bits % 2 = 1 THEN xor(bits >> 1, CAST(3988292384 AS BIGINT)) ELSE bits >> 1 END)
             ), CAST(4294967295 AS BIGINT)) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM turns)
    ), rebuilt AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth, role, text
      FROM (
        SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.source WHERE t.place <= c.h
        UNION ALL
        SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE t.place > c.h
      )
    ), opened AS (
      SELECT conv_id, depth, text, list(struct_pack(role := role, text := text)) OVER (
        PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
      FROM rebuilt
      UNION ALL SELECT conv_id, 0, '', [] FROM convs
    ), members AS (
      SELECT conv_id, depth, text, min(conv_id) OVER w AS node, count(*) OVER w AS n_convs,
             depth = max(depth) OVER (PARTITION BY conv_id) AS ends
      FROM opened WINDOW w AS (PARTITION BY depth, path)
    ), nodes AS (
      SELECT node, depth, max(n_convs) AS n_convs,
             (max(n_convs) - 1) * len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')) AS saved,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends
      FROM members GROUP BY node, depth
    ), linked AS (
      SELECT n.*, p.node AS parent, count(k.depth) OVER (PARTITION BY n.node, n.depth) AS n_children
      FROM nodes n
      LEFT JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1
      LEFT JOIN (SELECT DISTINCT m.node, m.depth, c.node AS child FROM members m
                 JOIN members c ON c.conv_id = m.conv_id AND c.depth = m.depth + 1) k ON k.node = n.node AND k.depth = n.depth
    ), plain AS (SELECT DISTINCT node, depth, n_convs, saved, ends, parent, n_children FROM linked),
    below AS (  -- a node lies below all nodes on the path of its smallest conversation
      SELECT a.node, a.depth, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(u.saved) AS saved
      FROM plain u JOIN members a ON a.conv_id = u.node AND a.depth <= u.depth
      GROUP BY a.node, a.depth
    )
    SELECT n.node AS conv_id, n.depth, n.parent AS parent_conv_id, n.n_convs, n.n_children,
           CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
    FROM plain n JOIN below b ON b.node = n.node AND b.depth = n.depth
    """,
)
def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, sizes = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.opening_trie(*prefix_trie.with_shared_openings(turns, sizes))
    return nodes.drop("enter", "exit")


@query(
    "op12_hard_negatives",
    """
    WITH vectors AS (
      SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.row_no AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM vectors a JOIN vectors b ON a.row_no <> b.row_no
      WHERE a.vec_id % 100 = 0
    ), positives AS (
      SELECT anchor, anchor_id, id, score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place
      FROM scored WHERE same QUALIFY place <= 5
    )
    SELECT p.anchor_id, p.id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
           n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
      AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY rank <= 5
    """,
)
def mined_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(moved, F.col("id") % 100 == 0).drop("positive_rank")


@query("op13_winnowing_fingerprints")
def winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared_with_edits(table(spark, sf_dir, "documents"))
