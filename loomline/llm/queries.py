"""The corpus operators' queries over whole tables, with production parameters, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import audit, chat, exact_dedup, jaccard, language, media, mixing, negatives, packing, quality, sharding, suffixes, tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(media.stored_texts(_table(spark, sf_dir, "documents")))


def op2_sharding_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.vector_shards(_table(spark, sf_dir, "documents"), shards=40)


def op3_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_mixing_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("source")


def op6_language_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, with_ids=False)


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(spark, _table(spark, sf_dir, "conversations"))
    return chat.format_and_read_back(turns, public_tokenizers.path("piece_bpe_32k.model"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP10_SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM normal
"""


# Documents link where 100 * intersection >= 90 * union of their sets of three words; components by taking links to the smallest doc_id until none is new.
OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words
), each AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.t = b.t AND a.doc_id <> b.doc_id AND 100 * b.n >= 90 * a.n AND 100 * a.n >= 90 * b.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (SELECT a, a FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, coalesce(least(sets.doc_id, min(other)), sets.doc_id) AS component_id FROM sets LEFT JOIN reach USING (doc_id) GROUP BY sets.doc_id, s
"""

# The words of all runs of 50 words that another document has too, as ranges.
OP9_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), runs AS (
  SELECT doc_id, unnest(range(0, len(w) - 49)) AS a, unnest(list_transform(range(0, len(w) - 49), lambda i: md5(array_to_string(w[i + 1 : i + 50], ' ')))) AS run FROM words WHERE len(w) >= 50
), shared AS (SELECT run FROM runs GROUP BY run HAVING min(doc_id) < max(doc_id)
), marked AS (SELECT DISTINCT doc_id, a FROM runs JOIN shared USING (run)
), parted AS (SELECT *, CASE WHEN a > lag(a) OVER (PARTITION BY doc_id ORDER BY a) + 50 THEN 1 ELSE 0 END AS new FROM marked
), numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY a) AS stretch FROM parted)
SELECT doc_id, min(a) AS start_word, max(a) + 50 AS end_word, max(a) + 50 - min(a) AS n_words FROM numbered GROUP BY doc_id, stretch
"""

OP11_SQL = r"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label, coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM whole a, whole b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score, anchor_label FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INT AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

# Each order of the five filters over each document, one by one.
OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	

]+') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS is_copy FROM documents
), known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN is_copy THEN 'E' ELSE '' END AS f
  FROM texts LEFT JOIN known USING (doc_id)
), l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), each AS (
  SELECT part, o, step, good, toxic, f, contains(f, o[step]) AS hit, step > 1 AND regexp_matches(f, '[' || o[1 : step - 1] || '_]') AS gone FROM fails, orders, range(1, 6) s(step)
), counted AS (
  SELECT part, o, step, count(*) FILTER (NOT hit AND NOT gone) AS kept, count(*) FILTER (hit AND NOT gone) AS removed, count(*) FILTER (hit AND gone) AS redundant, count(*) FILTER (f = o[step]) AS unique_fails,
    count(*) FILTER (hit AND NOT gone AND good = 1) AS good_lost, count(*) FILTER (hit AND NOT gone AND toxic = 1) AS toxic_lost FROM each GROUP BY ALL
)
SELECT part, o AS filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley FROM counted
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_media_progressive_jpeg, op2_sharding_vector_packing, op3_quality_neighbours, op4_ngram_jaccard_join, op5_mixing_blocks, op6_language_rank_order, op7_token_counts, op8_best_fit_packing, op9_repeated_passages, op10_exact_dedup, op11_hard_negatives, op12_chat_windows, op13_filter_interaction_audit)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_jaccard_join": OP4_SQL, "op9_repeated_passages": OP9_SQL, "op10_exact_dedup": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op13_filter_interaction_audit": OP13_SQL}
