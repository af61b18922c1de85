"""Registered queries: each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import (
    adaptive_rules,
    common,
    deleted_interpolation,
    flat_graph,
    hard_negatives,
    hilbert_pack,
    hyperminhash,
    knapsack_mix,
    license_scan,
    merkle_manifest,
    pairwise_quality,
    secret_scan,
    toxic_terms,
    url_filter,
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary() -> str:
    """Path of the tokenizer's vocabulary; ``TILLCAST_VOCABULARY`` names another file."""
    if "TILLCAST_VOCABULARY" in os.environ:
        return os.environ["TILLCAST_VOCABULARY"]
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_knapsack_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knapsack_mix.mixed(_table(spark, sf_dir, "documents")).drop("source")


def op2_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return hilbert_pack.packed(docs, vocabulary(), with_ids=False).drop("ids")


def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interpolation.score(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(_table(spark, sf_dir, "documents"))


def op5_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_rules.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(_table(spark, sf_dir, "pages"))


def op7_toxic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_terms.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lower = F.translate("text", _UPPER, _UPPER.lower())
    tampered = F.when(common.held_out("doc_id", 3, 0), lower).otherwise(F.col("text"))
    rows = merkle_manifest.manifest(docs, tampered)
    rows = rows.withColumn("proof_sha256", merkle_manifest.proof_digest(F.col("proof")))
    return rows.drop("proof", "checked_leaf")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_knapsack_mix,
        op2_hilbert_pack,
        op3_deleted_interpolation,
        op4_license_scan,
        op5_adaptive_rules,
        op6_url_filter,
        op7_toxic_terms,
        op8_pairwise_quality,
        op9_flat_graph,
        op10_hyperminhash,
        op11_secret_novelty,
        op12_merkle_manifest,
        op13_hard_negatives,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op5_adaptive_rules": f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
), g AS (
  SELECT r, k, array_to_string(w[k:k + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS k FROM w WHERE len(w) >= 8)
), twice AS (
  SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1
), cover AS (
  SELECT r, sum(least(8, coalesce(k - last, 8))) AS n
  FROM (SELECT r, k, lag(k) OVER (PARTITION BY r ORDER BY k) AS last FROM twice) GROUP BY r
), lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w
), m AS (
  SELECT w.r, doc_id, lang, source, len(w) AS n_words, length(coalesce(array_to_string(w, ''), '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
    len(l) - len(list_distinct(l)) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_distinct(w)) AS n_distinct
  FROM w JOIN lines ON lines.r = w.r LEFT JOIN cover ON cover.r = w.r
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), x AS (
  SELECT r, lang, source, 'symbol_rate' AS rate, n_symbols / CAST(n_words AS DOUBLE) AS x FROM f WHERE NOT base_failed
  UNION ALL SELECT r, lang, source, 'upper_rate', n_upper / CAST(word_chars AS DOUBLE) FROM f WHERE NOT base_failed
  UNION ALL SELECT r, lang, source, 'duplicate_rate', n_dup_lines / CAST(n_words AS DOUBLE) FROM f WHERE NOT base_failed
  UNION ALL SELECT r, lang, source, 'variety', ln(n_distinct) / ln(n_words) FROM f WHERE NOT base_failed
), side(rate, side, least_step) AS (
  VALUES {", ".join(f"('{k}', {side}, {least!r}::DOUBLE)" for k, (side, least) in adaptive_rules.RATES.items())}
), b AS (
  SELECT *, CASE WHEN x > 0 THEN CAST(ceil(ln(x) / ln({adaptive_rules.GAMMA!r}::DOUBLE)) AS INT) ELSE -1000000 END AS b
  FROM x
), q AS (
  SELECT rate, lang, source, grouping(lang, source) AS level, count(*) AS n,
    quantile_disc(b, 0.25) AS b1, quantile_disc(b, 0.5) AS b2, quantile_disc(b, 0.75) AS b3
  FROM b GROUP BY GROUPING SETS ((rate, lang, source), (rate, lang), (rate))
), v AS (
  SELECT rate, lang, source, level, n, {", ".join(
      f"CASE WHEN b{k} = -1000000 THEN 0 ELSE 2 * pow({adaptive_rules.GAMMA!r}::DOUBLE, b{k})"
      f" / ({adaptive_rules.GAMMA!r}::DOUBLE + 1) END AS q{k}" for k in (1, 2, 3))}
  FROM q
), fence AS (
  SELECT o.rate, o.lang, o.source, s.side, best.q2 + s.side * {adaptive_rules.WIDTH!r}::DOUBLE * greatest(
      CASE WHEN s.side > 0 THEN best.q3 - best.q2 ELSE best.q2 - best.q1 END, s.least_step) AS fence
  FROM v o JOIN side s ON s.rate = o.rate JOIN v l ON l.level = 1 AND l.rate = o.rate AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN v best ON best.rate = o.rate AND best.level = CASE WHEN o.n >= {adaptive_rules.LEAST_ROWS} THEN 0
      WHEN l.n >= {adaptive_rules.LEAST_ROWS} THEN 1 ELSE 3 END
    AND (best.level = 3 OR best.lang IS NOT DISTINCT FROM o.lang)
    AND (best.level > 0 OR best.source IS NOT DISTINCT FROM o.source)
  WHERE o.level = 0
), outside AS (
  SELECT DISTINCT x.r FROM x JOIN fence ON fence.rate = x.rate AND fence.lang IS NOT DISTINCT FROM x.lang
    AND fence.source IS NOT DISTINCT FROM x.source
  WHERE side * x > side * fence
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept
FROM f""",
    "op9_flat_graph": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
)
SELECT vec_id, (SELECT count(*) FROM link WHERE x = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id)) AS component_id,
  vec_id <= coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id) AS kept
FROM v""",
    "op10_hyperminhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.replace("text,", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),")} AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN list_distinct([array_to_string(w, ' ')])
    ELSE list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) END AS s
  FROM w WHERE len(w) > 0
), n AS (SELECT doc_id, len(s) AS n FROM s
), e AS (SELECT doc_id, unnest(s) AS s FROM s
), link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
  WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), low AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low.y, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.x = d.doc_id""",
    "op12_merkle_manifest": """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda x, step: xor(x >> 1, (x & 1) * 3988292384))) AS t
), d AS (
  SELECT *, coalesce(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1])), 4294967295) % 3 = 0, false) AS hit
  FROM documents, crc_table
), enc AS (
  SELECT doc_id, lang, hit, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS own,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM d
), leaf AS (
  SELECT doc_id, lang, sha256(head || own) AS h, sha256(head || CASE WHEN hit THEN low ELSE own END) AS other
  FROM enc
), tree AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS t
  FROM leaf
), node(t, level, i, n, h) AS (
  SELECT t, 0, i, n, h FROM tree
  UNION ALL
  SELECT t, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY t, level, i // 8, n
), sub AS (SELECT t, level AS depth, h FROM node WHERE n = 1
), top(level, i, n, h) AS (
  SELECT 0, t, (SELECT count(*) FROM sub), h FROM sub
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 8, n
), side AS (
  SELECT x.t, x.i, x.level, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS r
  FROM node x JOIN node y ON x.t = y.t AND x.level = y.level AND x.i // 8 = y.i // 8 WHERE x.n > 1 GROUP BY x.t, x.i, x.level
), top_side AS (
  SELECT x.i, x.level, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS r
  FROM top x JOIN top y ON x.level = y.level AND x.i // 8 = y.i // 8 WHERE x.n > 1 GROUP BY x.i, x.level
), step AS (
  SELECT tree.t, tree.i, side.level AS level, l, r FROM tree JOIN side ON side.t = tree.t
    AND side.i = tree.i // CAST(pow(8, side.level) AS BIGINT)
  UNION ALL
  SELECT tree.t, tree.i, sub.depth + top_side.level, l, r FROM tree JOIN sub ON sub.t = tree.t
    JOIN top_side ON top_side.i = tree.t // CAST(pow(8, top_side.level) AS BIGINT)
), proof AS (
  SELECT t, i, sha256(string_agg(l || r, '' ORDER BY level)) AS p, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs
  FROM step GROUP BY t, i
), fold(t, i, level, h) AS (
  SELECT t, i, 0, other FROM tree
  UNION ALL
  SELECT fold.t, fold.i, level + 1, sha256(ls[level + 1] || h || rs[level + 1])
  FROM fold JOIN proof ON proof.t = fold.t AND proof.i = fold.i WHERE level < len(ls)
), folded AS (SELECT t, i, arg_max(h, level) AS h FROM fold GROUP BY t, i)
SELECT tree.doc_id, tree.h AS leaf, sub.h AS subroot, top.h AS root, coalesce(p, sha256('')) AS proof_sha256,
  folded.h AS folded_root, folded.h = top.h AS verified
FROM tree JOIN sub ON sub.t = tree.t JOIN top ON top.n = 1 JOIN folded ON folded.t = tree.t AND folded.i = tree.i
  LEFT JOIN proof ON proof.t = tree.t AND proof.i = tree.i""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), score AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, id, score FROM score WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INT) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 3""",
}
