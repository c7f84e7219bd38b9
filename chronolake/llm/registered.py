"""The registered queries of the training-data operators, with the SQL that some of them must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.session import shared_dir

from . import chat, classifier, exact_dedup, hard_negatives, merkle, mixing, near_dedup, packing, pii, projected_search, quality_rules, sharding, warc
from .common import table
from .merkle_sql import MERKLE_SQL


#: The registered query's key; in use, the caller passes a secret one.
PII_KEY = "registered-query"


def op1_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    rows = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *counts, "base_failed", "kept")


def op2_balanced_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards."""
    return sharding.shard_documents(table(spark, sf_dir, "documents")).drop("text_sha256")


def op3_swap_search_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_order_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op5_fourier_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_schema_fingerprint_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digest(chat.format_conversations(rows.unionByName(own)))


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced by pseudonyms, and the values counted by kind."""
    done = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    counts = [F.size(F.filter("pii", one_of(k))).cast("long").alias(f"n_{k}") for k in dict.fromkeys(k for k, _, _ in pii.KINDS)]
    return done.select("doc_id", "text", F.size("pii").cast("long").alias("n_values"), *counts)


def one_of(kind: str):
    return lambda x: x["kind"] == kind


def op8_efraimidis_spirakis_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words that each gives."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op9_two_level_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back through the index."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), shared_dir(spark, "archives"))


def op10_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fate of every document among those of equal text."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_projected_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return projected_search.search(table(spark, sf_dir, "embeddings"))


def op12_path_copying_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and the root that its version folds to, of every document."""
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op13_multi_index_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of the positives of every fiftieth vector."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


_WORD = r"[^\x20\x09-\x0D]+"

OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, text, unnest(range(1, len(w) - 1)) AS i, w FROM (SELECT DISTINCT doc_id, text, w FROM t)
), g3 AS (
  SELECT doc_id, text, i, count(*) OVER (PARTITION BY doc_id, text, w[i], w[i + 1], w[i + 2]) AS n FROM g
), rep AS (
  SELECT doc_id, text, count(DISTINCT i + o) AS n_repeat_words FROM g3, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY doc_id, text
), m AS (
  SELECT t.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t.text) - length(translate(t.text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_extract_all(t.text, '\p{Lu}')) AS n_capitals, length(t.text) - length(replace(t.text, '!', '')) AS n_shouts
  FROM t LEFT JOIN rep ON t.doc_id = rep.doc_id AND t.text = rep.text
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [CASE WHEN word_chars > 0 THEN least(100 * n_symbols // word_chars, 100) ELSE 0 END,
     CASE WHEN n_lines > 0 THEN least(100 * n_dup_lines // n_lines, 100) ELSE 0 END,
     CASE WHEN n_words > 0 THEN least(100 * n_repeat_words // n_words, 100) ELSE 0 END,
     CASE WHEN word_chars > 0 THEN least(100 * n_capitals // word_chars, 100) ELSE 0 END,
     CASE WHEN n_words > 0 THEN least(100 * n_shouts // n_words, 100) ELSE 0 END] AS levels
  FROM m
), held AS (
  SELECT lang, levels, q FROM v JOIN (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id)
  WHERE NOT base_failed
), lv AS (
  SELECT lang, r, levels[r] AS level, q FROM held, (SELECT unnest([1, 2, 3, 4, 5]) AS r)
), tried AS (
  SELECT lang, r, c, sum((q = 1)::INT) AS n, sum((q <> 1)::INT) AS n_bad,
    sum((q = 1 AND level > c)::INT) AS k, sum((q <> 1 AND level > c)::INT) AS b
  FROM lv, (SELECT unnest(range(0, 101)) AS c) GROUP BY lang, r, c
), tests AS (
  SELECT count(*) AS m FROM (SELECT DISTINCT lang, r FROM lv)
), proven AS (
  SELECT lang, r, c, b * n - 20 * k * n_bad AS gain FROM tried, tests
  WHERE n > 0 AND k < n * 0.01 AND list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) <= 0.05 / m
), cuts AS (
  SELECT lang, r, max_by(c, gain * 1000 + c) AS c FROM proven GROUP BY lang, r
), bad AS (
  SELECT v.doc_id, v.lang, v.levels, bool_or(levels[r] > c) AS over
  FROM v JOIN cuts ON v.lang IS NOT DISTINCT FROM cuts.lang GROUP BY ALL
)
SELECT v.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(over, false) AS kept
FROM v LEFT JOIN bad ON v.doc_id = bad.doc_id AND v.lang IS NOT DISTINCT FROM bad.lang AND v.levels = bad.levels
"""

OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS shown,
    length(replace(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'), '[', '%5B')) AS role_shown
  FROM t
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(shown + role_shown + 8 + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce('a' || source, 'b') AS source_key, coalesce(text, '') AS text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size
  FROM documents
), w AS (
  SELECT doc_id, source, source_key, size,
    -ln((CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
    / (CASE WHEN size = 0 THEN 0.1::DOUBLE
       ELSE 0.1::DOUBLE + 0.9::DOUBLE * length(regexp_replace(text, '[!#*$%&|<>=_~^]', '', 'g')) / length(text) END) AS key
  FROM d
), s AS (
  SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source_key) - 1) % 3] AS weight
  FROM w GROUP BY source_key
), r AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
      ORDER BY source_size / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (ORDER BY source_size / weight, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing
  FROM s
), f AS (
  SELECT * FROM r WHERE weight * remaining < 3 * source_size * sharing ORDER BY source_size / weight, source_key LIMIT 1
), g AS (
  SELECT r.source_key, r.source_size,
    CASE WHEN r.weight * r.remaining >= 3 * r.source_size * r.sharing THEN CAST(3 * r.source_size AS DOUBLE)
         ELSE CAST(r.weight * f.remaining AS DOUBLE) / CAST(f.sharing AS DOUBLE) END AS target
  FROM r LEFT JOIN f ON true
), p AS (
  SELECT w.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN least(3, floor(g.target / g.source_size)) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY w.source_key ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM w JOIN g USING (source_key)
)
SELECT doc_id, source, size, source_size, target,
  CAST((epochs + CASE WHEN size > 0 AND 2 * (target - epochs * source_size - earlier) >= size THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM p
"""

OP9_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

OP10_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""

OP13_SQL = """
WITH d AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM d
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

QUERIES = {
    "op1_risk_controlled_rules": op1_risk_controlled_rules,
    "op2_balanced_label_propagation": op2_balanced_label_propagation,
    "op3_swap_search_packing": op3_swap_search_packing,
    "op4_order_minhash_near_dedup": op4_order_minhash_near_dedup,
    "op5_fourier_quality_classifier": op5_fourier_quality_classifier,
    "op6_schema_fingerprint_chat": op6_schema_fingerprint_chat,
    "op7_feistel_pseudonyms": op7_feistel_pseudonyms,
    "op8_efraimidis_spirakis_mix": op8_efraimidis_spirakis_mix,
    "op9_two_level_warc_index": op9_two_level_warc_index,
    "op10_cuckoo_exact_dedup": op10_cuckoo_exact_dedup,
    "op11_projected_kd_search": op11_projected_kd_search,
    "op12_path_copying_merkle": op12_path_copying_merkle,
    "op13_multi_index_hard_negatives": op13_multi_index_hard_negatives,
}

ORACLE_SQL = {
    "op1_risk_controlled_rules": OP1_SQL,
    "op6_schema_fingerprint_chat": OP6_SQL,
    "op8_efraimidis_spirakis_mix": OP8_SQL,
    "op9_two_level_warc_index": OP9_SQL,
    "op10_cuckoo_exact_dedup": OP10_SQL,
    "op12_path_copying_merkle": MERKLE_SQL,
    "op13_multi_index_hard_negatives": OP13_SQL,
}
