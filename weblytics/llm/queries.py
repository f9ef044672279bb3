"""The registered queries of the operators, thin over their functions, and the SQL of some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.llm import (
    conversation_repair,
    exact_dedup,
    fingerprints,
    katz,
    lang_id,
    line_dedup,
    merkle,
    packing,
    pieces,
    quality_crf,
    sharding,
    simhash_ball,
    suffix_dedup,
)
from weblytics.llm.common import crc_of_id, documents, ship

SHARDS = 8
SEED = 42


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), SHARDS, SEED)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ball.near_groups(documents(spark, sf_dir), words=3, max_bits=3)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_shared_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    field = quality_crf.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_crf.score_documents(docs, field)


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.signatures(documents(spark, sf_dir))
    found = fingerprints.with_near_counts(prints, F.col("doc_id") % 100 == 0)
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexed("fp").alias("fingerprint"),
        hexed("edited_fp").alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "near_documents",
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    ship(spark)
    found = lang_id.predict_languages(docs, lang_id.learn(docs))
    return found.select(
        "doc_id",
        (F.pmod(crc_of_id(F.col("doc_id")), F.lit(4)) == 2).alias("held_out"),
        "lang_pred",
        F.col("margin").alias("score"),
        "rejected",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.report(conversation_repair.damaged(rows))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.score_documents(documents(spark, sf_dir), katz.learned_documents(F.col("doc_id")))
    return scored.select(
        "doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_documents(documents(spark, sf_dir))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_sharding, op2_suffix_dedup, op3_simhash_near_dedup, op4_line_dedup, op5_quality,
        op6_sentence_pieces, op7_exact_dedup, op8_fingerprints, op9_language, op10_packing, op11_conversation_repair, op12_lm_scoring,
        op13_merkle_manifest,
    )}


LINE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, pos, line, s.key IS NOT NULL AND k.doc_id <> s.first AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

EXACT_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)"""

SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, (2 * i + 1)::BIGINT, 100)) AS s FROM d, generate_series(0, n - 50) g(i) WHERE n >= 50),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
g AS (SELECT w.doc_id, i FROM w JOIN f USING (s) WHERE doc_id > first),
o AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS _a,
  lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g),
r AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
p AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM p),
q AS (SELECT e.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
  string_agg(CASE WHEN k = 1 THEN substr(h, 1, (2 * a)::BIGINT) ELSE '' END
    || substr(h, (2 * b + 1)::BIGINT, (2 * (coalesce(next, n) - b))::BIGINT), '' ORDER BY a) AS kept
  FROM e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN q USING (doc_id)"""


def llm_oracles() -> dict[str, str]:
    return {"op2_suffix_dedup": SUFFIX_SQL, "op4_line_dedup": LINE_SQL, "op7_exact_dedup": EXACT_SQL}
