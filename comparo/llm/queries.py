"""Registered queries of this subpackage: each reads its whole table and returns its operator's full result."""

from __future__ import annotations

from pyspark.sql import functions as F

from comparo.llm import (bpe_prefix, cross_tokens, embed_lsh, fertility, length_hist, line_crf, pack, simhash_gray,
                         suffix_dedup, suffix_tree, toxicity, warc, whitening)
from comparo.llm.common import documents
from comparo.sources.tables import read_table

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


_LINKS_SQL = """WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reached(node, root) AS (SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.a, r.root FROM reached r JOIN links l ON l.b = r.node)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM embeddings v JOIN (SELECT node, min(root) AS component_id FROM reached GROUP BY node) c ON c.node = v.vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = v.vec_id"""


@register("op1_embed_lsh", _LINKS_SQL)
def op1(spark, sf_dir):
    return embed_lsh.near_duplicates(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@register("op2_toxicity")
def op2(spark, sf_dir):
    found = toxicity.toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@register("op3_fertility")
def op3(spark, sf_dir):
    found = fertility.rules(documents(spark, sf_dir), fertility.public_vocabulary())
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "script", "n_tokens", "chars_per_token", "byte_share",
                        "entropy", "reasons")


@register("op4_line_crf")
def op4(spark, sf_dir):
    found = line_crf.quality(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@register("op5_suffix_dedup")
def op5(spark, sf_dir):
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))


@register("op6_bpe_prefix")
def op6(spark, sf_dir):
    path, pattern = bpe_prefix.public_vocabulary()
    decoded = bpe_prefix.encode_documents(documents(spark, sf_dir), path, pattern, decode=True)
    return decoded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op7_best_fit")
def op7(spark, sf_dir):
    parts = pack.pieces(documents(spark, sf_dir), pack.public_vocabulary())
    return pack.pack(parts).withColumnRenamed("id", "doc_id")


@register("op8_simhash_gray")
def op8(spark, sf_dir):
    found = simhash_gray.near_duplicates(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register("op9_suffix_tree")
def op9(spark, sf_dir):
    return suffix_tree.score_documents(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@register("op10_length_hist")
def op10(spark, sf_dir):
    path, pattern = bpe_prefix.public_vocabulary()
    lengths = bpe_prefix.token_counts(documents(spark, sf_dir), path, pattern)
    return length_hist.context_limits(length_hist.histogram(lengths))


@register("op11_cross_tokens")
def op11(spark, sf_dir):
    return cross_tokens.score_documents(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


_WARC_SQL = """SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM (SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN octet_length(encode(payload)) >= 1000 AND page_id IS DISTINCT FROM max(page_id) OVER (PARTITION BY payload)
      THEN max(page_id) OVER (PARTITION BY payload) END AS refers_to
  FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"""


@register("op12_warc_normaliser", _WARC_SQL)
def op12(spark, sf_dir):
    found = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
