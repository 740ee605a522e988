"""Registered queries: name -> Spark callable (spark, sf_dir) -> DataFrame, and name -> oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo import config
from comparo import oracle as O
from comparo.session import materialize
from comparo.sources import fixtures as fx

AS_OF = "2001-08-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _inputs(spark: SparkSession, sf_dir: str, reuse: bool = True, without: tuple[str, ...] = ()):
    """The derived corpus and the inputs.

    ``reuse=True`` (queries that read the corpus several times) writes it once as a parquet table, which is how
    a stored corpus is read, without the columns that the query has no use for; single-pass queries read the derivation
    directly.
    """
    corpus = fx.corpus(spark, sf_dir).drop(*without)
    if reuse:
        corpus = materialize(corpus, "corpus", compression="zstd")
    return corpus, fx.queries_in(spark, sf_dir, corpus)


# --------------------------------------------------------------------------- flagship and retrieval

from comparo.operators.knn import knn_filtered  # noqa: E402
from comparo.operators.retrieval import retrieve  # noqa: E402
from comparo.plans.comparables import (SCORING_COLUMNS, assemble_results, comparables,  # noqa: E402
                                       score_and_rank, with_input_categories)


@register("comparables", O.with_(O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes())
          + f"SELECT {O.RESULT_SELECT} FROM ranked")
def q_comparables(spark, sf_dir):
    corpus, q = _inputs(spark, sf_dir)
    return comparables(q, corpus, AS_OF)


@register("knn_filtered", O.with_(O.base_ctes(), O.knn_ctes("knn1", "queries_in", True))
          + "SELECT input_id, query_index, rank, id, round(distance, 6) AS distance FROM knn1")
def q_knn_filtered(spark, sf_dir):
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    out = knn_filtered(q, corpus)
    return out.select("input_id", "query_index", "rank", "id", F.round("distance", 6).alias("distance"))


@register("knn_unfiltered_tld", O.with_(O.base_ctes(), O.knn_ctes("knn2", "queries_in", False))
          + "SELECT input_id, query_index, rank, id, round(distance, 6) AS distance FROM knn2")
def q_knn_unfiltered_tld(spark, sf_dir):
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    out = knn_filtered(q, corpus, use_tld=False)
    return out.select("input_id", "query_index", "rank", "id", F.round("distance", 6).alias("distance"))


@register("tiered_fallback", O.with_(O.base_ctes(), O.retrieval_ctes())
          + "SELECT input_id, query_index, rank, id, round(distance, 6) AS distance, tier FROM cands")
def q_tiered_fallback(spark, sf_dir):
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    out = retrieve(q, corpus)
    return out.select("input_id", "query_index", "rank", "id", F.round("distance", 6).alias("distance"), "tier")


@register("score_candidates", O.with_(
    O.base_ctes(), O.knn_ctes("knn1", "queries_in", True),
    "cands AS (SELECT input_id, query_index, rank, id, distance FROM knn1)", O.scoring_ctes("cands"))
    + f"SELECT {O.RESULT_SELECT} FROM ranked")
def q_score_candidates(spark, sf_dir):
    """E1 alone, over the tier-1 neighbours (no numeric filter, no fallback)."""
    from comparo.operators.ranking import with_recency
    from comparo.plans.comparables import as_of_literal
    corpus, q = _inputs(spark, sf_dir)
    cands = knn_filtered(with_input_categories(q), with_recency(corpus, as_of_literal(AS_OF)),
                         carry_q=["in_primary", "in_secondary"], carry_c=SCORING_COLUMNS)
    return score_and_rank(cands, corpus, AS_OF)


@register("comparables_constant_recency", O.with_(
    O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes("cands", config.Settings(recency="constant")))
    + f"SELECT {O.RESULT_SELECT} FROM ranked")
def q_comparables_constant_recency(spark, sf_dir):
    """E3 with recency fixed at 0.5, the value the reference returns in practice."""
    corpus, q = _inputs(spark, sf_dir)
    return comparables(q, corpus, AS_OF, config.Settings(recency="constant"))


_RESULTS_CTE = """results AS (SELECT i.input_id, i.input_domain, i.sld, i.tld, i.length, i.primary_category AS in_primary,
    i.descriptions, CAST(coalesce(r.n, 0) AS BIGINT) AS total_comparables,
    CASE WHEN coalesce(r.n, 0) >= 5 THEN 'high' ELSE 'low' END AS confidence, r.top_domain
  FROM inputs_in i
  LEFT JOIN (SELECT input_id, count(*) AS n, max(CASE WHEN final_rank = 1 THEN domain END) AS top_domain
             FROM ranked GROUP BY input_id) r ON r.input_id = i.input_id)"""


@register("assemble_results", O.with_(O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes(), _RESULTS_CTE)
          + """SELECT s.input_id, s.input_domain, s.sld, s.tld, s.length, s.in_primary, s.total_comparables, s.confidence,
  array_to_string(s.descriptions, '|') AS descriptions, r.final_rank AS rank, r.domain, r.price, r.date, r.platform,
  r.description, r.semantic_sim, r.cat_match, r.recency, r.score, r.desc_index, r.query_index
FROM results s LEFT JOIN ranked r ON r.input_id = s.input_id""")
def q_assemble_results(spark, sf_dir):
    """A10, the nested list spelt out as rows (one row with an empty comparable for an input without any)."""
    corpus, q = _inputs(spark, sf_dir)
    res = assemble_results(fx.inputs_in(spark, sf_dir, corpus), comparables(q, corpus, AS_OF))
    flat = res.select("input_id", "input_domain", "sld", "tld", "length", F.col("primary_category").alias("in_primary"),
                      "total_comparables", "confidence", F.array_join("descriptions", "|").alias("descriptions"),
                      F.explode_outer("comparables").alias("c"))
    return flat.select(*[c for c in flat.columns if c != "c"], *[F.col(f"c.{f}").alias(f) for f in [
        "rank", "domain", "price", "date", "platform", "description", "semantic_sim", "cat_match", "recency", "score",
        "desc_index", "query_index"]])


@register("final_topk", O.with_(O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes())
          + "SELECT input_id, final_rank AS rank, domain, score FROM ranked")
def q_final_topk(spark, sf_dir):
    """W3 + W4: order and top 10 of the scored candidates, before any detail is fetched."""
    from comparo.operators.ranking import rank_best, score_columns, with_recency
    from comparo.plans.comparables import as_of_literal
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    cands = retrieve(with_input_categories(q), with_recency(corpus, as_of_literal(AS_OF)),
                     carry_q=["in_primary", "in_secondary"],
                     carry_c=SCORING_COLUMNS)
    return rank_best(score_columns(cands, as_of_literal(AS_OF))).select("input_id", "rank", "domain", "score")


# --------------------------------------------------------------------------- corpus build side

from comparo.functions import scoring as S  # noqa: E402
from comparo.functions import vectors as V  # noqa: E402
from comparo.functions.text import extract_description  # noqa: E402
from comparo.operators import corpus_ops as C  # noqa: E402
from comparo.operators import profile as PR  # noqa: E402
from comparo.operators.embed import hashing_sparse  # noqa: E402
from comparo.plans.build_corpus import build_corpus, prepare_rows  # noqa: E402
from comparo.sources import corpus_store as CS  # noqa: E402
from comparo.sources.tables import read_table  # noqa: E402

_STRIP = O.strip_sql
_PRICE_TEXT = "regexp_replace(price, '[$,]', '', 'g')"
_CLEAN_PRICE_SQL = (f"coalesce(CASE WHEN regexp_matches({_PRICE_TEXT}, '{S.NUMERIC_TEXT}') "
                    f"THEN try_cast({_STRIP(_PRICE_TEXT)} AS DOUBLE) END, CAST(0 AS DOUBLE))")
_CLEAN_CTE = (f"clean AS (SELECT * REPLACE ({_STRIP('domain')} AS domain, {_CLEAN_PRICE_SQL} AS price) "
              f"FROM sales_raw WHERE {_STRIP('domain')} IS NOT NULL AND {_STRIP('domain')} <> '')")
_EXPLODE_CTE = f"""ex AS (
  SELECT c.*, 1 AS desc_index, {_STRIP('description_1')} AS description FROM clean c
    WHERE {_STRIP('description_1')} IS NOT NULL AND {_STRIP('description_1')} <> ''
  UNION ALL
  SELECT c.*, 2 AS desc_index, {_STRIP('description_2')} AS description FROM clean c
    WHERE {_STRIP('description_2')} IS NOT NULL AND {_STRIP('description_2')} <> ''),
exid AS (SELECT *, concat(domain, '__desc', CAST(desc_index AS VARCHAR)) AS id FROM ex)"""
_DEDUP_CTE = """dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY line_no, desc_index) AS rn FROM exid) WHERE rn = 1)"""
_DOC_EXPR = ("concat('Domain: ', domain, '. Category: ', coalesce(primary_category, 'Unknown'), ', ', "
             "coalesce(secondary_category, 'Unknown'), '. Description: ', description)")
_BUILD_CTES = [_CLEAN_CTE, _EXPLODE_CTE, _DEDUP_CTE,
               O.suffix_split_cte("bsx", "dd", "id", O.host_sql("domain")),
               f"""built AS (SELECT dd.id, {_DOC_EXPR} AS document, dd.domain,
    CASE WHEN b.sfx = '' THEN '.com' ELSE concat('.', b.sfx) END AS tld, CAST(length(b.sld) AS INTEGER) AS length,
    dd.price, dd.platform, dd.date AS sale_date, dd.primary_category, dd.secondary_category,
    CAST(dd.desc_index AS INTEGER) AS desc_index, regexp_matches(b.sld, '[0-9]') AS has_numbers
  FROM dd JOIN bsx b ON b.id = dd.id)"""]
_BUILT_COLS = ("id, document, domain, tld, length, price, platform, sale_date, primary_category, "
               "secondary_category, desc_index, has_numbers")


@register("clean_price", O.with_(O.base_ctes())
          + f"SELECT line_no, price AS price_text, {_CLEAN_PRICE_SQL} AS price_clean FROM sales_raw")
def q_clean_price(spark, sf_dir):
    raw = fx.sales_raw(spark, sf_dir)
    return raw.select("line_no", F.col("price").alias("price_text"), S.clean_price("price").alias("price_clean"))


@register("clean_sales", O.with_(O.base_ctes(), _CLEAN_CTE)
          + "SELECT line_no, domain, price FROM clean")
def q_clean_sales(spark, sf_dir):
    return C.clean_sales(fx.sales_raw(spark, sf_dir)).select("line_no", "domain", "price")


@register("explode_descriptions", O.with_(O.base_ctes(), _CLEAN_CTE, _EXPLODE_CTE)
          + "SELECT line_no, id, CAST(desc_index AS INTEGER) AS desc_index, description FROM exid")
def q_explode_descriptions(spark, sf_dir):
    rows = C.explode_descriptions(C.clean_sales(fx.sales_raw(spark, sf_dir)))
    return rows.select("line_no", "id", "desc_index", "description")


@register("document_text", O.with_(O.base_ctes(), _CLEAN_CTE, _EXPLODE_CTE)
          + f"SELECT id, line_no, {_DOC_EXPR} AS document FROM exid")
def q_document_text(spark, sf_dir):
    rows = C.document_text(C.explode_descriptions(C.clean_sales(fx.sales_raw(spark, sf_dir))))
    return rows.select("id", "line_no", "document")


_DUP_SQL_PRELUDE = """raw2 AS (SELECT * FROM sales_raw UNION ALL
  SELECT line_no + 1000000000 AS line_no, domain, price, description_1 || ' (again)' AS description_1,
    description_2, primary_category, secondary_category, platform, date FROM sales_raw)"""


def _sales_twice(spark, sf_dir):
    """The sales file followed by a second copy of itself with edited first descriptions."""
    raw = fx.sales_raw(spark, sf_dir)
    again = raw.withColumn("line_no", F.col("line_no") + 1_000_000_000).withColumn(
        "description_1", F.concat(F.col("description_1"), F.lit(" (again)")))
    return raw.unionByName(again)


@register("dedup_ids", O.with_(O.base_ctes(), _DUP_SQL_PRELUDE,
                               _CLEAN_CTE.replace("FROM sales_raw", "FROM raw2"), _EXPLODE_CTE, _DEDUP_CTE)
          + "SELECT id, line_no, description FROM dd")
def q_dedup_ids(spark, sf_dir):
    rows = C.explode_descriptions(C.clean_sales(_sales_twice(spark, sf_dir)))
    return C.dedup_ids(rows, "line_no").select("id", "line_no", "description")


@register("build_corpus", O.with_(O.base_ctes(), *_BUILD_CTES) + f"SELECT {_BUILT_COLS} FROM built")
def q_build_corpus(spark, sf_dir):
    """E4 without the vector column (vectors are checked by ``embed_hashing``)."""
    return build_corpus(fx.sales_raw(spark, sf_dir)).select(*C.CORPUS_COLUMNS)


def _build_vectors_sql() -> str:
    # defined lazily: the vector CTE helper is declared further down in this module
    return O.with_(O.base_ctes(), *_BUILD_CTES, _hash_vec_ctes("bvec", "built", "id", "document")) + \
        f"SELECT b.*, v.embedding FROM built b LEFT JOIN bvec v ON v.id = b.id"


@register("build_corpus_vectors")
def q_build_corpus_vectors(spark, sf_dir):
    """E4 with the hashing vectors (64 floats per row)."""
    return build_corpus(fx.sales_raw(spark, sf_dir)).select(*C.CORPUS_COLUMNS, "embedding")


@register("incremental_new", O.with_(O.base_ctes(), *_BUILD_CTES)
          + "SELECT id, domain, desc_index FROM built WHERE id NOT IN (SELECT id FROM corpus WHERE desc_index = 1)")
def q_incremental_new(spark, sf_dir):
    """Rows of the sales file not stored yet, when the store holds the first description of every domain."""
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    existing = corpus.where(F.col("desc_index") == 1)
    rows = prepare_rows(fx.sales_raw(spark, sf_dir))
    return C.incremental_new(rows, existing).select("id", "domain", "desc_index")


@register("upsert_corpus", O.with_(O.base_ctes(), *_BUILD_CTES)
          + f"SELECT {_BUILT_COLS} FROM corpus WHERE id NOT IN (SELECT id FROM built) UNION ALL SELECT {_BUILT_COLS} FROM built")
def q_upsert_corpus(spark, sf_dir):
    """The built rows replace stored rows with the same id, all columns."""
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    # written once: the ids and the rows are asked for apart
    rows = materialize(prepare_rows(fx.sales_raw(spark, sf_dir)), "sales_rows", compression="zstd")
    return C.upsert(corpus.select(*C.CORPUS_COLUMNS), rows)


@register("provider_ledger", O.with_(O.base_ctes())
          + "SELECT DISTINCT domain, upper(concat('Describe ', domain)) AS response, 1 AS attempts, CAST(NULL AS VARCHAR) AS error "
            "FROM corpus")
def q_provider_ledger(spark, sf_dir):
    """X2 with a live provider asked through a ledger: each distinct domain once, also over a second run."""
    from comparo.operators.provider_ledger import ask_once
    from comparo.session import shared_path
    domains = fx.corpus(spark, sf_dir).select("domain")
    ledger, provider = shared_path(spark, "ledger"), lambda: lambda prompts: [p.upper() for p in prompts]
    ask_once(domains, provider, "Describe {domain_name}", ledger)
    return ask_once(domains, provider, "Describe {domain_name}", ledger)


@register("upsert_keyed", O.with_(O.base_ctes(), *_BUILD_CTES)
          + f"SELECT {_BUILT_COLS} FROM corpus WHERE id NOT IN (SELECT id FROM built) UNION ALL SELECT {_BUILT_COLS} FROM built")
def q_upsert_keyed(spark, sf_dir):
    """S10, U3 on a stored table: only buckets that hold a new id are rewritten."""
    from comparo.session import shared_path
    from comparo.sources import keyed_store
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    path = keyed_store.create(corpus.select(*C.CORPUS_COLUMNS), shared_path(spark, "keyed_corpus"), 16)
    keyed_store.upsert_rows(spark, path, prepare_rows(fx.sales_raw(spark, sf_dir)))
    return keyed_store.read(spark, path)


@register("missing_keyed", O.with_(O.base_ctes(), *_BUILD_CTES)
          + f"SELECT {_BUILT_COLS} FROM built WHERE id NOT IN (SELECT id FROM corpus)")
def q_missing_keyed(spark, sf_dir):
    """J4 on a stored table: rows of the sales file that are not stored, reading the ids of hit buckets only."""
    from comparo.session import shared_path
    from comparo.sources import keyed_store
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    path = keyed_store.create(corpus.select(*C.CORPUS_COLUMNS), shared_path(spark, "keyed_corpus"), 16)
    rows = materialize(prepare_rows(fx.sales_raw(spark, sf_dir)), "sales_rows", compression="zstd")
    return keyed_store.missing(spark, path, rows).select(*C.CORPUS_COLUMNS)


@register("backfill_metadata", O.with_(O.base_ctes(), O.suffix_split_cte("gsx", "corpus_gaps", "id",
                                                                         O.host_sql("domain")))
          + """SELECT g.id, CASE WHEN g.length IS NULL THEN CAST(length(s.sld) AS INTEGER) ELSE g.length END AS length,
  CASE WHEN g.length IS NULL THEN CASE WHEN s.sfx = '' THEN '' ELSE concat('.', s.sfx) END ELSE g.tld END AS tld,
  CASE WHEN g.length IS NULL THEN regexp_matches(s.sld, '[0-9]') ELSE g.has_numbers END AS has_numbers,
  g.length IS NULL AS backfilled
FROM corpus_gaps g JOIN gsx s ON s.id = g.id""")
def q_backfill_metadata(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return C.backfill_metadata(fx.corpus_with_gaps(spark, sf_dir, corpus)).select(
        "id", "length", "tld", "has_numbers", "backfilled")


@register("backfill_keyed", O.with_(O.base_ctes(), O.suffix_split_cte("gsx", "corpus_gaps", "id", O.host_sql("domain")))
          + """SELECT g.id, CASE WHEN g.length IS NULL THEN CAST(length(s.sld) AS INTEGER) ELSE g.length END AS length,
  CASE WHEN g.length IS NULL THEN CASE WHEN s.sfx = '' THEN '' ELSE concat('.', s.sfx) END ELSE g.tld END AS tld,
  CASE WHEN g.length IS NULL THEN regexp_matches(s.sld, '[0-9]') ELSE g.has_numbers END AS has_numbers
FROM corpus_gaps g JOIN gsx s ON s.id = g.id""")
def q_backfill_keyed(spark, sf_dir):
    """S13, P19 on a stored table: only buckets with rows to fill are rewritten."""
    from comparo.session import shared_path
    from comparo.sources import keyed_store
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    gaps = fx.corpus_with_gaps(spark, sf_dir, corpus)
    path = keyed_store.create(gaps, shared_path(spark, "keyed_gaps"), 16)
    keyed_store.backfill_rows(spark, path)
    return keyed_store.read(spark, path).select("id", "length", "tld", "has_numbers")


@register("embed_hashing", O.with_(O.base_ctes()) + """SELECT doc_id, bucket, weight FROM (
  SELECT doc_id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS weight FROM (
    SELECT doc_id, CAST(CAST(('0x' || substr(md5(tok), 1, 8)) AS BIGINT) % 64 AS INTEGER) AS bucket,
      count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS tok FROM documents)
    WHERE tok <> '' GROUP BY 1, 2))""")
def q_embed_hashing(spark, sf_dir):
    """X1 built-in encoder over every document, as sparse (doc_id, bucket, weight) rows."""
    return hashing_sparse(read_table(spark, sf_dir, "documents"), "doc_id", "text")


@register("scan_corpus", O.with_(O.base_ctes()) + "SELECT id, domain, tld, length, price, sale_date FROM corpus")
def q_scan_corpus(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir)
    return CS.scan_corpus(spark, _corpus_path(corpus)).select("id", "domain", "tld", "length", "price", "sale_date")


def _corpus_path(corpus):
    return corpus.inputFiles()[0].rsplit("/", 1)[0]


@register("corpus_count", O.with_(O.base_ctes())
          + "SELECT count(*) AS n_documents, count(*) = 0 AS is_empty FROM corpus")
def q_corpus_count(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return CS.corpus_count(corpus)


_FLAT_SQL = ("SELECT id, document, domain, tld, length, price, platform, sale_date AS date, primary_category, "
             "secondary_category, desc_index, has_numbers, CAST(embedding AS DOUBLE[]) AS embedding FROM corpus")


@register("export_flat", O.with_(O.base_ctes()) + _FLAT_SQL)
def q_export_flat(spark, sf_dir):
    """Written as flat parquet and read back, vectors included."""
    from comparo.session import shared_path
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    path = CS.export_flat(corpus, shared_path(spark, "export"))
    return spark.read.parquet(path).withColumn("embedding", V.as_double("embedding"))


@register("restore_roundtrip", O.with_(O.base_ctes())
          + "SELECT id, document, domain, tld, length, price, sale_date, desc_index, has_numbers, "
            "round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vsum FROM corpus")
def q_restore_roundtrip(spark, sf_dir):
    """S7 -> S8 -> S9: back up as JSON, pick the latest backup, restore to a new path; equals the corpus."""
    from comparo.session import shared_path
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    folder = shared_path(spark, "backups")
    CS.backup_json(corpus, folder, compression="gzip")
    restored = spark.read.parquet(CS.restore(spark, CS.latest_backup(spark, folder), shared_path(spark, "live")))
    vsum = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return restored.select("id", "document", "domain", "tld", "length", "price", "sale_date", "desc_index",
                           "has_numbers", F.round(vsum, 6).alias("vsum"))


@register("backup_json", O.with_(O.base_ctes()) + """SELECT id, document AS content, domain, tld, length, price,
  sale_date AS date, desc_index, has_numbers, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vsum FROM corpus""")
def q_backup_json(spark, sf_dir):
    """The written JSON backup read back with its fixed schema, records flattened for the check."""
    from comparo.session import shared_path
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    recs = CS.read_backup(spark, CS.backup_json(corpus, shared_path(spark, "backups"), compression="gzip"))
    vsum = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return recs.select("id", "content", *[F.col(f"metadata.{f}").alias(f) for f in
                                          ["domain", "tld", "length", "price", "date", "desc_index", "has_numbers"]],
                       F.round(vsum, 6).alias("vsum"))


@register("read_sales_csv", O.with_(O.base_ctes()) + """SELECT CAST(line_no AS VARCHAR) AS line_no, domain, price,
  nullif(description_1, '') AS description_1, description_2, primary_category, secondary_category,
  CASE WHEN line_no % 2 = 0 THEN platform END AS platform, date FROM sales_raw""")
def q_read_sales_csv(spark, sf_dir):
    """The sales rows written as CSV (quoted, multi-line texts) in two layouts, and read back by name: one as it is,
    one with the columns in reverse order, an unknown column more and the platform missing."""
    from comparo.session import shared_path
    from comparo.sources.sales_csv import read_sales_csv, write_sales_csv
    raw, folder = fx.sales_raw(spark, sf_dir), shared_path(spark, "sales_csv")
    write_sales_csv(raw.where(F.col("line_no") % 2 == 0), f"{folder}/as_is")
    odd = raw.where(F.col("line_no") % 2 == 1).withColumn("remark", F.lit("x")).drop("platform")
    write_sales_csv(odd.select(*odd.columns[::-1]), f"{folder}/reversed")
    return read_sales_csv(spark, f"{folder}/*", extra=["line_no"])


# --------------------------------------------------------------------------- profile (E5)

@register("profile_totals", O.with_(O.base_ctes()) + """SELECT count(*) AS total_documents,
  count(DISTINCT coalesce(domain, '')) AS unique_domains, count(*) = 0 AS is_empty, count(*) < 100 AS small_corpus
FROM corpus""")
def q_profile_totals(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.totals(corpus)


def _top_sql(col: str, n: int) -> str:
    return f"""SELECT value, documents, CAST(row_number() OVER (ORDER BY documents DESC, value) AS INTEGER) AS rank
FROM (SELECT coalesce({col}, 'unknown') AS value, count(*) AS documents FROM corpus GROUP BY 1)
ORDER BY documents DESC, value LIMIT {n}"""


@register("profile_tld", O.with_(O.base_ctes()) + _top_sql("tld", 15))
def q_profile_tld(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.tld_distribution(corpus)


@register("profile_category", O.with_(O.base_ctes()) + _top_sql("primary_category", 10))
def q_profile_category(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.category_distribution(corpus)


@register("profile_price", O.with_(O.base_ctes()) + """SELECT min(p) AS min_price, max(p) AS max_price,
  round(avg(p), 6) AS avg_price, round(sum(p), 6) AS total_price, count(p) AS priced_documents
FROM (SELECT CASE WHEN price > 0 AND NOT isnan(price) THEN price END AS p FROM corpus)""")
def q_profile_price(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    # sums depend on addition order in the last bits; the check compares them at 6 decimals
    return PR.price_stats(corpus).withColumn("avg_price", F.round("avg_price", 6)).withColumn(
        "total_price", F.round("total_price", 6))


@register("profile_dates", O.with_(O.base_ctes()) + """SELECT min(d) AS earliest_sale, max(d) AS latest_sale
FROM (SELECT CASE WHEN sale_date <> '' THEN sale_date END AS d FROM corpus)""")
def q_profile_dates(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.date_range(corpus)


@register("profile_length", O.with_(O.base_ctes()) + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS bucket_order, '{lab}' AS bucket, CAST(count_if(coalesce(length, 0) "
    + (f">= {lo}" if hi is None else f"BETWEEN {lo} AND {hi}") + ") AS BIGINT) AS documents FROM corpus"
    for i, (lab, lo, hi) in enumerate(config.LENGTH_BUCKETS)) + ")")
def q_profile_length(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.length_histogram(corpus)


@register("profile_numeric", O.with_(O.base_ctes()) + """SELECT CAST(count_if(coalesce(has_numbers, false)) AS BIGINT) AS with_numbers,
  CAST(count_if(NOT coalesce(has_numbers, false)) AS BIGINT) AS without_numbers FROM corpus""")
def q_profile_numeric(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.numeric_split(corpus)


def _summary_sql() -> str:
    cols = []
    for lab, lo, hi in config.LENGTH_BUCKETS:
        name = "len_" + lab.split(" ")[0].replace("-", "_").replace("+", "_up")
        cond = f">= {lo}" if hi is None else f"BETWEEN {lo} AND {hi}"
        cols.append(f"CAST(count_if(coalesce(length, 0) {cond}) AS BIGINT) AS {name}")
    return O.with_(O.base_ctes()) + f"""SELECT count(*) AS total_documents,
  count(DISTINCT coalesce(domain, '')) AS unique_domains,
  min(CASE WHEN price > 0 AND NOT isnan(price) THEN price END) AS min_price,
  max(CASE WHEN price > 0 AND NOT isnan(price) THEN price END) AS max_price,
  round(avg(CASE WHEN price > 0 AND NOT isnan(price) THEN price END), 6) AS avg_price,
  round(sum(CASE WHEN price > 0 AND NOT isnan(price) THEN price END), 6) AS total_price,
  min(CASE WHEN sale_date <> '' THEN sale_date END) AS earliest_sale,
  max(CASE WHEN sale_date <> '' THEN sale_date END) AS latest_sale,
  {", ".join(cols)},
  CAST(count_if(coalesce(has_numbers, false)) AS BIGINT) AS with_numbers,
  CAST(count_if(NOT coalesce(has_numbers, false)) AS BIGINT) AS without_numbers,
  count(*) = 0 AS is_empty, count(*) < 100 AS small_corpus
FROM corpus"""


@register("profile_summary", _summary_sql())
def q_profile_summary(spark, sf_dir):
    """E5 scalar statistics in one pass over the corpus."""
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    out = PR.summary(corpus)
    return out.withColumn("avg_price", F.round("avg_price", 6)).withColumn("total_price", F.round("total_price", 6))


@register("profile_sample", O.with_(O.base_ctes()) + """SELECT id, domain, tld, length, sample_rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS sample_rank FROM (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(domain, 'unknown') ORDER BY id) AS rn
      FROM (SELECT * FROM corpus ORDER BY id LIMIT 30)) WHERE rn = 1))
WHERE sample_rank <= 10""")
def q_profile_sample(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return PR.sample_domains(corpus).select("id", "domain", "tld", "length", "sample_rank")


# --------------------------------------------------------------------------- scalar functions on pairs

from comparo.operators.suffix import parse_domain, split_suffix, with_tld_family  # noqa: E402

_PAIRS_FAM = """pf AS (SELECT p.*, coalesce(fa.family, 'other') AS in_family, coalesce(fb.family, 'other') AS cand_family
  FROM pairs p LEFT JOIN tld_families fa ON fa.tld = p.in_tld LEFT JOIN tld_families fb ON fb.tld = p.cand_tld)"""


def _pairs(spark, sf_dir):
    corpus, _ = _inputs(spark, sf_dir, without=("document",))
    return fx.pairs(spark, sf_dir, corpus)


@register("category_match", O.with_(O.base_ctes()) + "SELECT id_a, id_b, "
          + O.category_match_sql("cand_primary", "cand_secondary", "in_primary", "in_secondary")
          + " AS cat_match FROM pairs")
def q_category_match(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select("id_a", "id_b", S.category_match("cand_primary", "cand_secondary", "in_primary",
                                                     "in_secondary").alias("cat_match"))


@register("tld_match", O.with_(O.base_ctes(), _PAIRS_FAM) + """SELECT id_a, id_b, in_tld, cand_tld,
  CAST(CASE WHEN cand_tld IS NOT DISTINCT FROM in_tld THEN 1.0
       WHEN cand_family = in_family AND cand_family <> 'other' THEN 0.7 ELSE 0.0 END AS DOUBLE) AS tld_match FROM pf""")
def q_tld_match(spark, sf_dir):
    p = with_tld_family(with_tld_family(_pairs(spark, sf_dir), "in_tld", "in_family"), "cand_tld", "cand_family")
    return p.select("id_a", "id_b", "in_tld", "cand_tld",
                    S.tld_match("cand_tld", "in_tld", "cand_family", "in_family").alias("tld_match"))


@register("tld_family", O.with_(O.base_ctes()) + """SELECT d.dk, d.tld, coalesce(f.family, 'other') AS tld_family
FROM domains d LEFT JOIN tld_families f ON f.tld = d.tld""")
def q_tld_family(spark, sf_dir):
    return with_tld_family(fx.domains(spark, sf_dir), "tld").select("dk", "tld", "tld_family")


@register("recency_weight", O.with_(O.base_ctes())
          + "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sale_date, "
          + O.recency_sql("CAST(CAST(o_orderdate AS DATE) AS VARCHAR)") + " AS recency FROM orders")
def q_recency_weight(spark, sf_dir):
    """C3/C15 over the whole orders table with as_of = 2001-08-01."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey",
                                                   F.col("o_orderdate").cast("date").cast("string").alias("sale_date"))
    return o.withColumn("recency", S.recency_weight(F.col("sale_date"), F.lit(AS_OF).cast("timestamp")))


_DIST_SQL = "list_distance(CAST(emb_a AS DOUBLE[]), CAST(emb_b AS DOUBLE[]))"


@register("l2_distance", O.with_(O.base_ctes()) + f"SELECT id_a, id_b, round({_DIST_SQL}, 6) AS distance FROM pairs")
def q_l2_distance(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select("id_a", "id_b", F.round(V.l2_distance("emb_a", "emb_b"), 6).alias("distance"))


@register("semantic_similarity", O.with_(O.base_ctes())
          + f"SELECT id_a, id_b, round({O.semantic_sql(_DIST_SQL)}, 6) AS semantic_sim FROM pairs")
def q_semantic_similarity(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select("id_a", "id_b", F.round(S.semantic_similarity(V.l2_distance("emb_a", "emb_b")), 6)
                    .alias("semantic_sim"))


@register("composite_score", O.with_(O.base_ctes()) + f"""SELECT id_a, id_b, round(sem, 4) AS semantic_sim,
  round(cat, 2) AS cat_match, round(rec, 2) AS recency, round(0.6 * sem + 0.2 * cat + 0.2 * rec, 4) AS score
FROM (SELECT id_a, id_b, {O.semantic_sql(_DIST_SQL)} AS sem,
  {O.category_match_sql('cand_primary', 'cand_secondary', 'in_primary', 'in_secondary')} AS cat,
  {O.recency_sql('sale_date')} AS rec FROM pairs)""")
def q_composite_score(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    sem = S.semantic_similarity(V.l2_distance("emb_a", "emb_b"))
    cat = S.category_match("cand_primary", "cand_secondary", "in_primary", "in_secondary")
    rec = S.recency_weight(F.col("sale_date"), F.lit(AS_OF).cast("timestamp"))
    return p.select("id_a", "id_b", F.round(sem, 4).alias("semantic_sim"), F.round(cat, 2).alias("cat_match"),
                    F.round(rec, 2).alias("recency"), F.round(S.composite_score(sem, cat, rec), 4).alias("score"))


@register("normalize_vectors", O.with_(O.base_ctes()) + """SELECT vec_id, pos, round(CAST(v AS DOUBLE), 6) AS value FROM (
  SELECT vec_id, CAST(generate_subscripts(nv, 1) - 1 AS INTEGER) AS pos, unnest(nv) AS v FROM (
    SELECT vec_id, CASE WHEN nrm > 0 THEN CAST(list_transform(e, lambda x: x / nrm) AS FLOAT[]) ELSE CAST(e AS FLOAT[]) END AS nv
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
            sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS nrm FROM embeddings)))""")
def q_normalize_vectors(spark, sf_dir):
    """C8 over every stored vector, one row per component."""
    e = read_table(spark, sf_dir, "embeddings")
    n = e.select("vec_id", V.normalize("embedding").alias("nv"))
    return n.select("vec_id", F.posexplode("nv").alias("pos", "v")).select(
        "vec_id", "pos", F.round(F.col("v").cast("double"), 6).alias("value"))


@register("vector_text", O.with_(O.base_ctes()) + "SELECT vec_id, true AS exact FROM embeddings")
def q_vector_text(spark, sf_dir):
    """Vector -> text -> vector gives the vector back."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", (V.from_text(V.to_text("embedding")) == F.col("embedding")).alias("exact"))


@register("json_metadata", O.with_(O.base_ctes()) + """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.k') AS k_text FROM events""")
def q_json_metadata(spark, sf_dir):
    """A field of a JSON text column read as text and as INT (NULL when absent or not a number)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return ev.select("event_id", k.try_cast("int").alias("k"), k.alias("k_text"))


# --------------------------------------------------------------------------- domain parsing

_PAGES_SPLIT = O.suffix_split_cte("psx", "pages", "page_id, url", O.host_sql("url"))


@register("split_suffix", O.with_(O.base_ctes(), _PAGES_SPLIT) + "SELECT page_id, host, sfx AS suffix, sld FROM psx")
def q_split_suffix(spark, sf_dir):
    from comparo.functions.domains import host_of
    p = read_table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"))
    return split_suffix(p, "host").select("page_id", "host", "suffix", "sld")


USER_RULES = ["net", "com", "org", "*.org", "!example.org", "example.net", "// a comment"]


@register("split_suffix_rules", O.with_(O.base_ctes(), f"pr AS (SELECT page_id, {O.host_sql('url')} AS host FROM pages)",
          r"""px AS (SELECT page_id, host, CASE
    WHEN regexp_matches(lower(host), '(^|\.)example\.org$') THEN right(host, 3)
    WHEN regexp_matches(lower(host), '[^.]+\.org$') THEN regexp_extract(host, '([^.]+\.[^.]+)$', 1)
    WHEN regexp_matches(lower(host), '(^|\.)example\.net$') THEN right(host, 11)
    WHEN regexp_matches(lower(host), '(^|\.)(net|com|org)$') THEN right(host, 3) ELSE '' END AS suffix FROM pr)""")
          + """SELECT page_id, host, suffix, regexp_extract(CASE WHEN suffix = '' THEN host
  ELSE left(host, greatest(length(host) - length(suffix) - 1, 0)) END, '([^.]*)$', 1) AS sld FROM px""")
def q_split_suffix_rules(spark, sf_dir):
    """J3 with a user table of normal, wildcard and exception rules."""
    from comparo.functions.domains import host_of
    from comparo.operators.suffix import suffix_table
    p = read_table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"))
    return split_suffix(p, "host", suffix_table(spark, USER_RULES)).select("page_id", "host", "suffix", "sld")


@register("parse_domain", O.with_(O.base_ctes(), _PAGES_SPLIT) + f"""SELECT page_id, sld,
  CASE WHEN sfx = '' THEN '.com' ELSE concat('.', sfx) END AS tld, CAST(length(sld) AS INTEGER) AS length,
  coalesce(contains(sld, '-') OR regexp_matches(sld, '[a-z][A-Z]'), false) AS is_multi_word,
  coalesce(regexp_matches(sld, '[0-9]'), false) AS has_numbers, {O.numeric_pct_sql('sld')} AS numeric_percentage
FROM psx""")
def q_parse_domain(spark, sf_dir):
    """P1 (+ C10, C11) over every page URL."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return parse_domain(p, "url").select("page_id", "sld", "tld", "length", "is_multi_word", "has_numbers",
                                         "numeric_percentage")


@register("numeric_features", O.with_(O.base_ctes()) + f"""SELECT dk, sld, coalesce(regexp_matches(sld, '[0-9]'), false)
  AS has_numbers, {O.numeric_pct_sql('sld')} AS numeric_percentage FROM domains""")
def q_numeric_features(spark, sf_dir):
    """P15/P16 over every sold domain's SLD."""
    from comparo.functions.domains import has_numbers, numeric_percentage
    d = fx.domains(spark, sf_dir)
    return d.select("dk", "sld", has_numbers("sld").alias("has_numbers"),
                    numeric_percentage("sld").alias("numeric_percentage"))


# --------------------------------------------------------------------------- text

_DOC_VARIANTS_SQL = f"""dv AS (
  SELECT id AS doc_key, 0 AS variant, document AS doc FROM corpus
  UNION ALL SELECT id, 1, replace(document, '. Description: ', '.Description:') FROM corpus
  UNION ALL SELECT id, 2, replace(document, 'Description: ', 'Description - ') FROM corpus
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 3, text FROM documents)"""


@register("extract_description", O.with_(O.base_ctes(), _DOC_VARIANTS_SQL)
          + f"SELECT doc_key, variant, {O.description_sql('doc')} AS description FROM dv")
def q_extract_description(spark, sf_dir):
    """P20 over every corpus document in three spellings, and every raw document text."""
    corpus, _ = _inputs(spark, sf_dir, without=("embedding",))
    docs = read_table(spark, sf_dir, "documents")
    d = F.col("document")
    def variant(df, key, i, text):
        return df.select(key.alias("doc_key"), F.lit(i).alias("variant"), text.alias("doc"))
    dv = (variant(corpus, F.col("id"), 0, d)
          .unionByName(variant(corpus, F.col("id"), 1, F.replace(d, F.lit(". Description: "), F.lit(".Description:"))))
          .unionByName(variant(corpus, F.col("id"), 2, F.replace(d, F.lit("Description: "), F.lit("Description - "))))
          .unionByName(variant(docs, F.col("doc_id").cast("string"), 3, F.col("text"))))
    return dv.select("doc_key", "variant", extract_description(F.col("doc")).alias("description"))


# --------------------------------------------------------------------------- filters

from comparo.operators.filters import filter_counts, spec_to_column  # noqa: E402


def _filter_sql(pred: str) -> str:
    return O.with_(O.base_ctes(), """fi AS (SELECT DISTINCT qq.input_id, qq.tld, qq.length, qq.primary_category,
    qq.secondary_category, coalesce(f.family, qq.tld) AS tld_key FROM queries_in qq LEFT JOIN tld_families f ON f.tld = qq.tld),
fc AS (SELECT cc.*, coalesce(f.family, cc.tld) AS tld_key FROM corpus cc LEFT JOIN tld_families f ON f.tld = cc.tld)""") \
        + f"SELECT q.input_id, count(c.id) AS n FROM fi q LEFT JOIN fc c ON {pred} GROUP BY q.input_id"


_LEN_PRED = "c.length BETWEEN q.length - 2 AND q.length + 2"
_TLD_PRED = "c.tld_key = q.tld_key"
_CAT_PRED = ("(c.primary_category IN (q.primary_category, q.secondary_category) "
             "OR c.secondary_category IN (q.primary_category, q.secondary_category))")


def _filter_query(use_tld, use_length, use_category):
    def run(spark, sf_dir):
        corpus, q = _inputs(spark, sf_dir, without=("document", "embedding"))
        inputs = q.select("input_id", "tld", "length", "primary_category", "secondary_category").dropDuplicates(
            ["input_id"])
        return filter_counts(inputs, corpus, use_tld=use_tld, use_length=use_length, use_category=use_category)
    return run


register("filter_length_band", _filter_sql(_LEN_PRED))(_filter_query(False, True, False))
register("filter_tld_family", _filter_sql(_TLD_PRED))(_filter_query(True, False, False))
register("filter_category_overlap", _filter_sql(_CAT_PRED))(_filter_query(False, False, True))
register("hard_filter", _filter_sql(f"{_TLD_PRED} AND {_LEN_PRED} AND {_CAT_PRED}"))(_filter_query(True, True, True))

@register("filter_predicates", O.with_(O.base_ctes(), _PAIRS_FAM, """pk AS (SELECT *,
    CASE WHEN in_family = 'other' THEN in_tld ELSE in_family END AS in_key,
    CASE WHEN cand_family = 'other' THEN cand_tld ELSE cand_family END AS cand_key FROM pf),
pp AS (SELECT id_a, id_b, abs(cand_length - in_length) <= 2 AS length_ok, in_key = cand_key AS tld_ok,
    (cand_primary IN (in_primary, in_secondary) OR cand_secondary IN (in_primary, in_secondary)) AS category_ok FROM pk)""")
          + """SELECT id_a, id_b, length_ok, tld_ok, category_ok, length_ok AND tld_ok AND category_ok AS all_ok,
  length_ok AND category_ok AS all_but_tld FROM pp""")
def q_filter_predicates(spark, sf_dir):
    """The predicates themselves, row by row over the scoring pairs."""
    from comparo.operators import filters as FI
    from comparo.operators.suffix import with_tld_key
    p = with_tld_key(with_tld_key(_pairs(spark, sf_dir), "in_tld", "in_key"), "cand_tld", "cand_key")
    sides = [F.col(c) for c in ("cand_length", "cand_key", "cand_primary", "cand_secondary", "in_length", "in_key",
                                "in_primary", "in_secondary")]
    c_len, c_key, cp, cs, i_len, i_key, ip, isec = sides
    return p.select("id_a", "id_b", FI.length_band(c_len, i_len).alias("length_ok"),
                    FI.tld_family_match(c_key, i_key).alias("tld_ok"),
                    FI.category_overlap(cp, cs, ip, isec).alias("category_ok"),
                    FI.hard_filter(*sides).alias("all_ok"), FI.hard_filter(*sides, include_tld=False).alias("all_but_tld"))


FILTER_SPEC = {"$and": [{"length": {"$gte": 8, "$lte": 12}},
                        {"$or": [{"tld": {"$in": [".com", ".io"]}}, {"primary_category": {"$eq": "Brandable"}}]}]}


@register("filter_spec", O.with_(O.base_ctes()) + """SELECT id, length, tld, primary_category FROM corpus
WHERE length >= 8 AND length <= 12 AND (tld IN ('.com', '.io') OR primary_category = 'Brandable')""")
def q_filter_spec(spark, sf_dir):
    """A declarative spec ($and, $or, $gte, $lte, $in, $eq) turned into one predicate on the corpus."""
    corpus, _ = _inputs(spark, sf_dir, reuse=False)
    return corpus.where(spec_to_column(FILTER_SPEC)).select("id", "length", "tld", "primary_category")


@register("knn_cosine", O.with_(O.base_ctes(), O.knn_ctes("knnc", "queries_in", True).replace(
    "list_distance(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))",
    "1.0 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))"))
    + "SELECT input_id, query_index, rank, id, round(distance, 6) AS distance FROM knnc")
def q_knn_cosine(spark, sf_dir):
    """The filtered search with cosine distance."""
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    out = knn_filtered(q, corpus, metric="cosine")
    return out.select("input_id", "query_index", "rank", "id", F.round("distance", 6).alias("distance"))


@register("numeric_filter", O.with_(O.base_ctes(), O.retrieval_ctes())
          + "SELECT input_id, query_index, rank, id FROM t1")
def q_numeric_filter(spark, sf_dir):
    """P17 on the tier-1 neighbours (no fallback)."""
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    return retrieve(q, corpus, config.Settings(tld_fallback=False)).select("input_id", "query_index", "rank", "id")


@register("dedup_best", O.with_(O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes())
          + """SELECT input_id, domain, score, query_index, rank, fq AS first_query_index, fr AS first_rank
FROM kept WHERE rn = 1""")
def q_dedup_best(spark, sf_dir):
    """Best row per (input, domain) above the threshold, with its first position."""
    from comparo.operators.ranking import dedup_best, score_columns, with_recency
    from comparo.plans.comparables import as_of_literal
    corpus, q = _inputs(spark, sf_dir, without=("document",))
    cands = retrieve(with_input_categories(q), with_recency(corpus, as_of_literal(AS_OF)),
                     carry_q=["in_primary", "in_secondary"],
                     carry_c=SCORING_COLUMNS)
    best = dedup_best(score_columns(cands, as_of_literal(AS_OF)))
    return best.select("input_id", "domain", "score", "query_index", "rank", "first_query_index", "first_rank")


# --------------------------------------------------------------------------- inputs, enrichment, reports

from comparo.operators import enrich as EN  # noqa: E402
from comparo.operators.retrieval import build_queries  # noqa: E402

PROMPT_TEMPLATE = ("Describe the domain {domain_name} for a buyer. Answer as JSON such as "
                   "{{\"domain\": \"{domain_name}\", \"descriptions\": [\"...\"]}}.")


@register("build_queries", O.with_(O.base_ctes()) + f"""SELECT line_no, CAST(generate_subscripts(qs, 1) AS INTEGER)
  AS query_index, unnest(qs) AS query_text
FROM (SELECT line_no, list_filter([{_STRIP('description_1')}, {_STRIP('description_2')}],
        lambda x: x IS NOT NULL AND x <> '') AS qs FROM sales_raw)""")
def q_build_queries(spark, sf_dir):
    """P8 over the descriptions of every sales row."""
    raw = fx.sales_raw(spark, sf_dir).select("line_no", F.array("description_1", "description_2").alias("descriptions"))
    return build_queries(raw).select("line_no", "query_index", "query_text")


@register("validate_inputs", O.with_(O.base_ctes()) + f"""SELECT line_no, {_STRIP('domain')} AS domain,
  CASE WHEN {_STRIP('domain')} IS NULL THEN 'missing domain' WHEN {_STRIP('domain')} = '' THEN 'empty domain' END
  AS reject_reason FROM sales_raw""")
def q_validate_inputs(spark, sf_dir):
    """P25: accepted and rejected input names (rejects carry a reason)."""
    ok, bad = EN.validate_inputs(fx.sales_raw(spark, sf_dir).select("line_no", "domain"))
    return ok.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)


@register("render_prompt", O.with_(O.base_ctes())
          + "SELECT input_id, replace('" + PROMPT_TEMPLATE.replace("'", "''")
          + "', '{domain_name}', domain) AS prompt FROM responses")
def q_render_prompt(spark, sf_dir):
    return EN.render_prompt(fx.responses(spark, sf_dir), PROMPT_TEMPLATE).select("input_id", "prompt")


def _cats_sql() -> str:
    return "[" + ", ".join(f"'{c}'" for c in config.CATEGORIES) + "]"


_VALID_CTE = f"""vj AS (SELECT r.*, CASE WHEN coalesce(json_valid(response), false) THEN response END AS rj
  FROM responses r),
ve AS (SELECT r.*, CASE
    WHEN rj IS NULL THEN 'invalid json'
    WHEN json_type(rj) <> 'OBJECT' THEN 'invalid json'
    WHEN json_extract(rj, '$.primary_category') IS NULL OR json_extract(rj, '$.secondary_category') IS NULL
      OR json_extract(rj, '$.descriptions') IS NULL THEN 'missing key'
    WHEN json_type(rj, '$.descriptions') <> 'ARRAY' THEN 'descriptions not a list'
    WHEN json_array_length(rj, '$.descriptions') < 1 THEN 'no descriptions'
    WHEN json_extract_string(rj, '$.primary_category')
      IS NOT DISTINCT FROM json_extract_string(rj, '$.secondary_category') THEN 'same categories'
  END AS reject_reason FROM vj r),
vv AS (SELECT input_id, domain, reject_reason, reject_reason IS NULL AS is_valid,
    CASE WHEN reject_reason IS NULL THEN json_extract_string(rj, '$.primary_category') END AS primary_category,
    CASE WHEN reject_reason IS NULL THEN json_extract_string(rj, '$.secondary_category') END AS secondary_category,
    CASE WHEN reject_reason IS NULL THEN CAST(json_array_length(rj, '$.descriptions') AS INTEGER) END
      AS n_descriptions,
    CASE WHEN reject_reason IS NULL THEN json_extract_string(rj, '$.descriptions[0]') END AS first_description,
    coalesce((reject_reason IS NULL)
      AND list_contains({_cats_sql()}, json_extract_string(rj, '$.primary_category'))
      AND list_contains({_cats_sql()}, json_extract_string(rj, '$.secondary_category')), false)
      AS known_categories,
    coalesce((reject_reason IS NULL) AND json_array_length(rj, '$.descriptions') <= 2, false) AS max_two
  FROM ve)"""


def _validated(spark, sf_dir):
    v = EN.validate_enrichment(fx.responses(spark, sf_dir))
    return (v.withColumn("n_descriptions", F.size("descriptions").cast("int"))
            .withColumn("n_descriptions", F.when(F.col("is_valid"), F.col("n_descriptions")))
            .withColumn("first_description", F.get(F.col("descriptions"), 0))
            .withColumn("known_categories", F.coalesce(F.col("known_categories"), F.lit(False)))
            .withColumn("max_two", F.coalesce(F.col("max_two"), F.lit(False))))


_VALID_COLS = ["input_id", "domain", "is_valid", "reject_reason", "primary_category", "secondary_category",
               "n_descriptions", "first_description", "known_categories", "max_two"]


@register("validate_enrichment", O.with_(O.base_ctes(), _VALID_CTE) + "SELECT " + ", ".join(_VALID_COLS) + " FROM vv")
def q_validate_enrichment(spark, sf_dir):
    """P22 (+ X2 from stored responses): published validity rule plus the stricter flags."""
    return _validated(spark, sf_dir).select(*_VALID_COLS)


@register("enrichment_fallback", O.with_(O.base_ctes(), _VALID_CTE) + f"""SELECT input_id,
  CASE WHEN is_valid THEN 'ok' ELSE 'fallback_enrichment' END AS status,
  CASE WHEN is_valid THEN primary_category ELSE '{config.FALLBACK_PRIMARY}' END AS primary_category,
  CASE WHEN is_valid THEN secondary_category ELSE '{config.FALLBACK_SECONDARY}' END AS secondary_category,
  CASE WHEN is_valid THEN first_description
       ELSE replace('{config.FALLBACK_DESCRIPTION_1}', '{{domain}}', domain) END AS first_description,
  CASE WHEN is_valid THEN NULL ELSE concat('{config.FALLBACK_ERROR_PREFIX}', reject_reason) END AS error,
  CASE WHEN is_valid THEN NULL ELSE '{config.FALLBACK_WARNING}' END AS warning
FROM vv""")
def q_enrichment_fallback(spark, sf_dir):
    """Invalid responses replaced by the fixed categories and template descriptions."""
    fb = EN.enrichment_fallback(EN.validate_enrichment(fx.responses(spark, sf_dir)))
    return fb.select("input_id", "status", "primary_category", "secondary_category",
                     F.get(F.col("descriptions"), 0).alias("first_description"), "error", "warning")


@register("report_rows", O.with_(O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes())
          + """SELECT input_id, final_rank AS rank, domain, format('{:,.0f}', price) AS price_text,
  printf('%.4f', score) AS score_text, printf('%.4f', semantic_sim) AS semantic_text,
  printf('%.2f', cat_match) AS category_text, printf('%.2f', recency) AS recency_text,
  concat(primary_category, ', ', secondary_category) AS categories, date, platform, query_index, desc_index,
  substring(description, 1, 100) AS description_100 FROM ranked""")
def q_report_rows(spark, sf_dir):
    """P26 + W7: numbered report lines with all their fields."""
    from comparo.plans.comparables import report_rows
    corpus, q = _inputs(spark, sf_dir)
    return report_rows(comparables(q, corpus, AS_OF))


@register("result_json", O.with_(O.base_ctes(), O.retrieval_ctes(), O.scoring_ctes(), _RESULTS_CTE)
          + """SELECT input_id, input_domain, total_comparables, confidence,
  CAST(len(descriptions) AS INTEGER) AS n_descriptions, top_domain FROM results""")
def q_result_json(spark, sf_dir):
    """One JSON result record per input, its fields parsed back."""
    from comparo.plans.comparables import results_json
    corpus, q = _inputs(spark, sf_dir)
    out = results_json(assemble_results(fx.inputs_in(spark, sf_dir, corpus), comparables(q, corpus, AS_OF)))
    fields = F.from_json("json", "input_domain string, total_comparables bigint, confidence string, "
                                 "descriptions array<string>, comparables array<struct<rank:int,domain:string>>")
    return out.select("input_id", fields.alias("r")).select(
        "input_id", "r.input_domain", "r.total_comparables", "r.confidence",
        F.size("r.descriptions").alias("n_descriptions"), F.get(F.col("r.comparables"), 0)["domain"].alias("top_domain"))


def _ingest_sql() -> str:
    return O.with_(O.base_ctes(), *_BUILD_CTES, _hash_vec_ctes("bvec", "built", "id", "document")) + \
        "SELECT b.*, v.embedding FROM built b LEFT JOIN bvec v ON v.id = b.id"


@register("ingest_stream")
def q_ingest_stream(spark, sf_dir):
    """The sales file arrives as two plain CSV drops; a file stream appends unseen ids to the corpus, all columns."""
    from comparo.session import shared_path
    from comparo.sources.sales_csv import write_sales_csv
    from comparo.streaming.ingest import run_ingest
    raw = fx.sales_raw(spark, sf_dir)
    src = shared_path(spark, "incoming")
    write_sales_csv(raw.where(F.col("line_no") % 2 == 0).drop("line_no"), f"{src}/drop1")
    write_sales_csv(raw.where(F.col("line_no") % 2 == 1).drop("line_no"), f"{src}/drop2")
    corpus_dir = shared_path(spark, "stream_corpus")
    run_ingest(spark, f"{src}/*", corpus_dir, shared_path(spark, "stream_ckpt"))
    return spark.read.parquet(corpus_dir).select(*C.CORPUS_COLUMNS, "embedding")


# --------------------------------------------------------------------------- E3 from names (text path)

def _hash_vec_ctes(name: str, src: str, keys: str, text: str, dim: int = 64) -> str:
    """Dense hashing vectors in SQL: md5 bucket of every token, counts / L2 norm, as FLOAT[dim]."""
    return f"""{name}_t AS (SELECT {keys}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS tok
    FROM {src}),
{name}_c AS (SELECT {keys}, CAST(CAST(('0x' || substr(md5(tok), 1, 8)) AS BIGINT) % {dim} AS INTEGER) AS bucket,
    count(*) AS n FROM {name}_t WHERE tok <> '' GROUP BY ALL),
{name} AS (SELECT {keys}, list_transform(range({dim}), lambda i: CAST(coalesce(m[i], 0) / nrm AS FLOAT)) AS embedding
  FROM (SELECT {keys}, map_from_entries(list(struct_pack(k := bucket, v := n))) AS m, sqrt(sum(n * n)) AS nrm
        FROM {name}_c GROUP BY ALL))"""


_ZEROS64 = "list_transform(range(64), lambda i: CAST(0 AS FLOAT))"
_SEARCH_SQL = O.with_(
    O.base_ctes(), *_BUILD_CTES,
    _hash_vec_ctes("bvec", "built", "id", "document"),
    f"corpus2 AS (SELECT b.*, coalesce(v.embedding, {_ZEROS64}) AS embedding FROM built b LEFT JOIN bvec v ON v.id = b.id)",
    f"sinp AS (SELECT line_no AS input_id, {_STRIP('domain')} AS domain FROM sales_raw)",
    "acc AS (SELECT * FROM sinp WHERE domain IS NOT NULL AND domain <> '')",
    """rej AS (SELECT input_id, domain, CASE WHEN domain IS NULL THEN 'missing domain' ELSE 'empty domain' END AS reason
  FROM sinp WHERE domain IS NULL OR domain = '')""",
    re.sub(r"\b(vj|ve|vv)\b", r"r\1", _VALID_CTE).replace("SELECT input_id, domain, reject_reason,",
                                                         "SELECT input_id, domain, response, reject_reason,"),
    O.suffix_split_cte("isx", "acc", "input_id, domain", O.host_sql("domain")),
    """par AS (SELECT input_id, domain, sld, CASE WHEN sfx = '' THEN '.com' ELSE concat('.', sfx) END AS tld,
    CAST(length(sld) AS INTEGER) AS length, coalesce(regexp_matches(sld, '[0-9]'), false) AS has_numbers FROM isx)""",
    # a broken second answer for every sixth domain sorts before the good one and must not displace it
    """answers AS (SELECT domain, response FROM responses
  UNION ALL SELECT domain, '[bad' FROM responses WHERE input_id % 6 = 0),
best AS (SELECT domain, response FROM (SELECT a.*, row_number() OVER (PARTITION BY a.domain
    ORDER BY coalesce(v.is_valid, false) DESC, a.response) AS rn
  FROM answers a LEFT JOIN (SELECT domain, response, is_valid FROM rvv) v
    ON v.domain = a.domain AND v.response = a.response) WHERE rn = 1),
resp AS (SELECT p.input_id, p.domain, r.response FROM par p LEFT JOIN best r ON r.domain = p.domain)""",
    _VALID_CTE.replace("FROM responses r)", "FROM resp r)").replace(
        "vv AS (SELECT input_id, domain, reject_reason,", "vv AS (SELECT input_id, domain, rj, reject_reason,"),
    f"""en AS (SELECT v.input_id, v.domain, p.sld, p.tld, p.length, p.has_numbers,
    CASE WHEN v.is_valid THEN v.primary_category ELSE '{config.FALLBACK_PRIMARY}' END AS primary_category,
    CASE WHEN v.is_valid THEN v.secondary_category ELSE '{config.FALLBACK_SECONDARY}' END AS secondary_category,
    CASE WHEN v.is_valid THEN json_extract_string(v.rj, '$.descriptions[*]')
         ELSE [replace('{config.FALLBACK_DESCRIPTION_1}', '{{domain}}', v.domain), '{config.FALLBACK_DESCRIPTION_2}']
    END AS descriptions,
    CASE WHEN v.is_valid THEN 'ok' ELSE 'fallback_enrichment' END AS status,
    CASE WHEN v.is_valid THEN NULL ELSE concat('{config.FALLBACK_ERROR_PREFIX}', v.reject_reason) END AS error
  FROM vv v JOIN par p ON p.input_id = v.input_id)""",
    f"""qs AS (SELECT input_id, list_filter(list_transform(descriptions, lambda x: {_STRIP('x')}),
    lambda x: x IS NOT NULL AND x <> '') AS qs FROM en)""",
    """qx AS (SELECT input_id, CAST(generate_subscripts(qs, 1) AS INTEGER) AS query_index, unnest(qs) AS query_text
  FROM qs)""",
    _hash_vec_ctes("qvec", "qx", "input_id, query_index", "query_text"),
    f"""queries2 AS (SELECT x.input_id, x.query_index, e.domain AS input_domain, e.sld, e.tld, e.length,
    e.primary_category, e.secondary_category, e.has_numbers, coalesce(v.embedding, {_ZEROS64}) AS embedding
  FROM qx x JOIN en e ON e.input_id = x.input_id
  LEFT JOIN qvec v ON v.input_id = x.input_id AND v.query_index = x.query_index)""",
    O.retrieval_ctes(corpus="corpus2", queries="queries2"),
    O.scoring_ctes(corpus="corpus2", queries="queries2"),
) + """SELECT e.input_id, e.domain AS input_domain, e.status, CAST(coalesce(r.n, 0) AS BIGINT) AS total_comparables,
  CASE WHEN coalesce(r.n, 0) >= 5 THEN 'high' ELSE 'low' END AS confidence, r.top_domain, e.error
FROM en e LEFT JOIN (SELECT input_id, count(*) AS n, max(CASE WHEN final_rank = 1 THEN domain END) AS top_domain
           FROM ranked GROUP BY input_id) r ON r.input_id = e.input_id
UNION ALL
SELECT input_id, domain AS input_domain, 'error' AS status, NULL AS total_comparables, NULL AS confidence,
  NULL AS top_domain, reason AS error FROM rej"""


@register("search_domains", _SEARCH_SQL)
def q_search_domains(spark, sf_dir):
    """E3 end to end from names: every sales-file name is an input, enriched from the stored responses
    (fallback when invalid), its descriptions embedded with the hashing encoder, and searched against the
    corpus built from the sales file."""
    from comparo.plans.build_corpus import build_corpus
    from comparo.plans.search import search_domains
    raw = fx.sales_raw(spark, sf_dir)
    corpus = materialize(build_corpus(raw), "built_corpus", compression="zstd")
    inputs = raw.select(F.col("line_no").alias("input_id"), "domain")
    out = search_domains(inputs, fx.repeated_responses(spark, sf_dir), corpus, AS_OF)
    return out.select("input_id", "input_domain", "status", "total_comparables", "confidence",
                      F.get(F.col("comparables"), 0)["domain"].alias("top_domain"), "error")


ORACLE["build_corpus_vectors"] = _build_vectors_sql()
ORACLE["ingest_stream"] = _ingest_sql()
