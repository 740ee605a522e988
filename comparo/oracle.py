"""ANSI SQL (DuckDB dialect) forms of the registered queries, for the side-by-side check.

Each string is one self-contained query over the driver tables (region ...
conversations are pre-registered views). The fixture derivation and every
operator are spelled out as CTEs; nothing here calls into Spark.
"""

from __future__ import annotations

from comparo import config

# Fixed values, written out here so that the SQL does not read them from the code that it checks.
TLD_CYCLE = [".com", ".com", ".net", ".org", ".io", ".ai", ".co.uk", ".zz"]
WHITE_SPACE = (r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
               r"\x{3000}]")
CATEGORIES = ["Acronym", "Brandable", "Combination", "Descriptive", "Exact match", "Geo-specific", "Generic",
              "Service-based", "Niche", "Keyword", "Product-based"]
FAMILIES = {
    "legacy_gold": ".com",
    "legacy_standard": ".net .org .info",
    "tech_modern": ".ai .io .co .app .dev .tech .cloud .software",
    "corporate_id": ".inc .llc .ltd .biz .company .corp .holdings",
    "ecommerce": ".shop .store .market .buy .deals .solutions .services",
    "niche_premium": ".bet .gg .game .tv .casino .poker",
    "creative": ".design .art .media .studio .agency .photography .news",
    "finance_web3": ".finance .money .pay .crypto .cash .bank",
    "geo_tier1": ".de .uk .ca .au .fr .nl .jp .us .eu",
    "geo_tier2": ".in .cn .br .me .sg .hk .kr .it .es .ch",
    "generic_modern": ".xyz .online .site .website .space .fun .life .world .live .digital",
}
FAMILY_ROWS = [(tld, family) for family, tlds in FAMILIES.items() for tld in tlds.split()]
SUFFIXES = sorted({tld[1:] for tld, _ in FAMILY_ROWS} | {"co.uk", "com.au", "co.jp", "com.br", "co.in"})
COMPATIBLE = [("Brandable", "Generic"), ("Descriptive", "Keyword"), ("Service-based", "Product-based"),
              ("Niche", "Generic")]
RECENCY = [(90, 1.0), (180, 0.9), (365, 0.8), (730, 0.6)]

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"


def _values(rows, cols) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WHITE_SPACE}+|{WHITE_SPACE}+$', '', 'g')"


def host_sql(x: str) -> str:
    h = f"split_part(replace(replace({x}, 'http://', ''), 'https://', ''), '/', 1)"
    h = f"regexp_replace({h}, '[?#].*$', '')"
    h = f"regexp_replace({h}, '^.*@', '')"
    h = f"regexp_replace({h}, ':.*$', '')"
    return f"regexp_replace({h}, '\\.+$', '')"


def numeric_pct_sql(s: str) -> str:
    return (f"CASE WHEN coalesce(length({s}), 0) = 0 THEN 0.0 "
            f"ELSE length(regexp_replace({s}, '[^0-9]', '', 'g')) / length({s}) END")


def _last_labels(host: str, k: int) -> str:
    pat = "([^.]*)$" if k == 1 else "(?:^|\\.)([^.]*(?:\\.[^.]*){" + str(k - 1) + "})$"
    return f"regexp_extract({host}, '{pat}', 1)"


def suffix_split_cte(name: str, src: str, key_cols: str, host_expr: str) -> str:
    """CTE ``name`` with key_cols, host, sfx, sld: the longest known suffix and the label before it."""
    k_max = max(s.count(".") + 1 for s in SUFFIXES)
    joins, case = [], "''"
    for k in range(1, k_max + 1):
        joins.append(f"LEFT JOIN suffixes s{k} ON s{k}.suffix = lower({_last_labels('h.host', k)})")
        case = f"CASE WHEN s{k}.suffix IS NOT NULL THEN {_last_labels('h.host', k)} ELSE {case} END"
    return f"""{name}_h AS (SELECT {key_cols}, {host_expr} AS host FROM {src}),
{name}_s AS (SELECT h.*, {case} AS sfx FROM {name}_h h {' '.join(joins)}),
{name} AS (SELECT s.*, {_last_labels(
        "CASE WHEN s.sfx = '' THEN s.host ELSE left(s.host, greatest(length(s.host) - length(s.sfx) - 1, 0)) END",
        1)} AS sld FROM {name}_s s)"""


def base_ctes() -> str:
    fam = _values(FAMILY_ROWS, ["tld", "family"])
    cyc = _values(list(enumerate(TLD_CYCLE)), ["i", "tld"])
    cats = _values(list(enumerate(CATEGORIES)), ["i", "category"])
    sfx = _values([(s,) for s in SUFFIXES], ["suffix"])
    return f"""tld_families AS ({fam}),
suffixes AS ({sfx}),
tld_cycle AS ({cyc}),
categories AS ({cats}),
counted AS (SELECT (SELECT count(*) FROM part) AS n_parts, (SELECT count(*) FROM documents) AS n_docs,
    (SELECT count(*) FROM embeddings) AS n_vecs),
copies AS (SELECT unnest(range(greatest(1, CAST(ceil(greatest(n_docs, n_vecs) / (2.0 * greatest(n_parts, 1)))
    AS BIGINT)))) AS copy FROM counted),
sold AS (SELECT l_partkey, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_partkey),
domains AS (
  SELECT d.dk, concat(d.sld, t.tld) AS domain, d.sld, t.tld, CAST(length(d.sld) AS INTEGER) AS length, d.price,
    d.sale_date, c1.category AS primary_category, c2.category AS secondary_category, d.platform
  FROM (SELECT k.dk, k.p_retailprice AS price, k.p_brand AS platform,
          concat(split_part(k.p_name, ' ', 1), CASE WHEN k.dk % 5 = 0 THEN CAST(10000 + k.dk AS VARCHAR)
            ELSE concat('z', translate(CAST(k.dk AS VARCHAR), '0123456789', 'abcdefghij')) END) AS sld,
          CAST(CASE k.dk % 3 WHEN 0 THEN s.last_day WHEN 1 THEN s.first_day
            ELSE s.first_day + CAST((s.last_day - s.first_day) // 2 AS INTEGER) END AS VARCHAR) AS sale_date
        FROM (SELECT p.*, p.p_partkey + c.copy * n.n_parts AS dk FROM part p, copies c, counted n) k
        LEFT JOIN sold s ON s.l_partkey = k.p_partkey) d
  JOIN tld_cycle t ON t.i = d.dk % 8
  JOIN categories c1 ON c1.i = d.dk % 11
  JOIN categories c2 ON c2.i = (d.dk % 11 + 1 + d.dk % 3) % 11),
corpus AS (
  SELECT concat(d.domain, '__desc', CAST(i.desc_index AS VARCHAR)) AS id, d.*, i.desc_index,
    regexp_matches(d.sld, '[0-9]') AS has_numbers,
    concat('Domain: ', d.domain, '. Category: ', d.primary_category, ', ', d.secondary_category,
           '. Description: ', coalesce(x.text, '')) AS document,
    e.embedding
  FROM domains d CROSS JOIN (SELECT 1 AS desc_index UNION ALL SELECT 2) i CROSS JOIN counted n
  LEFT JOIN embeddings e ON e.vec_id = (d.dk * 2 + i.desc_index - 1) % n.n_vecs
  LEFT JOIN documents x ON x.doc_id = (d.dk * 2 + i.desc_index - 1) % n.n_docs),
queries_in AS (
  SELECT dk AS input_id, desc_index AS query_index, domain AS input_domain, sld, tld, length,
    primary_category, secondary_category, has_numbers, embedding FROM corpus),
sales_raw AS (
  SELECT d.dk AS line_no,
    CASE WHEN d.dk % 17 = 0 THEN NULL WHEN d.dk % 19 = 0 THEN '   '
         WHEN d.dk % 7 = 0 THEN concat(' ', d.domain, ' ') ELSE d.domain END AS domain,
    CASE WHEN d.dk % 11 = 0 THEN NULL WHEN d.dk % 13 = 0 THEN 'n/a'
         ELSE concat('$1,', CAST(100 + d.dk % 900 AS VARCHAR), '.50') END AS price,
    CASE WHEN d.dk % 23 = 0 THEN '' ELSE x1.text END AS description_1,
    CASE WHEN d.dk % 3 = 0 THEN NULL WHEN d.dk % 5 = 0 THEN ' ' ELSE x2.text END AS description_2,
    d.primary_category, d.secondary_category, d.platform, d.sale_date AS date
  FROM domains d CROSS JOIN counted n LEFT JOIN documents x1 ON x1.doc_id = (d.dk * 2) % n.n_docs
  LEFT JOIN documents x2 ON x2.doc_id = (d.dk * 2 + 1) % n.n_docs),
pairs AS (
  SELECT a.id AS id_a, b.id AS id_b, a.tld AS in_tld, a.length AS in_length, b.length AS cand_length,
    a.primary_category AS in_primary,
    a.secondary_category AS in_secondary, a.embedding AS emb_a, b.tld AS cand_tld,
    b.primary_category AS cand_primary, b.secondary_category AS cand_secondary, b.sale_date, b.embedding AS emb_b
  FROM corpus a JOIN corpus b ON b.dk = a.dk + 1 AND b.desc_index = a.desc_index),
responses AS (
  SELECT dk AS input_id, domain,
    CASE WHEN dk % 13 = 0 THEN concat('{{"domain": "', domain, '", "primary_category": ')
         WHEN dk % 17 = 0 THEN '[1, 2]'
         WHEN dk % 11 = 0 THEN concat(hd, pr, '", "secondary_category": "', secondary_category, '"', '', '}}')
         WHEN dk % 9 = 0 THEN concat(hd, pr, '", "secondary_category": "', pr, '"', gd, '}}')
         WHEN dk % 7 = 0 THEN concat(hd, pr, '", "secondary_category": "', secondary_category, '"',
                                     ', "descriptions": []', '}}')
         WHEN dk % 23 = 0 THEN concat(hd, pr, '", "secondary_category": "', secondary_category, '"',
                                     ', "descriptions": ["  ", ""]', '}}')
         WHEN dk % 5 = 0 THEN concat(hd, pr, '", "secondary_category": "', secondary_category, '"',
                                     ', "descriptions": "not a list"', '}}')
         ELSE concat(hd, pr, '", "secondary_category": "', secondary_category, '"', gd, '}}') END AS response
  FROM (SELECT *, concat('{{"domain": "', domain, '", "primary_category": "') AS hd,
          CASE WHEN dk % 19 = 0 THEN 'Premium' ELSE primary_category END AS pr,
          concat(', "descriptions": ["A ', lower(CASE WHEN dk % 19 = 0 THEN 'Premium' ELSE primary_category END),
                 ' name for ', sld, '.", "Used by ', platform, ' buyers."',
                 CASE WHEN dk % 3 = 0 THEN ', "A third idea."' ELSE '' END, ']') AS gd
        FROM domains)),
inputs_in AS (
  SELECT c.dk AS input_id, c.domain AS input_domain, c.sld, c.tld, c.length, c.primary_category, c.secondary_category,
    list(regexp_extract(document, '(?s)\\. Description: (.*)$', 1) ORDER BY desc_index) AS descriptions
  FROM corpus c GROUP BY ALL),
corpus_gaps AS (
  SELECT * REPLACE (CASE WHEN dk % 4 = 0 THEN NULL ELSE length END AS length,
                    CASE WHEN dk % 4 = 0 THEN NULL ELSE tld END AS tld,
                    CASE WHEN dk % 4 = 0 OR dk % 8 = 1 THEN NULL ELSE has_numbers END AS has_numbers)
  FROM corpus)"""


def category_match_sql(cp, cs, ip, isec) -> str:
    compat = " OR ".join(f"({cp} = '{a}' AND {ip} = '{b}') OR ({cp} = '{b}' AND {ip} = '{a}')"
                         for a, b in COMPATIBLE)
    return (f"CAST(CASE WHEN {cp} IS NOT DISTINCT FROM {ip} THEN 1.0 "
            f"WHEN {cs} IS NOT DISTINCT FROM {ip} OR {cp} IS NOT DISTINCT FROM {isec} THEN 0.7 "
            f"WHEN coalesce({compat}, false) THEN 0.5 ELSE 0.0 END AS DOUBLE)")


def recency_sql(date: str, mode: str = "bands") -> str:
    if mode == "constant":
        return "CAST(0.5 AS DOUBLE)"
    ts = f"CASE WHEN regexp_matches({date}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast({date} AS TIMESTAMP) END"
    days = f"floor((epoch_us({AS_OF}) - epoch_us({ts})) / 86400000000)"
    bands = " ".join(f"WHEN {days} < {lim} THEN {w}" for lim, w in RECENCY)
    return f"CAST(CASE WHEN ({ts}) IS NULL THEN 0.5 {bands} ELSE 0.3 END AS DOUBLE)"


def semantic_sql(d: str) -> str:
    d = f"coalesce(CAST({d} AS DOUBLE), CAST(0 AS DOUBLE))"
    return f"CASE WHEN isnan({d}) OR {d} < 0 THEN CAST(0.5 AS DOUBLE) ELSE 1.0 / (1.0 + {d}) END"


def description_sql(doc: str) -> str:
    p1, p2 = f"instr({doc}, 'Description: ')", f"instr({doc}, 'Description:')"
    prim = (f"CASE WHEN {p1} > 0 THEN {strip_sql(f'substring({doc}, {p1} + 13)')} "
            f"WHEN {p2} > 0 THEN {strip_sql(f'substring({doc}, {p2} + 12)')} END")
    rem = f"split_part({doc}, 'Category:', 2)"
    p3 = f"instr({rem}, 'Description')"
    fb = strip_sql(f"regexp_replace(substring({rem}, {p3} + 11), '^[: .]+', '')")
    return (f"coalesce(CASE WHEN ({prim}) IS NOT NULL AND ({prim}) <> '' THEN ({prim}) "
            f"WHEN instr({doc}, 'Category:') > 0 AND {p3} > 0 THEN {fb} END, '')")


def knn_ctes(name: str, queries: str, use_tld: bool, k: int = 50, d: int = 2, corpus: str = "corpus") -> str:
    """Top-k filtered neighbours, every pair of the filter's rows + row_number. A query has a row for each length of its band, so
    that pairs are found by a hash join."""
    tld_cond = "c.tld_key = q.tld_key AND " if use_tld else ""
    return f"""{name}_q AS MATERIALIZED (SELECT qq.*, coalesce(f.family, qq.tld) AS tld_key,
    qq.length + unnest(range(-{d}, {d} + 1)) AS band FROM {queries} qq LEFT JOIN tld_families f ON f.tld = qq.tld),
{name}_c AS MATERIALIZED (SELECT cc.id, cc.length, cc.primary_category, cc.secondary_category, cc.embedding,
    coalesce(f.family, cc.tld) AS tld_key FROM {corpus} cc LEFT JOIN tld_families f ON f.tld = cc.tld),
{name}_p AS (
  SELECT q.input_id, q.query_index, c.id,
    list_distance(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS distance
  FROM {name}_q q JOIN {name}_c c ON {tld_cond}c.length = q.band
   AND (c.primary_category IN (q.primary_category, q.secondary_category)
        OR c.secondary_category IN (q.primary_category, q.secondary_category))),
{name} AS MATERIALIZED (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY input_id, query_index
    ORDER BY distance, id) AS INTEGER) AS rank FROM {name}_p) WHERE rank <= {k})"""


def retrieval_ctes(settings: config.Settings = config.DEFAULT, corpus: str = "corpus",
                   queries: str = "queries_in") -> str:
    t = settings.numeric_threshold
    pct = numeric_pct_sql("cs_sld.sld")
    numeric = f"CASE WHEN coalesce(fl.has_numbers, false) THEN {pct} >= {t} ELSE {pct} < {t} END"
    return f"""{suffix_split_cte('cs_sld', corpus, 'id', host_sql('domain'))},
flags AS (SELECT DISTINCT input_id, has_numbers FROM {queries}),
{knn_ctes('knn1', queries, True, settings.results_per_query, settings.max_length_diff, corpus)},
t1 AS (SELECT k.input_id, k.query_index, k.rank, k.id, k.distance FROM knn1 k
  JOIN cs_sld ON cs_sld.id = k.id JOIN flags fl ON fl.input_id = k.input_id WHERE {numeric}),
cnt AS (SELECT i.input_id, count(t1.id) AS n FROM (SELECT DISTINCT input_id FROM {queries}) i
  LEFT JOIN t1 ON t1.input_id = i.input_id GROUP BY i.input_id),
need AS (SELECT input_id FROM cnt WHERE n < {settings.min_results_for_no_fallback}),
q2 AS (SELECT * FROM {queries} WHERE input_id IN (SELECT input_id FROM need)),
{knn_ctes('knn2', 'q2', False, settings.results_per_query, settings.max_length_diff, corpus)},
t2 AS (SELECT k.input_id, k.query_index, k.rank, k.id, k.distance FROM knn2 k
  JOIN cs_sld ON cs_sld.id = k.id JOIN flags fl ON fl.input_id = k.input_id WHERE {numeric}),
cands AS (SELECT *, 1 AS tier FROM t1 WHERE input_id NOT IN (SELECT input_id FROM need)
  UNION ALL SELECT *, 2 AS tier FROM t2)"""


def scoring_ctes(cands: str = "cands", settings: config.Settings = config.DEFAULT, corpus: str = "corpus",
                 queries: str = "queries_in") -> str:
    ws, wc, wr = settings.weight_semantic, settings.weight_category, settings.weight_recency
    return f"""inp AS (SELECT DISTINCT input_id, primary_category AS ip, secondary_category AS isec FROM {queries}),
sc0 AS (SELECT ca.input_id, ca.query_index, ca.rank, co.domain, co.price, co.sale_date AS date, co.platform,
    co.primary_category, co.secondary_category, co.desc_index, {description_sql('co.document')} AS description,
    {semantic_sql('ca.distance')} AS sem,
    {category_match_sql('co.primary_category', 'co.secondary_category', 'i.ip', 'i.isec')} AS cat,
    {recency_sql('co.sale_date', settings.recency)} AS rec
  FROM {cands} ca JOIN {corpus} co ON co.id = ca.id JOIN inp i ON i.input_id = ca.input_id),
sc AS (SELECT *, round(sem, 4) AS semantic_sim, round(cat, 2) AS cat_match, round(rec, 2) AS recency,
    round({ws} * sem + {wc} * cat + {wr} * rec, 4) AS score FROM sc0),
kept AS (SELECT *,
    first_value(query_index) OVER (PARTITION BY input_id, domain ORDER BY query_index, rank) AS fq,
    first_value(rank) OVER (PARTITION BY input_id, domain ORDER BY query_index, rank) AS fr,
    row_number() OVER (PARTITION BY input_id, domain ORDER BY score DESC, query_index, rank) AS rn
  FROM sc WHERE score >= {settings.min_score}),
ranked AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY input_id ORDER BY score DESC, fq, fr)
    AS INTEGER) AS final_rank FROM kept WHERE rn = 1) WHERE final_rank <= {settings.final_top_k})"""


RESULT_SELECT = ("input_id, final_rank AS rank, domain, price, date, platform, primary_category, secondary_category, "
                 "description, semantic_sim, cat_match, recency, score, desc_index, query_index")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
