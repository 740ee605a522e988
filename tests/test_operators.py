"""Operator tests: suffix split, filter spec, kNN exactness and tiling, ranking rules, corpus ops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparo import config
from comparo.operators import corpus_ops as C
from comparo.operators.filters import spec_to_column
from comparo.operators import suffix as suffix_rules
from comparo.operators.knn import knn_filtered, knn_pairs
from comparo.operators.ranking import rank_best
from comparo.operators.suffix import parse_domain, suffix_table


def test_parse_domain_cases(spark):
    names = ["https://www.Example.co.uk/path?q=1", "http://user@shop.example.com:8080/x", "bare", "web3.io",
             "a.b.unknownsuffix", "EXAMPLE.COM", "x.com.", "sub.example.org#frag", "co.uk"]
    df = spark.createDataFrame([(n,) for n in names], "d string")
    got = {r.d: (r.sld, r.tld, r.length, r.has_numbers) for r in parse_domain(df, "d").collect()}
    assert got["https://www.Example.co.uk/path?q=1"] == ("Example", ".co.uk", 7, False)
    assert got["http://user@shop.example.com:8080/x"] == ("example", ".com", 7, False)
    assert got["bare"] == ("bare", ".com", 4, False)  # no known suffix -> default .com
    assert got["web3.io"] == ("web3", ".io", 4, True)
    assert got["a.b.unknownsuffix"] == ("unknownsuffix", ".com", 13, False)
    assert got["EXAMPLE.COM"] == ("EXAMPLE", ".COM", 7, False)
    assert got["x.com."] == ("x", ".com", 1, False)
    assert got["sub.example.org#frag"] == ("example", ".org", 7, False)
    assert got["co.uk"] == ("", ".co.uk", 0, False)


def test_parse_domain_user_suffix_table(spark):
    df = spark.createDataFrame([("a.b.example.zz",), ("q.example.com",)], "d string")
    table = suffix_table(spark, ["zz", "example.zz", "com"])
    got = {r.d: (r.sld, r.tld) for r in parse_domain(df, "d", suffixes=table).collect()}
    assert got == {"a.b.example.zz": ("b", ".example.zz"), "q.example.com": ("example", ".com")}


def test_filter_spec(spark):
    df = spark.createDataFrame([(5, ".com", "Brandable"), (9, ".io", "Generic"), (9, ".net", "Brandable"),
                                (20, ".com", "Brandable")], "length int, tld string, primary_category string")
    spec = {"$and": [{"length": {"$gte": 8, "$lte": 12}},
                     {"$or": [{"tld": {"$in": [".com", ".io"]}}, {"primary_category": {"$eq": "Brandable"}}]}]}
    assert [r.length for r in df.where(spec_to_column(spec)).orderBy("tld").collect()] == [9, 9]
    with pytest.raises(ValueError):
        spec_to_column({"length": {"$like": 3}})
    with pytest.raises(ValueError):
        spec_to_column({"$nor": []})


def _random_fixture(spark, n_corpus=400, n_queries=40, dim=8, seed=7):
    rng = np.random.default_rng(seed)
    tlds = [".com", ".net", ".io", ".zz", ".co.uk"]
    cats = config.CATEGORIES[:4]
    corpus = [(f"id{i:04d}", tlds[i % 5], int(rng.integers(3, 9)), cats[i % 4], cats[(i // 4) % 4],
               [float(x) for x in rng.normal(size=dim).round(2)]) for i in range(n_corpus)]
    # duplicate vectors create exact distance ties, broken by id
    corpus += [(f"dup{i:04d}", c[1], c[2], c[3], c[4], c[5]) for i, c in enumerate(corpus[:30])]
    queries = [(i, 1 + i % 2, tlds[i % 5], int(rng.integers(3, 9)), cats[i % 4], cats[(i + 1) % 4],
                [float(x) for x in rng.normal(size=dim).round(2)]) for i in range(n_queries)]
    c = spark.createDataFrame(corpus, "id string, tld string, length int, primary_category string, "
                                      "secondary_category string, embedding array<float>")
    q = spark.createDataFrame(queries, "input_id long, query_index int, tld string, length int, "
                                       "primary_category string, secondary_category string, embedding array<float>")
    return corpus, queries, c, q


def _brute(corpus, queries, k, use_tld):
    fam = {t: f for t, f in config.family_rows()}
    key = lambda t: fam.get(t, t)
    out = []
    for qi, qx, qt, ql, qp, qs, qv in queries:
        hits = []
        for cid, ct, cl, cp, cs, cv in corpus:
            if use_tld and key(ct) != key(qt):
                continue
            if abs(cl - ql) > 2 or not ({cp, cs} & {qp, qs}):
                continue
            a = np.asarray(qv, dtype=np.float32).astype(np.float64)
            b = np.asarray(cv, dtype=np.float32).astype(np.float64)
            hits.append((math.sqrt(float(((a - b) ** 2).sum())), cid))
        hits.sort()
        out += [(qi, qx, cid, r + 1) for r, (d, cid) in enumerate(hits[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile_rows,q_tile_rows,use_tld", [(2048, 2048, True), (7, 7, True), (3, 3, False),
                                                            (5, 64, True)])
def test_knn_matches_brute_force_under_any_tiling(spark, tile_rows, q_tile_rows, use_tld):
    corpus, queries, c, q = _random_fixture(spark)
    s = config.Settings(knn_tile_rows=tile_rows, knn_query_tile_rows=q_tile_rows, knn_rerank_margin=2)
    got = knn_filtered(q, c, use_tld=use_tld, settings=s, k=5)
    got = sorted((r.input_id, r.query_index, r.id, r.rank) for r in got.collect())
    assert got == _brute(corpus, queries, 5, use_tld)


def test_rank_best_rules(spark):
    rows = [  # input, query_index, rank, domain, score
        (1, 1, 1, "a", 0.50), (1, 1, 2, "b", 0.60), (1, 2, 1, "a", 0.70), (1, 2, 2, "c", 0.70),
        (1, 2, 3, "d", 0.39), (1, 1, 3, "e", 0.60), (2, 1, 1, "x", 0.41)]
    df = spark.createDataFrame(rows, "input_id long, query_index int, rank int, domain string, score double")
    got = [(r.input_id, r.rank, r.domain, r.score, r.query_index)
           for r in rank_best(df).orderBy("input_id", "rank").collect()]
    # a: best 0.70 from query 2, first seen at (1,1) -> ahead of c (first seen at (2,2)); d below threshold
    assert got == [(1, 1, "a", 0.70, 2), (1, 2, "c", 0.70, 2), (1, 3, "b", 0.60, 1), (1, 4, "e", 0.60, 1),
                   (2, 1, "x", 0.41, 1)]
    many = spark.createDataFrame([(1, 1, i, f"d{i}", 0.9) for i in range(1, 30)],
                                 "input_id long, query_index int, rank int, domain string, score double")
    assert rank_best(many).count() == 10


def test_upsert_twice_equals_once(spark):
    existing = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, price double")
    new = spark.createDataFrame([("b", 5.0), ("c", 3.0)], "id string, price double")
    once = C.upsert(existing, new)
    twice = C.upsert(once, new)
    assert sorted(once.collect()) == sorted(twice.collect()) == sorted(
        [("a", 1.0), ("b", 5.0), ("c", 3.0)])


def test_explode_and_dedup(spark):
    raw = spark.createDataFrame([
        (1, " x.com ", "$1,000", "first", "  ", "A", "B", "p", "2001-01-01"),
        (2, "x.com", "5", "later copy", "second", "A", "B", "p", "2001-01-01"),
        (3, None, "1", "t", "u", "A", "B", "p", "d"),
        (4, "y.io", "n/a", "", "only two", None, "B", "p", "d"),
        (5, "z.net", "1", None, None, "A", "B", "p", "d")],
        "line_no long, domain string, price string, description_1 string, description_2 string, "
        "primary_category string, secondary_category string, platform string, date string")
    rows = C.dedup_ids(C.explode_descriptions(C.clean_sales(raw)))
    got = sorted((r.id, r.line_no, r.description) for r in rows.collect())
    assert got == [("x.com__desc1", 1, "first"), ("x.com__desc2", 2, "second"), ("y.io__desc2", 4, "only two")]
    doc = C.document_text(rows).where(F.col("id") == "y.io__desc2").first().document
    assert doc == "Domain: y.io. Category: Unknown, B. Description: only two"
    nan_rows = C.explode_descriptions(C.clean_sales(raw), null_as_text=True).where(F.col("line_no") == 5)
    assert sorted(r.description for r in nan_rows.collect()) == ["nan", "nan"]


def test_backfill(spark):
    df = spark.createDataFrame([("a", "shop12.io", None, None, None), ("b", "x.com", 1, ".com", False),
                                ("c", "plain", None, None, None)],
                               "id string, domain string, length int, tld string, has_numbers boolean")
    got = {r.id: (r.length, r.tld, r.has_numbers, r.backfilled) for r in C.backfill_metadata(df).collect()}
    assert got == {"a": (6, ".io", True, True), "b": (1, ".com", False, False), "c": (5, "", False, True)}


def test_knn_skips_rows_without_vectors(spark):
    corpus, queries, c, q = _random_fixture(spark, n_corpus=60, n_queries=6)
    c2 = c.unionByName(spark.createDataFrame([("nullvec", ".com", 5, "Acronym", "Acronym", None)], c.schema))
    q2 = q.unionByName(spark.createDataFrame([(999, 1, ".com", 5, "Acronym", "Brandable", None)], q.schema))
    got = knn_filtered(q2, c2, k=5)
    assert got.where("id = 'nullvec' OR input_id = 999").count() == 0
    assert got.count() == knn_filtered(q, c, k=5).count()


@pytest.mark.parametrize("bound", [200_000, 0])
def test_suffix_wildcard_and_exception_rules(spark, monkeypatch, bound):
    monkeypatch.setattr(suffix_rules, "LOOKED_UP", bound)  # looked up, and joined
    table = suffix_table(spark, ["*.ck", "!www.ck", "uk", "co.uk", "com", "// a comment"])
    names = ["foo.bar.ck", "www.ck", "a.www.ck", "ck", "a.b.co.uk", "x.uk", "shop.example.com"]
    df = spark.createDataFrame([(n,) for n in names], "d string")
    got = {r.d: (r.sld, r.tld) for r in parse_domain(df, "d", suffixes=table, default_tld="").collect()}
    assert got == {"foo.bar.ck": ("foo", ".bar.ck"), "www.ck": ("www", ".ck"), "a.www.ck": ("www", ".ck"),
                   "ck": ("ck", ""), "a.b.co.uk": ("b", ".co.uk"), "x.uk": ("x", ".uk"),
                   "shop.example.com": ("example", ".com")}


def test_knn_vectors_are_shuffled_once(spark):
    """The group of tiles is known before the shuffle: no exchange on the block alone carries vectors."""
    import contextlib
    import io
    _, _, c, q = _random_fixture(spark, n_corpus=60, n_queries=6)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        knn_filtered(q, c, k=5).explain()
    exchanges = [x for x in out.getvalue().splitlines() if "Exchange hashpartitioning" in x]
    assert sum("(grp" in x for x in exchanges) == 2 and not any("tld_key" in x for x in exchanges)


def test_knn_slices_do_not_change_results(spark, monkeypatch):
    from comparo.operators import knn
    corpus, queries, c, q = _random_fixture(spark)
    Q = np.array([x[6] for x in queries], dtype=float)
    C = np.array([x[5] for x in corpus], dtype=float)
    rank = np.argsort(np.argsort([x[0] for x in corpus]))
    allowed = np.random.default_rng(0).random((len(Q), len(C))) < 0.5
    i, j, d = knn._rank_slice(Q, C, allowed, rank, 5, 2, "l2")
    for k in range(len(Q)):
        every = np.flatnonzero(allowed[k])
        dist = np.sqrt(((Q[k] - C[every]) ** 2).sum(1))
        best = np.lexsort((rank[every], dist))[:5]
        assert j[i == k].tolist() == every[best].tolist()


def test_knn_temporaries_stay_small():
    import tracemalloc
    from comparo.operators import knn
    rng = np.random.default_rng(4)
    Q, C, rank = rng.normal(size=(128, 64)), rng.normal(size=(3000, 64)), rng.permutation(3000)
    allowed = np.ones((128, 3000), dtype=bool)
    tracemalloc.start()
    i, j, d = knn._rank_slice(Q, C, allowed, rank, 50, 16, "l2")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(d) == 128 * 50 and peak < 10 << 20


def test_knn_kth_value_of_each_query():
    from comparo.operators import knn
    rows = np.array([2, 0, 0, 2, 0, 2, 3], dtype=np.int64)
    near = np.array([-1.5, 3.0, -0.0, np.inf, -7.0, 1e-30, 4.0])
    for kind in (np.float32, np.float64):
        full, kth = knn._kth(rows, near.astype(kind), 5, 2)
        assert full.tolist() == [0, 2] and kth.tolist() == [0.0, np.array(1e-30, kind)] and kth.dtype == kind


def test_knn_ranks_chunk_by_chunk_with_many_copies(monkeypatch):
    """More equal vectors than the margin, in more rows than a chunk: ties go by id, without a pass over all rows."""
    from comparo.operators import knn
    monkeypatch.setattr(knn, "CHUNK_ROWS", 64)
    rng = np.random.default_rng(3)
    points = rng.normal(size=(12, 8)).astype(np.float32).astype(float)
    C, Q = points[rng.integers(0, 12, 700)], points[rng.integers(0, 12, 20)]
    C[5], C[6], rank = np.nan, np.inf, rng.permutation(700)
    allowed = rng.random((20, 700)) < 0.7
    for metric in ("l2", "cosine"):
        i, j, d = knn._rank_slice(Q, C, allowed, rank, 30, 2, metric)
        for n in range(20):
            every = np.array([x for x in np.flatnonzero(allowed[n]) if x not in (5, 6)])
            a, b = Q[[n] * len(every)], C[every]
            dist = (np.sqrt(((a - b) ** 2).sum(-1)) if metric == "l2" else
                    1.0 - (a * b).sum(-1) / (np.linalg.norm(a, axis=-1) * np.linalg.norm(b, axis=-1)))
            assert j[i == n].tolist() == every[np.lexsort((rank[every], dist))[:30]].tolist()


def test_knn_has_a_list_for_each_category_of_a_query(spark, monkeypatch):
    """The length band is spanned by copies of corpus rows: a query's lists grow with its categories and tiles only."""
    from comparo.operators import knn
    _, _, c, q = _random_fixture(spark)
    seen, merged = [], knn._Search._merged

    def counting(self, partial):
        seen.extend(r["count"] for r in partial.groupBy("input_id", "query_index").count().collect())
        return merged(self, partial)

    monkeypatch.setattr(knn._Search, "_merged", counting)
    knn_filtered(q, c, k=5).count()
    assert seen and max(seen) <= 2


def _clustered(spark, n_corpus=600, n_queries=40, clusters=12, dim=8):
    """Vectors in tight groups, in two blocks: what cells are for."""
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(clusters, dim)) * 10
    point = lambda i: [float(x) for x in (centres[i % clusters] + rng.normal(size=dim) * 0.1).round(3)]
    cats = ["Acronym", "Brandable", "Generic"]
    corpus = [(f"c{i:04d}", ".com" if i % 5 else ".io", 5, cats[i % 2], cats[2 - i % 2], point(i)) for i in range(n_corpus)]
    corpus += [(f"d{i:04d}", ".com", 5, "Acronym", None, corpus[0][5]) for i in range(60)]  # one vector, many rows
    queries = [(i, 1, ".com" if i % 4 else ".io", 5 + i % 3 - 1, cats[i % 3], cats[(i + 1) % 3], point(i))
               for i in range(n_queries)]
    c = spark.createDataFrame(corpus, "id string, tld string, length int, primary_category string, "
                                      "secondary_category string, embedding array<float>")
    q = spark.createDataFrame(queries, "input_id long, query_index int, tld string, length int, "
                                       "primary_category string, secondary_category string, embedding array<float>")
    return corpus, queries, c, q


def test_knn_cells_look_at_less_than_half_of_the_pairs(spark):
    corpus, queries, c, q = _clustered(spark)
    s = config.Settings(knn_tile_rows=20, knn_query_tile_rows=16)
    got = knn_filtered(q, c, settings=s, k=7)  # "auto" finds that cells pay
    assert sorted((r.input_id, r.query_index, r.id, r.rank) for r in got.collect()) == _brute(corpus, queries, 7, True)
    pairs = {r.step: r.pairs for r in knn_pairs(q, c, settings=s, k=7).collect()}
    assert set(pairs) == {"all", "first", "second"}
    assert pairs["first"] + pairs["second"] < 0.5 * pairs["all"]


@pytest.mark.parametrize("metric,use_tld,k", [("l2", True, 3), ("cosine", False, 400)])
def test_knn_cells_give_the_same_as_one_pass(spark, metric, use_tld, k):
    """Also where bounds rule nothing out, with zero vectors and fewer rows than k."""
    for fixture in (_clustered, _random_fixture):
        _, _, c, q = fixture(spark)
        zero = [0.0] * len(c.first().embedding)
        c = c.unionByName(spark.createDataFrame([("zero", ".com", 5, "Acronym", "Brandable", zero)], c.schema))
        q = q.unionByName(spark.createDataFrame([(998, 1, ".com", 5, "Acronym", "Brandable", zero),
                                                 (999, 1, ".zz", 40, "Acronym", "Brandable", zero)], q.schema))
        runs = []
        for prune in ("never", "always"):
            s = config.Settings(knn_tile_rows=40, knn_query_tile_rows=30, knn_prune=prune)
            found = knn_filtered(q, c, settings=s, k=k, metric=metric, use_tld=use_tld)
            runs.append(sorted((r.input_id, r.query_index, r.rank, r.id, round(r.distance, 9)) for r in found.collect()))
        assert runs[0] == runs[1]


def test_knn_without_several_tiles_is_one_pass(spark):
    _, _, c, q = _random_fixture(spark, n_corpus=60, n_queries=6)
    pairs = {r.step: r.pairs for r in knn_pairs(q, c, k=5).collect()}
    assert set(pairs) == {"all", "first"} and pairs["all"] == pairs["first"]


def test_cell_bounds_hold():
    """No row of a cell is nearer than the cell's bound."""
    from comparo.operators import knn_cells as cells
    rng = np.random.default_rng(2)
    for metric in ("l2", "cosine"):
        rows, queries = (cells.scaled(rng.normal(size=(n, 6)), metric) for n in (300, 50))
        pivots = cells.farthest_first(rows[:64], 10)
        away = cells.gaps(rows, pivots)
        own, to_pivots = away.argmin(1), cells.gaps(queries, pivots)
        for cell in range(len(pivots)):
            mine = rows[own == cell]
            if len(mine):
                held = away[own == cell, cell]
                bound = np.maximum(to_pivots[:, cell] - held.max(), held.min() - to_pivots[:, cell])
                assert (cells.gaps(queries, mine).min(1) >= bound - 1e-9).all()


def test_suffix_ten_thousand_rules_in_one_pass(spark, monkeypatch):
    """Rules of one to five labels: no join in the plan, and the same suffixes as with the joins."""
    rng = np.random.default_rng(11)
    label = lambda: "".join(rng.choice(list("abcdef"), int(rng.integers(1, 4))))
    lines = {".".join(label() for _ in range(int(rng.integers(1, 6)))) for _ in range(10_000)}
    lines = sorted(lines) + ["*." + x for x in sorted(lines)[::50]] + ["!" + x for x in sorted(lines)[::70]]
    table = suffix_table(spark, lines)
    hosts = [".".join(label() for _ in range(int(rng.integers(0, 8)))) for _ in range(400)] + [None, "", "A.B.C", ".", "a..b"]
    df = spark.createDataFrame([(h,) for h in hosts], "d string")
    found = suffix_rules.split_suffix(df, "d", table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    monkeypatch.setattr(suffix_rules, "LOOKED_UP", 0)
    joined = suffix_rules.split_suffix(df, "d", table)
    key = lambda r: (r.d is None, r.d or "", r.suffix)
    assert sorted(found.collect(), key=key) == sorted(joined.collect(), key=key)


def test_first_descriptions_are_exploded_and_deduplicated_rows(spark):
    rng = np.random.default_rng(5)
    texts = [None, "", "  ", "a", " b ", "c"]
    rows = [(i, f"{'xyzuvw'[int(rng.integers(0, 6))]}.com", "1", texts[int(rng.integers(0, 6))], texts[int(rng.integers(0, 6))],
             "A", "B", "p", "2001-01-01") for i in range(120)]
    raw = spark.createDataFrame(rows, "line_no long, domain string, price string, description_1 string, description_2 string, "
                                      "primary_category string, secondary_category string, platform string, date string").repartition(4)
    sales = C.clean_sales(raw)
    for nan in (False, True):
        key = lambda df: sorted((r.id, r.line_no, r.description, r.desc_index) for r in df.collect())
        assert key(C.first_descriptions(sales, "line_no", nan)) == key(C.dedup_ids(C.explode_descriptions(sales, nan)))


def test_recency_is_carried_not_parsed_per_candidate(spark):
    """Candidates that carry the weight of their corpus row score as those that carry its date only."""
    from comparo.operators.ranking import score_columns, with_recency
    as_of = F.lit("2001-08-01 00:00:00").cast("timestamp")
    rows = [("a", "2001-07-01"), ("b", "2000-12-01T10:00:00Z"), ("c", "1999-01-01"), ("d", None), ("e", "no date"),
            ("f", "2001-02-30"), ("g", "2030-01-01")]
    cands = spark.createDataFrame([(d, s, 0.25 * i, "Brandable", "Generic", "Generic", "Niche")
                                   for i, (d, s) in enumerate(rows)],
                                  "domain string, sale_date string, distance double, primary_category string, "
                                  "secondary_category string, in_primary string, in_secondary string")
    for settings in (config.DEFAULT, config.Settings(recency="constant")):
        plain = score_columns(cands, as_of, settings)
        carried = score_columns(with_recency(cands, as_of, settings).withColumn("sale_date", F.lit(None).cast("string")),
                                as_of, settings)
        assert carried.columns == plain.columns
        assert carried.drop("sale_date").orderBy("domain").collect() == plain.drop("sale_date").orderBy("domain").collect()


def test_rank_best_sorts_twice(spark):
    """Once for both windows of a domain, once for the order of an input."""
    df = spark.createDataFrame([(1, 1, 1, "a", 0.9), (1, 2, 1, "a", 0.9), (1, 1, 2, "b", 0.5)],
                               "input_id long, query_index int, rank int, domain string, score double")
    ranked = rank_best(df)
    assert [(r.rank, r.domain, r.query_index) for r in ranked.orderBy("rank").collect()] == [(1, "a", 1), (2, "b", 1)]
    assert ranked._jdf.queryExecution().sparkPlan().toString().count("Window [") == 3
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count(" Sort [") == 2


def test_retrieve_writes_what_is_read_twice(spark, monkeypatch):
    """Without the fallback nothing reads the first tier again; with it, the inputs searched again are found once."""
    from comparo.operators import retrieval
    _, _, corpus, queries = _random_fixture(spark)
    corpus = corpus.withColumn("domain", F.concat("id", "tld"))
    queries = queries.withColumn("has_numbers", F.lit(True))
    names, written = [], retrieval.materialize

    def noted(df, name="stage", **options):
        names.append(name)
        return written(df, name, **options)

    monkeypatch.setattr(retrieval, "materialize", noted)
    key = ["input_id", "query_index", "rank", "id"]
    first = {tuple(r) for r in retrieval.retrieve(queries, corpus, config.Settings(tld_fallback=False)).select(key).collect()}
    assert first and names == []
    both = retrieval.retrieve(queries, corpus).select(*key, "tier").collect()
    assert names == ["tier1", "need"]
    assert {tuple(r)[:4] for r in both if r.tier == 1} <= first
    n = {r[0]: sum(x[0] == r[0] for x in first) for r in first}
    assert all(n.get(r.input_id, 0) < 10 for r in both if r.tier == 2)
    assert {r.input_id for r in both if r.tier == 1} == {i for i, m in n.items() if m >= 10}


def test_knn_lists_hold_numbers_whatever_is_carried(spark, monkeypatch):
    """What is shuffled for a hit is its distance and the number of its row; carried columns of either side do not add to it, and
    are those of the hit's own query and row, also where numbers of queries or ids of rows are not unique."""
    from comparo.operators import knn
    _, _, c, q = _random_fixture(spark)
    c = c.withColumn("wide", F.concat(F.lit("w"), "id"))
    c = c.unionByName(c.withColumn("wide", F.lit("copy")))
    q = q.withColumn("own", F.concat(F.lit("a"), F.col("input_id")))
    q = q.unionByName(q.where("input_id < 4").withColumn("own", F.lit("b")))
    seen, merged = [], knn._Search._merged

    def noted(self, partial):
        seen.extend(partial.dtypes)
        return merged(self, partial)

    monkeypatch.setattr(knn._Search, "_merged", noted)
    found = knn_filtered(q, c, k=5, carry_q=["own"], carry_c=["wide"]).collect()
    assert dict(seen) == {"input_id": "bigint", "query_index": "int", "distances": "array<double>", "rows": "array<bigint>",
                          "asker": "struct<own:string>"}
    plain = knn_filtered(q, c, k=5).collect()
    key = lambda r: (r.input_id, r.query_index, r["rank"], r.id, r.distance)
    assert found and sorted(map(key, found)) == sorted(map(key, plain))
    assert all(r.wide in (f"w{r.id}", "copy") and r.own in (f"a{r.input_id}", "b") for r in found)
    assert {r.own for r in found if r.input_id < 4} > {"b"} and "b" not in {r.own for r in found if r.input_id >= 4}
    assert {r.wide == "copy" for r in found} == {True, False}


def test_first_descriptions_move_no_texts_for_few_repeats(spark):
    """Rows of domains that come once are not shuffled to learn that they won; null domains and null orders are as before."""
    rows = [(i, f"x{i}.com", "a", "b") for i in range(200)] + [(900, "x1.com", "late", None), (None, "x2.com", "no order", "c"),
                                                               (901, None, "no domain", "c"), (None, "y.com", None, "only")]
    sales = spark.createDataFrame(rows, "line_no long, domain string, description_1 string, description_2 string").repartition(4)
    found = C.first_descriptions(sales, "line_no")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    got = sorted((r.id, r.description) for r in found.collect())
    assert got == sorted([(f"x{i}.com__desc{j}", t) for i in range(200) for j, t in ((1, "a"), (2, "b"))]
                         + [("y.com__desc2", "only")])
