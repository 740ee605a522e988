"""Embedding, suffix and SimHash near-duplicates against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import cases
from comparo.llm import embed_lsh, simhash_gray, suffix_dedup
from conftest import SF_SMALL


# --------------------------------------------------------------------------- op1

def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, id string, cls string, "
                                       "key string")


def check_vectors(spark, rows, kind="float", **options):
    got = {}
    table = vectors(spark, [(i, v, 0, "x", "y", "z") for i, v in rows], kind)
    found = embed_lsh.near_duplicates(table, **options).collect()
    usable = lambda i, v: (i is not None and v and all(x is not None and np.isfinite(x) for x in v)
                           and any(v))
    as_stored = lambda v: list(np.array(v, dtype=np.float32 if kind == "float" else np.float64))
    keyed = {k: (i, as_stored(v) if usable(i, v) else None) for k, (i, v) in enumerate(rows)}
    want = cases.links({k: v for k, v in keyed.items() if v[0] is not None}, options.get("threshold", 0.9))
    want = sorted((keyed[k][0], n, c, c == keyed[k][0]) for k, (n, c) in want.items())
    want = [(None, 0, None, False)] * sum(i is None for i, _ in rows) + want
    got = sorted((tuple(r) for r in found), key=lambda r: (r[0] is not None, r))
    assert got == want


def test_vectors_awkward_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 16))
    rows = []
    for k in range(60):
        noise = rng.standard_normal(16) * (0.05 if k % 3 else 0.2)
        rows.append((k, [float(x) for x in base[k % 6] + noise]))
    rows += [(100, None), (101, []), (102, [0.0] * 16), (103, [1.0, None] + [0.0] * 14), (104, [float("nan")] * 16),
             (105, [float("inf")] + [1.0] * 15), (None, rows[0][1]), (106, rows[0][1]), (107, rows[0][1]),
             (107, rows[0][1]), (108, [x * 3 for x in rows[0][1]]), (109, [1.0, 2.0]), (110, [2.0, 4.0]),
             (111, [-1.0, -2.0])]
    check_vectors(spark, rows)


def test_vectors_bucket_larger_than_a_tile(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(8)
    rows = [(k, [float(x) for x in centre + 0.1 * rng.standard_normal(8)]) for k in range(70)]
    check_vectors(spark, rows, "double", tile=8)


def test_vectors_huge_and_tiny(spark):
    check_vectors(spark, [(1, [1e300, 1e300]), (2, [2e-300, 2e-300]), (3, [1e300, -1e300])], "double")


def test_vectors_empty_table(spark):
    assert embed_lsh.near_duplicates(vectors(spark, [])).count() == 0


def test_recall_at_the_threshold():
    """Every planted pair of cosine 0.9 to 0.92 shares a bucket of some table, but for the planned share."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(axis=1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    cosine = rng.uniform(0.9, 0.92, (2000, 1))
    y = cosine * x + np.sqrt(1 - cosine ** 2) * away
    projections = embed_lsh.Projections(64, *embed_lsh.plan_tables(10_000, 0.9, 0.99))
    assert (projections.keys(x) == projections.keys(y)).any(axis=1).mean() >= 0.98


# --------------------------------------------------------------------------- op5

def check_removed(spark, rows, **options):
    got = suffix_dedup.remove_repeats(cases.documents(spark, rows), **options)
    got = cases.rows_of(got.selectExpr("id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS sha"),
                        "id", "n_bytes", "n_removed", "n_spans", "sha")
    repeated = len({i for i, _ in rows}) < len(rows)
    tags = {}
    if repeated:  # rows of equal ids are ordered by the hash of their text, as the operator does
        hashed = cases.documents(spark, rows).selectExpr("text", "xxhash64(coalesce(text, '')) AS h").collect()
        tags = {r.text: r.h for r in hashed}
    low = -(1 << 63)
    key = lambda i, t: (low if i is None else i, tags.get(t, 0))
    want = cases.removed({key(i, t): t for i, t in rows}, options.get("width", 100))
    assert got == sorted(((i, *want[key(i, t)]) for i, t in rows), key=repr)


def test_suffix_awkward_rows(spark):
    rows = [(i, t) for i, t in cases.TEXTS if t is None or len(t) < 10_000]
    check_removed(spark, rows + [(11, cases.LONG[:3000]), (12, cases.LONG[:2990] + "x")])


@pytest.mark.parametrize("seed", range(3))
def test_suffix_random_texts(spark, seed):
    """Texts spliced from shared parts, with windows short enough that every digit has work."""
    rng = np.random.default_rng(seed)
    parts = ["".join(rng.choice(list("abc "), rng.integers(5, 60))) for _ in range(12)]
    rows = [(int(i), "".join(parts[k] for k in rng.integers(0, 12, rng.integers(0, 12)))) for i in rng.permutation(80)]
    check_removed(spark, rows, width=20, gram=8)


def test_suffix_long_text_is_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    text = "".join(rng.choice(list("abcdefgh "), 3000))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)
    constants = suffix_dedup._constants()
    found = [np.concatenate(x) for x in zip(*suffix_dedup.runs(text.encode(), 100, 32, constants))]
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(found[1], found[2])])
    assert (windows == np.arange(len(text) - 99)).all()
    assert ((found[3] >= found[2]) & (found[3] + 32 <= found[1] + 100)).all()


def test_suffix_empty_table_and_cut(spark):
    assert suffix_dedup.remove_repeats(cases.documents(spark, [])).count() == 0
    docs = cases.documents(spark, [(1, cases.PASSAGE), (2, "é" + cases.PASSAGE + "é"), (3, None)])
    cut = suffix_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: cases.PASSAGE, 2: "éé", 3: None}


# --------------------------------------------------------------------------- op8

def check_simhash(spark, rows, **options):
    got = simhash_gray.near_duplicates(cases.documents(spark, rows), **options)
    got = sorted(((r.id, r.fp % 2**64, r.component_id) for r in got.collect()), key=repr)
    prints = [cases.simhash(t) for _, t in rows]
    near = {k: [j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2] for k, p in enumerate(prints)}
    ids = lambda k: min((rows[j][0] for j in cases.reach(k, near) if rows[j][0] is not None), default=None)
    assert got == sorted(((rows[k][0], prints[k], ids(k)) for k in range(len(rows))), key=repr)


def test_simhash_awkward_rows(spark):
    check_simhash(spark, [(i, t) for i, t in cases.TEXTS if t is None or len(t) < 10_000])


def test_simhash_long_text():
    assert simhash_gray.fingerprint(cases.LONG) == cases.simhash(cases.LONG)


def test_simhash_empty_table(spark):
    assert simhash_gray.near_duplicates(cases.documents(spark, [])).count() == 0


def test_keep_one(spark):
    docs = cases.documents(spark)
    kept = simhash_gray.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [[cases.TEXTS[k][0] for k in g] for g in cases.simhash_groups(cases.TEXTS)]
    want = [min((i for i in g if i is not None), default=None) for g in ids]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.integers(0, 2**32))
def test_gray_index_finds_all_pairs(centres, seed):
    rng = np.random.default_rng(seed)
    near = [c ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))}) for c in centres for _ in range(20)]
    fps = np.unique(np.array(near, dtype=np.uint64))
    fps = fps[np.argsort(simhash_gray.gray_rank(fps))]
    i, j = simhash_gray.linked_pairs(fps, 2)
    want = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps))
            if int(fps[a] ^ fps[b]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_links_of_nodes_that_are_split(spark):
    """Nodes above the leaf size are replaced by their children without losing a link."""
    rng = np.random.default_rng(1)
    prints = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in rng.integers(0, 2**63, 6)
              for a, b in rng.integers(0, 64, (60, 2))}
    signed = [(p - 2**64 if p >> 63 else p,) for p in sorted(prints)]
    frame = spark.createDataFrame(signed, "fp long")
    from comparo.llm.common import components
    got = {r.node % 2**64: r.root % 2**64
           for r in components(simhash_gray.hamming_links(frame, 2, leaf=8), "a", "b").collect()}
    order = lambda p: p - 2**64 if p >> 63 else p
    near = {p: [q for q in prints if q != p and (p ^ q).bit_count() <= 2] for p in prints}
    want = {p: min(cases.reach(p, near), key=order) for p in prints if near[p]}
    assert got == want


def test_small_table_queries_agree(spark):
    """op5 and op8 over the whole small table."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check_removed(spark, rows)
    check_simhash(spark, rows)


def test_links_agree_with_sql(spark):
    from comparo.llm.queries import ORACLE, QUERIES
    from oracle_check import compare, duck
    for name, sql in ORACLE.items():
        found = compare(spark, duck(SF_SMALL), name, QUERIES[name], sql, SF_SMALL)
        assert found["hash_match"] and found["spark_rows"] == found["oracle_rows"], found


# --------------------------------------------------------------------------- names and hubs

def test_columns_that_clash_with_internal_names(spark):
    """Stages that return the documents' own columns leave them alone, whatever they are called."""
    from comparo.llm import fertility, toxicity
    rows = [(1, "The cat sat on the mat. " * 9), (2, "The cat sat on the mat. " * 9), (3, cases.PASSAGE), (4, None)]
    names = ["__toxicity", "__fertility_script", "__fertility_n_words", "__simhash_row", "__repeat_id", "__repeat_spans",
             "__Key_id", "_", "n", "u", "v", "s"]
    docs = cases.documents(spark, rows)
    docs = docs.selectExpr("*", *(f"concat('own ', '{k}') AS `{n}`" for k, n in enumerate(names)))
    model = {"buckets": [], "weights": [], "intercept": 0.0, "share": None}
    outs = [toxicity.reject_toxic(docs, model), fertility.keep_good(docs, fertility.public_vocabulary()),
            simhash_gray.keep_one(docs), suffix_dedup.cut_repeats(docs)]
    for out in outs:
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[n] for n in names] == [f"own {k}" for k in range(len(names))]
    assert sorted(r.doc_id for r in outs[2].collect()) == [1, 3, 4]


def test_components_of_hubs_chains_and_cycles(spark):
    """A hub of 100,000 edges, a long chain, a ring and repeated links, against their known smallest nodes."""
    from pyspark.sql import functions as F
    from comparo.llm.common import components
    hub = spark.range(100_000).select(F.lit(50).alias("a"), (F.col("id") + 1000).alias("b"))
    chain = spark.range(200_000, 200_040).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    ring = spark.range(300_000, 300_010).select("id", F.when(F.col("id") == 300_009, 300_000).otherwise(F.col("id") + 1)).toDF("a", "b")
    more = spark.createDataFrame([(7, 7), (5, 50), (5, 50), (400_001, 400_000)], "a long, b long")
    got = components(hub.unionByName(chain).unionByName(ring).unionByName(more), "a", "b")
    roots = {r.root: (r.n, r.low) for r in got.groupBy("root").agg(F.countDistinct("node").alias("n"), F.min("node").alias("low")).collect()}
    assert roots == {5: (100_002, 5), 200_000: (41, 200_000), 300_000: (10, 300_000), 400_000: (2, 400_000)}
    assert got.count() == 100_002 + 41 + 10 + 2


def test_hub_edges_are_dealt_to_many_places(spark):
    from pyspark.sql import functions as F
    from comparo.llm import common
    hub = spark.range(10_000).select(F.lit(5).cast("long").alias("u"), (F.col("id") + 10).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = common._meet_lowest(hub).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 5000
