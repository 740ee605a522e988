"""Toxicity, fertility rules, line CRF and the pipeline."""

import itertools

import numpy as np
import pytest

import cases
from comparo.llm import fertility, line_crf, toxicity
from conftest import SF_CHECK, SF_SMALL

VOCABULARY = fertility.public_vocabulary()


def auc(scores, truth):
    scores, truth = np.array(scores), np.array(truth)
    pos, neg = scores[truth == 1], scores[truth == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


# --------------------------------------------------------------------------- op2

def toxic_rows():
    rng = np.random.default_rng(1)
    plain = ["river", "stone", "garden", "window", "paper", "train", "music", "bread", "cloud", "lamp"]
    rows, marks = [], []
    for i in range(400):
        text = list(rng.choice(plain, 12))
        toxic = int(i % 4 == 0)
        if toxic:
            text[3] = "vile"
            if i % 8 == 0:
                text[5] = "women"      # only toxic rows name the group
        rows.append((i, " ".join(text)))
        marks.append((i, 1, toxic))
    return rows, marks


def test_counterfactual_pairs_take_the_score_from_identity_terms(spark):
    rows, marks = toxic_rows()
    docs, labels = cases.documents(spark, rows), cases.labels(spark, marks)
    neutral = cases.documents(spark, [(1, "women river stone garden"), (2, "river stone garden")])
    change = {}
    for pairing in (0.0, 10.0):
        model = toxicity.learn(docs, labels, pairing=pairing)
        got = {r.doc_id: float(r.t) for r in toxicity.with_score(neutral, model, "t").collect()}
        change[pairing] = abs(np.log(got[1] / (1 - got[1])) - np.log(got[2] / (1 - got[2])))
    assert change[10.0] < 0.5 * change[0.0]


def test_toxicity_awkward_rows(spark):
    rows, marks = toxic_rows()
    marks += [(3, None, None), (4, 1, 0), (4, 1, 1), (None, 1, 1)]
    got = toxicity.toxicity(cases.documents(spark, rows + cases.TEXTS), cases.labels(spark, marks)).collect()
    assert len(got) == len(rows) + len(cases.TEXTS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == cases.held_out(r.id, 3) for r in got)
    assert len({r.score for r in got if r.id in (5,)}) >= 1


def test_toxicity_without_labels_or_rows(spark):
    docs = cases.documents(spark)
    got = toxicity.toxicity(docs, cases.labels(spark, [])).collect()
    assert {r.score for r in got} == {0.5} and len(got) == len(cases.TEXTS)
    assert toxicity.toxicity(cases.documents(spark, []), cases.labels(spark, [])).count() == 0
    kept = toxicity.reject_toxic(docs, {"buckets": [], "weights": [], "intercept": None, "share": 0.5})
    assert kept.columns == docs.columns and kept.count() == len(cases.TEXTS)


def test_samples_are_bounded_when_ids_repeat(spark):
    from comparo.llm.common import first_by_hash
    rows = [(1, 1, f"text {k % 500}") for k in range(2000)] + [(k, 0, "other") for k in range(2, 100)]
    frame = spark.createDataFrame(rows, "id long, y int, text string")
    assert [first_by_hash(frame, n).count() for n in (1, 50, 598, 1000)] == [1, 50, 598, 598]


def test_fit_finds_the_least_loss():
    rng = np.random.default_rng(2)
    rows = [sorted(set(rng.integers(0, 6, 3).tolist())) for _ in range(300)]
    y = np.array([float(0 in r) if rng.random() < 0.9 else rng.integers(0, 2) for r in rows], dtype=float)
    x = toxicity.Sparse(rows, 6)
    none = toxicity.Sparse([], 6)
    w, b = toxicity.fit(x, y, none, none, 1.0, ridge=1e-3, steps=2000)
    p = 1 / (1 + np.exp(-(x.dot(w) + b)))
    assert np.abs(x.back((p - y) / len(y)) + 1e-3 * w).max() < 1e-4


@pytest.mark.parametrize("column", ["toxic", "quality"])
def test_held_out_accuracy(spark, column):
    """Held-out documents of the small table are told apart."""
    from comparo.llm.queries import QUERIES
    name = {"toxic": "op2_toxicity", "quality": "op4_line_crf"}[column]
    truth = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    got = [(r.score, truth[r.doc_id]) for r in QUERIES[name](spark, SF_CHECK).collect()
           if r.held_out and r.doc_id in truth]
    assert auc(*zip(*got)) > {"toxic": 0.85, "quality": 0.97}[column]


# --------------------------------------------------------------------------- op3

def test_fertility_awkward_rows(spark):
    got = fertility.rules(cases.documents(spark), VOCABULARY)
    names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = [(i, *cases.base_rules(t)) for i, t in cases.TEXTS]
    assert cases.rows_of(got, *names) == sorted(want, key=repr)
    for r in got.collect():
        assert r.kept == (not r.base_failed and not r.reasons)
        assert (r.entropy is None) == (r.n_words == 0)


def test_fertility_measures(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    text = "The quick brown fox 日本 \x01 the quick"
    row = fertility.rules(cases.documents(spark, [(1, text)]), VOCABULARY).first()
    ids = [i for w in cases.words(text) for i in model.encode(w)]
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert row.n_tokens == len(ids) and row.chars_per_token == sum(map(len, cases.words(text))) / len(ids)
    assert row.byte_share == sum(map(model.is_byte, ids)) / len(ids)
    assert row.entropy == pytest.approx(-(share * np.log2(share)).sum())


def test_fertility_bands_per_script(spark):
    rng = np.random.default_rng(3)
    english = " ".join(rng.choice("the river ran over stones and under bridges while people walked slowly home through "
                                  "quiet streets after long summer evenings without any thought of rain".split(), 120))
    noise = " ".join("".join(chr(c) for c in rng.integers(0x4DC0, 0x4E00, 6)) for _ in range(120))
    rows = {r.id: r for r in fertility.rules(cases.documents(spark, [(1, english), (2, noise)]), VOCABULARY).collect()}
    assert not rows[1].base_failed and "many characters per token" not in rows[1].reasons
    assert not rows[2].kept and "byte fall-back" in rows[2].reasons
    assert fertility.script_of("Привет") == "Cyrillic" and fertility.script_of("日本語の") == "Han"
    assert fertility.script_of("123") == "other"


def test_bands_reject_labelled_bad_texts_and_no_clean_one(spark):
    from pyspark.sql import functions as F
    # measures between those of bad and of clean labelled texts
    rows = [("de", 1.95, 9.0, 1), ("en", 2.2, 6.24, 2), ("de", 2.06, 9.0, 0), ("en", 2.2, 6.6, 0)]
    frame = spark.createDataFrame(rows, "lang string, chars_per_token double, entropy double, n int").selectExpr(
        "*", "'Latin' AS script", "100L AS n_words", "0L AS n_repeat_words", "1024L AS n_tokens", "0D AS byte_share")
    base, reasons = fertility.verdict(F.col("lang"), fertility.BANDS)
    got = [r.reasons for r in frame.select(reasons.alias("reasons")).collect()]
    assert got == [["few characters per token"], ["little entropy"], [], []]
    clean = spark.read.parquet(f"{SF_CHECK}/labels.parquet").where("quality = 1").selectExpr("doc_id AS id").distinct()
    found = fertility.rules(spark.read.parquet(f"{SF_CHECK}/documents.parquet"), VOCABULARY).join(clean, "id")
    assert found.where("NOT base_failed AND NOT kept").count() == 0 < found.count()


def test_keep_good(spark):
    docs = cases.documents(spark)
    kept = fertility.keep_good(docs, VOCABULARY)
    want = [r.id for r in fertility.rules(docs, VOCABULARY).collect() if r.kept]
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert fertility.keep_good(cases.documents(spark, []), VOCABULARY).count() == 0


# --------------------------------------------------------------------------- op4

def test_marginals_agree_with_enumeration():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 1, 4, 2])
    good, move = rng.standard_normal(10), rng.standard_normal((2, 2))
    got, moves = line_crf.Chains(lengths).marginals(good, move)
    for start, n in zip(np.cumsum(lengths) - lengths, lengths):
        weight, mean, pair = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            score = sum(good[start + k] for k, y in enumerate(labels) if y)
            score += sum(move[a, b] for a, b in zip(labels, labels[1:]))
            weight += np.exp(score)
            mean += np.exp(score) * np.array(labels)
            for k in range(1, n):
                pair[k, labels[k - 1], labels[k]] += np.exp(score)
        assert np.allclose(got[start:start + n], mean / weight)
        assert np.allclose(moves[start:start + n], pair / weight)


def test_crf_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows, marks = [], []
    for i in range(200):
        bad = i % 3 == 0
        lines = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 6)) + ("%%% ###" if bad else ".")
                 for _ in range(rng.integers(1, 6))]
        rows.append((i, "\n".join(lines)))
        marks.append((i, int(not bad), 0))
    docs = cases.documents(spark, rows + [(1000 + i if i else i, t) for i, t in cases.TEXTS])
    got = line_crf.quality(docs, cases.labels(spark, marks + [(0, None, 0), (None, 1, 1)])).collect()
    assert len(got) == len(rows) + len(cases.TEXTS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all((r.score >= 0.5) == (r.id % 3 != 0) for r in got if r.id is not None and 0 <= r.id < 200)
    lines = {r.id: r.n_lines for r in got}
    assert lines[1015] == 6 and lines[1004] == 1 and lines[1003] == 1


def test_crf_without_labels_or_rows(spark):
    got = line_crf.quality(cases.documents(spark), cases.labels(spark, [])).collect()
    assert {round(r.score, 9) for r in got} == {0.5}
    assert line_crf.quality(cases.documents(spark, []), cases.labels(spark, [])).count() == 0


# --------------------------------------------------------------------------- pipeline

def by_stage(spark, docs, sf_dir):
    import corpus_pipeline
    from comparo.llm.common import materialize
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        out[name] = docs
    return out


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = by_stage(spark, docs, SF_SMALL)
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = {n: sorted(r.doc_id for r in f.select("doc_id").distinct().collect()) for n, f in found.items()}
    assert all(found[n].columns == docs.columns for n in list(found)[:-1])

    assert ids["quality_rules"] == sorted(r.id for r in fertility.rules(found["toxicity"], VOCABULARY).collect() if r.kept)
    assert all(not cases.base_rules(text[i])[-1] for i in ids["quality_rules"])

    prints = {i: cases.simhash(text[i]) for i in ids["quality_rules"]}
    near = {i: [j for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2] for i in prints}
    assert ids["simhash_dedup"] == sorted({min(cases.reach(i, near)) for i in prints})

    want = cases.removed({i: text[i] for i in ids["simhash_dedup"]})
    for r in found["suffix_dedup"].collect():
        n_bytes, n_removed, _, sha = want[r.doc_id]
        assert n_bytes - n_removed - len(r.text.encode()) in range(0, 7) and r.n_chars == len(r.text)
    assert ids["best_fit_packing"] == ids["suffix_dedup"]

    import corpus_pipeline
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "piece", "length").collect())) == \
        sorted(map(tuple, found["best_fit_packing"].select("doc_id", "piece", "length").collect()))


def test_pipeline_awkward_and_empty(spark):
    """Awkward rows go in the stage that is to reject them; four good texts stay, their copies without or with larger ids go."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good = fertility.rules(docs, VOCABULARY).where("kept").orderBy("id").limit(4).select("id").collect()
    texts = [r.text for r in docs.where(docs.doc_id.isin([r.id for r in good])).orderBy("doc_id").collect()]
    rows = cases.TEXTS + [(1_000_000 + k, t) for k, t in enumerate(texts)] + [(2_000_000, texts[0]), (None, texts[1])]
    found = by_stage(spark, cases.documents(spark, rows), SF_SMALL)
    ids = {n: sorted((r.doc_id for r in f.select("doc_id").collect()), key=repr) for n, f in found.items()}
    assert ids["toxicity"] == sorted((i for i, _ in rows), key=repr)
    assert ids["quality_rules"] == [*(1_000_000 + k for k in range(4)), 2_000_000, None]
    assert ids["simhash_dedup"] == ids["suffix_dedup"] == sorted(set(ids["best_fit_packing"])) == [1_000_000 + k for k in range(4)]
    assert all(f.count() == 0 for f in by_stage(spark, cases.documents(spark, []), SF_SMALL).values())
