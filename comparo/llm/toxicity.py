"""Toxicity by a counterfactually regularised linear classifier.

Features are a text's words (runs of letters, lower case) and their first three to six letters, hashed into ``BUCKETS``.

1. Over all labelled training rows, every feature's documents are counted per label; the ``features`` buckets with the
   largest log-likelihood ratio are kept (a parameter; the counts themselves cover all rows).
2. A logistic model over these is fitted on at most ``sample`` labelled rows, the first in the order of a hash of their
   ids (a documented bound; the driver holds their bucket numbers only). For each sampled text that names a group of
   people, a counterfactual is made by putting in the place of each identity term another one of its kind;
   the squared change of the logit between the two is added to the loss with weight ``pairing``, so that neutral mentions
   of a group cannot carry a score.
3. Every text is scored by the few weights, inside the scan. There is no shuffle in scoring.

Defined results: a null or empty text has no features and scores the model's intercept. Labelled rows whose label is
null are not used; of several labels of one id the largest counts; a null id has no label. Without
rows of both labels every score is the share of the label that there is (0.5 without rows). Rows with
equal ids are scored one by one. Other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import (Recent, append_columns, first_by_hash, free, labelled, map_rows, materialize,
                                remainder)

BUCKETS = 1 << 20
CACHE = 1 << 18
FEATURES = 4096
SAMPLE = 20_000
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")

# Identity terms by kind; a term is swapped for the next of its kind.
IDENTITY = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "arab"],
    ["gay", "lesbian", "straight", "bisexual"], ["transgender", "cisgender"],
    ["immigrants", "refugees", "natives"], ["disabled", "deaf", "blind"],
    ["african", "american", "chinese", "german", "french", "mexican", "indian"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["femmes", "hommes"],
    ["musulmans", "chrétiens", "juifs"], ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]


def swaps(kinds: list[list[str]] = IDENTITY) -> dict[str, str]:
    """Each identity term with the next of its kind."""
    return {a: b for kind in kinds for a, b in zip(kind, [*kind[1:], kind[0]])}


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word: itself and its first three to six letters."""
    from xxhash import xxh3_64_intdigest as digest
    parts = [f"{word}$", *(word[:k] for k in range(3, min(len(word), 6) + 1))]
    return tuple({digest(p) % BUCKETS for p in parts})


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def feature_counts(rows: DataFrame) -> DataFrame:
    """(bucket, pos, neg): documents with a feature per label, over all rows (id, y, text)."""
    def make():
        table = Recent(word_buckets, CACHE)

        def run(cols):
            seen = np.zeros((2, BUCKETS), dtype=np.int64)
            for y, text in zip(cols["y"], cols["text"]):
                found = set().union(*map(table.__getitem__, text_words(text)))
                seen[int(y > 0), np.fromiter(found, dtype=np.int64, count=len(found))] += 1
            bucket = np.flatnonzero(seen.sum(axis=0))
            return {"bucket": bucket, "pos": seen[1, bucket], "neg": seen[0, bucket]}
        return run

    counts = map_rows(rows.select("y", "text"), "bucket long, pos long, neg long", make)
    return counts.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def select_features(counts: DataFrame, n_pos: int, n_neg: int, keep: int) -> list[int]:
    """The ``keep`` buckets of largest log-likelihood ratio against independence of the label."""
    total = float(n_pos + n_neg)

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    df = F.col("pos") + F.col("neg")
    gain = (term(F.col("pos"), df * n_pos / total) + term(F.col("neg"), df * n_neg / total)
            + term(n_pos - F.col("pos"), (total - df) * n_pos / total)
            + term(n_neg - F.col("neg"), (total - df) * n_neg / total))
    best = (counts.where(df >= 3).withColumn("gain", gain).where("gain > 5").orderBy(F.desc("gain"), "bucket")
            .limit(keep).select("bucket"))
    return [r.bucket for r in best.collect()]


def featurizer(selected: list[int], swap: dict[str, str] | None = None) -> Callable[[str | None], list[int]]:
    """A function from a text to the sorted numbers of its selected features; with ``swap`` its words are swapped
    first, and None is returned if none is."""
    number = {b: i for i, b in enumerate(selected)}
    table = Recent(lambda w: tuple(number[b] for b in word_buckets(w) if b in number), CACHE)

    def features(text):
        words = text_words(text)
        if swap is not None:
            if words.isdisjoint(swap):
                return None
            words = {swap.get(w, w) for w in words}
        return sorted(set().union(*map(table.__getitem__, words)))

    return features


class Sparse:
    """Rows of binary features."""

    def __init__(self, rows: list[list[int]], width: int):
        self.width, self.n = width, len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.col = np.fromiter((c for r in rows for c in r), dtype=np.int64, count=len(self.row))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.width)


def curvature(apply: Callable[[np.ndarray], np.ndarray], width: int) -> float:
    """Largest eigenvalue of a symmetric map, from above for use as a step bound (power iteration)."""
    v, size = np.ones(width), 0.0
    for _ in range(20):
        v = apply(v / max(np.linalg.norm(v), 1e-30))
        size = float(np.linalg.norm(v))
    return 1.1 * size


def fit(x: Sparse, y: np.ndarray, original: Sparse, swapped: Sparse, pairing: float, ridge: float = 2e-6,
        steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of least mean log loss + ridge * |w|^2 / 2 + pairing / 2 * mean squared change of the logit
    from ``original`` to ``swapped``, by accelerated gradient steps."""
    def paired(v):
        change = (original.dot(v) - swapped.dot(v)) * (pairing / max(original.n, 1))
        return original.back(change) - swapped.back(change)

    w, b = np.zeros(x.width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rate = 1 / (0.25 + ridge + curvature(lambda v: x.back(x.dot(v)) * (0.25 / len(y)) + paired(v), x.width))
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(ahead_w) + ahead_b, -40, 40)))
        g = (p - y) / len(y)
        gw, gb = x.back(g) + ridge * ahead_w + paired(ahead_w), g.sum()
        after_w, after_b, after_t = ahead_w - rate * gw, ahead_b - rate * gb, (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead_w = after_w + (t - 1) / after_t * (after_w - w)
        ahead_b = after_b + (t - 1) / after_t * (after_b - b)
        w, b, t = after_w, after_b, after_t
    return w, b


def train(rows: DataFrame, features: int = FEATURES, sample: int = SAMPLE, pairing: float = 1.0,
          kinds: list[list[str]] = IDENTITY) -> dict:
    """Model of the labelled rows (id, y, text): selected buckets, weights and intercept."""
    rows = materialize(rows, "labelled")
    size = {r.y > 0: r.n for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = size.get(True, 0), size.get(False, 0)
    if not n_pos or not n_neg:
        share = 0.5 if not n_pos + n_neg else float(n_pos > 0)
        return {"buckets": [], "weights": [], "intercept": None, "share": share}
    selected = select_features(feature_counts(rows), n_pos, n_neg, features)

    def make():
        plain, swapped = featurizer(selected), featurizer(selected, swaps(kinds))

        def run(cols):
            return {"id": cols["id"], "y": cols["y"], "plain": [plain(t) for t in cols["text"]],
                    "swapped": [swapped(t) for t in cols["text"]]}
        return run

    got = map_rows(first_by_hash(rows, sample), "id long, y int, plain array<int>, swapped array<int>", make).orderBy("id").collect()
    y = np.array([float(r.y > 0) for r in got])
    pairs = [r for r in got if r.swapped is not None]
    weights, intercept = fit(Sparse([r.plain for r in got], len(selected)), y,
                             Sparse([r.plain for r in pairs], len(selected)),
                             Sparse([r.swapped for r in pairs], len(selected)), pairing)
    return {"buckets": selected, "weights": weights.tolist(), "intercept": float(intercept), "share": None}


def with_score(docs: DataFrame, model: dict, column: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of each row's text."""
    if model["intercept"] is None:
        return docs.withColumn(column, F.lit(float(model["share"])))

    def make():
        weight = dict(zip(model["buckets"], model["weights"]))
        table = Recent(lambda w: tuple(b for b in word_buckets(w) if b in weight), CACHE)

        def run(cols):
            out = []
            for text in cols["text"]:
                found = set().union(*map(table.__getitem__, text_words(text)))
                logit = model["intercept"] + sum(weight[b] for b in sorted(found))
                out.append(float(1 / (1 + np.exp(-np.clip(logit, -40, 40)))))
            return {column: out}
        return run

    return append_columns(docs, {"text": text_col}, f"`{column}` double", make)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
          **options) -> dict:
    """Model of the labelled rows that are not held out."""
    training = remainder(id_col, 3) != 1
    return train(labelled(docs, labels, label, training, id_col, text_col), **options)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text", label: str = "toxic", **options) -> DataFrame:
    """(id, held_out, score, predicted); learns from the labelled rows that are not held out."""
    model = learn(docs, labels, id_col, text_col, label, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = with_score(rows, model)
    return scored.select("id", (remainder("id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns."""
    score = free(docs, "__toxicity")
    return with_score(docs, model, score, text_col).where(F.col(score) < threshold).drop(score)
