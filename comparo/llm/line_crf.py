"""Quality by a linear-chain conditional random field over the lines of a text.

Every line is good or bad. A line's features are measures of its own form (words, symbols, capitals, digits, repeats)
and some of the same measures of the lines before and after it; a transition weight ties neighbouring labels. A text's
score is the mean probability of "good" of its lines, from the forward-backward marginals, weighted by the
lines' length in characters plus one.

Labels exist for texts only, so in training each line carries its text's label. The weights are fitted on at most
``sample`` labelled texts with at most ``lines`` lines together, the first in the order of a hash of ids and texts (documented
parameters; the driver holds their line features only, some 400 bytes a line while it fits). A text that has more lines
alone is not fitted on. Scoring covers all lines of all texts, inside the scan.

Defined results: a null text is empty; an empty text is one empty line. Labelled rows whose label is null are not used;
of several labels of one id the largest counts; a null id has no label. Without rows of both labels the
score is the share of the label that there is (0.5 without rows). Rows with equal ids are scored one by one.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import first_by_hash, labelled, map_rows, materialize, remainder

SAMPLE = 10_000
LINES = 400_000
SYMBOLS = "#*$%&|<>"
OWN = 15          # measures of a line
SHARED = slice(2, 9)  # those that the neighbours also see


def line_measures(line: str, seen: set[str]) -> tuple[float, ...]:
    """Measures of one line; ``seen`` has the lines before it."""
    words = line.split()
    n, chars = len(words), max(len(line), 1)
    if not n:
        return (1.0, 0.0, *[0.0] * (OWN - 3), 1.0)
    letters = sum(map(str.isalpha, line)) or 1
    symbols = sum(map(line.count, SYMBOLS))
    noisy = sum(w[-1] in SYMBOLS for w in words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    last = words[-1][-1]
    return (1.0, math.log1p(n) / 5, symbols / chars, noisy / n, words.count("|") / n, line.count("!") / n,
            sum(map(str.isupper, line)) / letters, again / n, float(line in seen), len(line) / n / 10,
            len(set(words)) / n, sum(map(str.isdigit, line)) / chars, float(last in ".?!"),
            float(words[0][0].isupper()), 0.0)


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of the lines of a text."""
    lines, seen, own = (text or "").split("\n"), set(), []
    for line in lines:
        own.append(line_measures(line, seen))
        seen.add(line)
    own = np.array(own, dtype=np.float32)
    shared = own[:, SHARED]
    edge = np.zeros((1, shared.shape[1]), dtype=np.float32)
    first = np.zeros((len(lines), 2), dtype=np.float32)
    first[0, 0] = first[-1, 1] = 1
    features = np.hstack([own, first, np.vstack([edge, shared[:-1]]), np.vstack([shared[1:], edge])])
    return features, np.array([len(x) + 1 for x in lines], dtype=np.float64)


class Chains:
    """Chains of lines, laid out so that step t of all chains that have one is done at once."""

    def __init__(self, lengths: np.ndarray):
        self.starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        ordered = lengths[order]
        self.steps = [self.starts[order[:np.searchsorted(-ordered, -t, side="left")]] + t
                      for t in range(int(lengths.max(initial=0)))]

    def marginals(self, good: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of good per line, expected moves per line from the line before it as (lines, 2, 2)); ``good`` is
        the score of the good label, ``move`` the 2x2 scores of moves between labels (bad 0, good 1)."""
        emit = np.stack([np.zeros_like(good), good], axis=1)
        forward, backward = emit.copy(), np.zeros_like(emit)
        for before, now in zip(self.steps, self.steps[1:]):
            arrive = forward[before[:len(now)], :, None] + move
            forward[now] += np.logaddexp(arrive[:, 0], arrive[:, 1])
        for now, after in zip(self.steps[-2::-1], self.steps[:0:-1]):
            leave = move + (emit[after] + backward[after])[:, None, :]
            backward[now[:len(after)]] = np.logaddexp(leave[:, :, 0], leave[:, :, 1])
        total = forward + backward
        norm = np.logaddexp(total[:, 0], total[:, 1])
        moves = np.zeros((len(good), 2, 2))
        later = np.ones(len(good), dtype=bool)
        later[self.starts] = False
        at = np.flatnonzero(later)
        moves[at] = np.exp(forward[at - 1][:, :, None] + move + (emit[at] + backward[at])[:, None, :]
                           - norm[at][:, None, None])
        return np.exp(total[:, 1] - norm), moves


def fit(x: np.ndarray, lengths: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 250,
        rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(line weights, moves) of largest mean log-likelihood per text and line, less a ridge, by Adam."""
    chains = Chains(lengths)
    share = np.repeat(1 / (lengths * len(lengths)), lengths)
    label = np.repeat(y, lengths)
    later = np.ones(len(label), dtype=bool)
    later[chains.starts] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[later], label[later]), share[later])
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        good, moves = chains.marginals(x @ theta[:-4], theta[-4:].reshape(2, 2))
        slope = np.concatenate([x.T @ ((label - good) * share), (seen - np.tensordot(share, moves, 1)).ravel()])
        slope -= ridge * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        theta = theta + rate * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.999 ** k)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def train(rows: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> dict:
    """Model of the labelled rows (id, y, text)."""
    rows = materialize(rows, "labelled")
    size = {r.y: r.n for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return {"weights": None, "share": float(next(iter(size), 0.5))}

    def make():
        def run(cols):
            found = [text_features(t)[0] for t in cols["text"]]
            return {"id": cols["id"], "y": cols["y"], "n": list(map(len, found)), "x": [f.tobytes() for f in found]}
        return run

    n_lines, order = F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)) + 1, F.xxhash64("id", "text")
    chosen = first_by_hash(rows.where(n_lines <= lines), sample)
    used, last = 0, None
    for r in chosen.select(order.alias("h"), n_lines.alias("n")).orderBy("h").collect():  # two numbers a text
        used += r.n
        if used > lines:
            break
        last = r.h
    chosen = chosen.where(order <= F.lit(last).cast("long"))
    got = map_rows(chosen, "id long, y int, n int, x binary", make).orderBy("id").collect()
    x = np.frombuffer(b"".join(r.x for r in got), dtype=np.float32).reshape(sum(r.n for r in got), -1)
    weights, move = fit(x.astype(np.float64), np.array([r.n for r in got]), np.array([int(r.y > 0) for r in got]))
    return {"weights": weights, "move": move, "share": None}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_lines, n_bad_lines) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def make():
        def some(texts):
            found = [text_features(t) for t in texts]
            lengths = np.array([len(w) for _, w in found])
            chains = Chains(lengths)
            if model["weights"] is None:
                good = np.full(lengths.sum(), model["share"])
            else:
                x = np.concatenate([f for f, _ in found]).astype(np.float64)
                good, _ = chains.marginals(x @ model["weights"], model["move"])
            weight = np.concatenate([w for _, w in found])
            mean = np.add.reduceat(good * weight, chains.starts) / np.add.reduceat(weight, chains.starts)
            bad = np.add.reduceat((good < 0.5).astype(np.int64), chains.starts)
            return np.clip(mean, 0, 1), lengths, bad

        def run(cols):
            parts = [some(cols["text"][at:at + 1000]) for at in range(0, len(cols["text"]), 1000)]
            mean, lengths, bad = (np.concatenate(p) for p in zip(*parts)) if parts else ([], [], [])
            return {"id": cols["id"], "score": mean, "n_lines": lengths, "n_bad_lines": bad}
        return run

    return map_rows(rows, "id long, score double, n_lines long, n_bad_lines long", make)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
            text_col: str = "text", label: str = "quality", sample: int = SAMPLE,
            lines: int = LINES) -> DataFrame:
    """(id, held_out, score, predicted, n_lines, n_bad_lines); learns from the labelled rows that are not held out."""
    held_out = remainder(id_col, 3) == 1
    model = train(labelled(docs, labels, label, ~held_out, id_col, text_col), sample, lines)
    scored = score(docs, model, id_col, text_col)
    return scored.select("id", (remainder("id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "n_lines", "n_bad_lines")
