"""Whitening of vectors by shifted CholeskyQR.

Entries become integers floor(scale * c) + offset, so counts, sums and deviations are exact. With A the centred rows:

1. One pass counts the rows and sums the integers.
2. Gram passes: every task multiplies its centred rows, after triangular solves with the factors so far, into one small
   matrix; matrices are added cell by cell behind a partial sum, so the driver gets dimension^2 numbers at any number of
   rows. The Cholesky factor R of the Gram matrix plus a shift, which makes it exist for any rank, becomes the next
   factor. Rows are never written: a pass solves them anew from the table, so a lost executor costs its tasks only.
3. When the rows are orthonormal, but for directions without variance, the product of the factors, times the root of the last
   Gram matrix, has the singular values and right singular vectors of A: the eigenvalues (over n) and components.
4. A pass over the whitened rows measures their covariance; a last one returns them.

Defined results: a row whose vector is null or holds a null or a non-finite entry goes; a null id is kept. Vectors of
different dimension are lists of their own, each with its n. An empty vector has no components. A direction
without variance (below ``RANK`` of the largest standard deviation) has no component, so equal or single vectors
return no rows. Components of equal variance are any basis of their space. Repeated rows each count. An integer beyond 2^61
counts as 2^61; a deviation beyond a long is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSES = 8
RANK = 1e-12
CLOSE = 1e-10   # rows are orthonormal when the eigenvalues of their Gram matrix are so close to 1
LARGEST = 1 << 61
BATCH = 4096    # rows of a worker's matrices


def rows_of(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, dim) of the rows that remain."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (table.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(finite, F.lit(False)).alias("ok"))
            .where("ok").select("id", "vec", F.size("vec").alias("dim")).where("dim > 0"))


def _matrices(batches: Iterator[pa.RecordBatch], scale: float, offset: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(dimension, ids, integers) of the rows of each dimension in a batch."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            rows = batch.filter(pa.array(dims == dim))
            for at in range(0, rows.num_rows, BATCH):
                part = rows.slice(at, BATCH)
                x = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(x * scale), -float(LARGEST), float(LARGEST)).astype(np.int64)
                yield dim, part.column("id"), np.clip(x, offset - LARGEST, LARGEST - offset) + offset


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q with Q @ factor = rows for an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


class Fit:
    """Exact mean of the integer vectors of one dimension, and what the passes found."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)
        self.factors: list[np.ndarray] = []
        self.trace, self.explained, self.project, self.error = 0.0, np.zeros(0), None, 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean, unrounded up to the last bit."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        rows = self.centred(x)
        for factor in self.factors:
            rows = solve(rows, factor)
        return rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.project

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None beyond a long."""
        away = x - self.whole
        most = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            away = self.n * away - self.rest
            return (away * away).sum(axis=1).tolist()
        away = self.n * away.astype(object) - self.rest.astype(object)
        return [d if d < 1 << 63 else None for d in (away * away).sum(axis=1).tolist()]

    def step(self, gram: np.ndarray) -> bool:
        """Take the Gram matrix of the rows as they stand; True when they are orthonormal, else a factor is added."""
        values = np.linalg.eigvalsh(gram)
        if not self.factors:
            self.trace = float(np.trace(gram)) / self.n
        elif ((np.abs(values - 1) < CLOSE) | (values < 1e-20)).all():
            return True
        if values[-1] <= 0:
            return True
        size = len(gram)
        unit = np.finfo(np.float64).eps / 2
        shift = 11 * (self.n * size + size * (size + 1)) * unit * values[-1]
        self.factors.append(np.linalg.cholesky(gram + min(shift, values[-1] / 16) * np.eye(size)).T)
        return False

    def finish(self, gram: np.ndarray, components: int) -> None:
        """Components from the factors; ``gram`` is that of the rows after all of them."""
        size = len(gram)
        if not self.factors:
            self.project = np.zeros((size, 0))
            return
        values, vectors = np.linalg.eigh(gram)
        r = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
        for factor in reversed(self.factors):
            r = r @ factor
        _, sigma, axes = np.linalg.svd(r)
        kept = min(components, int((sigma > RANK * sigma[0]).sum()))
        variance = sigma[:kept] ** 2 / self.n
        self.explained = variance / self.trace
        self.project = axes[:kept].T / np.sqrt(variance)


def _summed(rows: tuple, make: Callable[[], tuple], columns: list[str], kind: str) -> list:
    """Cells (dim, cell, columns) of every task, added; ``rows`` is (table, scale, offset). ``make()`` gives a function to take a (dim, integers) and one that
    returns the task's arrays by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, given = make()
        for dim, _, x in take_from(batches):
            take(dim, x)
        for dim, arrays in given().items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(arrays[0]), dim, dtype=np.int32)), pa.array(np.arange(len(arrays[0]), dtype=np.int64)),
                 *map(pa.array, arrays)], names=["dim", "cell", *columns])

    frame, scale, offset = rows
    take_from = lambda batches: _matrices(batches, scale, offset)
    cells = frame.mapInArrow(run, "dim int, cell long, " + ", ".join(f"{c} {kind}" for c in columns))
    return cells.groupBy("dim", "cell").agg(*(F.sum(c).alias(c) for c in columns)).collect()


def _grams(rows: tuple, fits: dict[int, Fit], turn: Callable[[Fit, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Sum of the outer products of ``turn(fit, integers)`` with a column of ones in front, by dimension."""
    def make():
        sums = {}

        def take(dim, x):
            q = turn(fits[dim], x)
            q = np.column_stack([np.ones(len(q)), q])
            sums[dim] = sums.get(dim, 0.0) + q.T @ q
        return take, lambda: {dim: [m[np.triu_indices(len(m))]] for dim, m in sums.items()}

    values: dict[int, list] = {}
    for r in _summed(rows, make, ["value"], "double"):
        values.setdefault(r.dim, []).append((r.cell, r.value))
    out = {}
    for dim, found in values.items():
        size = int((np.sqrt(8 * len(found) + 1) - 1) / 2)
        m = np.zeros((size, size))
        m[np.triu_indices(size)] = [v for _, v in sorted(found)]
        out[dim] = m + np.triu(m, 1).T
    return out


def fit(rows: tuple, components: int) -> dict[int, Fit]:
    """A :class:`Fit` for each dimension."""
    def make():
        n, sums = {}, {}

        def take(dim, x):
            n[dim] = n.get(dim, 0) + len(x)
            high, low = sums.get(dim, (0, 0))
            sums[dim] = high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0)
        return take, lambda: {d: [np.full(d, n[d]), *sums[d]] for d in n}

    cells: dict[int, list] = {}
    for r in _summed(rows, make, ["n", "high", "low"], "long"):
        cells.setdefault(r.dim, []).append((r.cell, r.n, (r.high << 31) + r.low))
    fits = {dim: Fit(found[0][1], [s for *_, s in sorted(found)]) for dim, found in cells.items()}
    for turn in range(PASSES + 1):
        if not fits:
            break
        grams = {dim: m[1:, 1:] for dim, m in _grams(rows, fits, Fit.orthogonal).items()}
        if turn == PASSES or all([fits[dim].step(gram) for dim, gram in grams.items()]):
            break
    for dim, found in fits.items():
        found.finish(grams[dim], components)
    for dim, m in _grams(rows, fits, Fit.whitened).items() if fits else ():
        n, mean = fits[dim].n, m[0, 1:] / fits[dim].n
        away = m[1:, 1:] / n - np.outer(mean, mean) - np.eye(len(mean))
        fits[dim].error = float(np.abs(away).max(initial=0))
    return fits


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32,
           scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per remaining row and component."""
    rows = rows_of(table, id_col, vec_col)
    fits = fit((rows, scale, offset), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, x in _matrices(batches, scale, offset):
            found = fits[dim]
            white = found.whitened(x)
            count, width = white.shape
            if not width:
                continue
            each = np.repeat(np.arange(count), width)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                 pa.array(np.full(count * width, found.n)), pa.array(found.deviation(x), pa.int64()).take(pa.array(each)),
                 pa.array(white.ravel()), pa.array(np.tile(found.explained, count)),
                 pa.array(np.full(count * width, found.error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, "id long, component int, n long, deviation long, whitened double, explained double, "
                                "identity_error double")
