"""Whitening against plain linear algebra over all rows."""

import numpy as np
import pytest

from comparo.llm import queries, whitening
from conftest import SF_SMALL


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "clash", 1, 2, 3.0) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, dim string, n int, cell int, value double").repartition(3)


def brute(rows, kind="float", components=32):
    """[(id, n, deviation)], integers centred, eigenvalues and eigenvectors by falling value."""
    cast = np.float32 if kind == "float" else np.float64
    kept = [(i, np.array(v, dtype=cast).astype(float)) for i, v in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in kept], n, deviations, centred, values[::-1], vectors[:, ::-1]


def check(spark, rows, kind="float", rank=None, tolerance=1e-6):
    got = whitening.whiten(table(spark, rows, kind)).collect()
    ids, n, deviations, centred, values, vectors = brute(rows, kind)
    width = min(32, len(values) if rank is None else rank)
    assert len(got) == len(ids) * width
    assert {r.n for r in got} == {n}
    assert sorted((r.id, r.deviation) for r in got if r.component == 1) == sorted(zip(ids, deviations))
    by_id = {}
    for r in got:
        by_id.setdefault(r.id, {})[r.component] = r
    assert all(sorted(cells) == list(range(1, width + 1)) for cells in by_id.values())
    explained = [by_id[ids[0]][k + 1].explained for k in range(width)]
    assert np.allclose(explained, values[:width] / values.sum(), rtol=1e-4)
    white = np.array([[by_id[i][k + 1].whitened for k in range(width)] for i in ids])
    want = centred @ vectors[:, :width] / np.sqrt(values[:width])
    sign = np.sign((white * want).sum(axis=0))
    assert np.abs(white * sign - want).max() < tolerance
    assert got[0].identity_error < 1e-4
    assert np.abs(white.T @ white / n - np.eye(width)).max() < 1e-4
    return got


def random_rows(rng, count, dim, scale=None):
    x = rng.standard_normal((count, dim)) * (np.linspace(3, 0.5, dim) if scale is None else scale)
    return [(k, [float(c) for c in v]) for k, v in enumerate(x)]


def test_random_vectors(spark):
    check(spark, random_rows(np.random.default_rng(1), 300, 12))


def test_more_dimensions_than_components(spark):
    got = check(spark, random_rows(np.random.default_rng(2), 200, 40), "double")
    assert {r.component for r in got} == set(range(1, 33))


def test_rows_that_go(spark):
    rows = random_rows(np.random.default_rng(3), 60, 5)
    rows += [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, [])]
    got = check(spark, rows)
    assert not {r.id for r in got} & {100, 101, 102, 103, 104}


def test_dependent_and_constant_columns(spark):
    """Directions without variance have no component, and the others are not disturbed."""
    rows = []
    for i, v in random_rows(np.random.default_rng(4), 120, 6):
        whole = [float(np.floor(64 * c)) / 64 for c in v]
        rows.append((i, [*whole, whole[0] + whole[1], 7.0]))
    check(spark, rows, "double", rank=6)


def test_fewer_rows_than_dimensions(spark):
    check(spark, random_rows(np.random.default_rng(5), 6, 20), rank=5)


def test_scales_far_apart(spark):
    """Eigenvalues over ten powers of ten need the repeated passes."""
    check(spark, random_rows(np.random.default_rng(6), 400, 6, np.array([1e4, 1e3, 1e2, 10, 1, 0.1])), "double", tolerance=1e-4)


def test_one_vector_holds_a_third(spark):
    rows = random_rows(np.random.default_rng(7), 90, 4)
    check(spark, rows + [(1000 + k, rows[0][1]) for k in range(45)])


def test_no_variance_no_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(table(spark, [(k, [1.0, 2.0]) for k in range(5)])).count() == 0


def test_null_and_repeated_ids(spark):
    rows = random_rows(np.random.default_rng(8), 30, 3)
    got = whitening.whiten(table(spark, rows + [(None, rows[0][1]), (5, rows[1][1]), (5, rows[1][1])])).collect()
    assert len(got) == 33 * 3 and sum(r.id is None for r in got) == 3 and {r.n for r in got} == {33}


def test_dimensions_are_lists_of_their_own(spark):
    rng = np.random.default_rng(9)
    short, long = random_rows(rng, 40, 3), [(100 + i, v) for i, v in random_rows(rng, 50, 5)]
    got = whitening.whiten(table(spark, short + long)).collect()
    assert {(r.n, r.id >= 100) for r in got} == {(40, False), (50, True)}
    alone = {(r.id, r.component): r for r in whitening.whiten(table(spark, long)).collect()}
    for r in got:
        if r.id >= 100:
            assert abs(abs(r.whitened) - abs(alone[r.id, r.component].whitened)) < 1e-9


def test_huge_entries_do_not_overflow(spark):
    rows = [(k, [1e300 * (k % 2), float(k), -1e17 * k]) for k in range(20)]
    got = whitening.whiten(table(spark, rows, "double")).collect()
    assert {r.deviation for r in got} == {None} and all(np.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("dim", [1, 7, 30])
def test_triangular_solve(dim):
    rng = np.random.default_rng(dim)
    factor = np.triu(rng.standard_normal((dim, dim))) + 3 * np.eye(dim)
    rows = rng.standard_normal((50, dim))
    assert np.allclose(whitening.solve(rows, factor) @ factor, rows)


def test_query_agrees_with_brute_force(spark):
    got = queries.op13(spark, SF_SMALL).withColumnRenamed("vec_id", "id").collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, n, deviations, centred, values, vectors = brute(rows)
    assert len(got) == 32 * len(ids)
    assert sorted((r.id, r.deviation) for r in got if r.component == 1) == sorted(zip(ids, deviations))
    white = {(r.id, r.component): r.whitened for r in got}
    want = centred @ vectors[:, :32] / np.sqrt(values[:32])
    mine = np.array([[white[i, k + 1] for k in range(32)] for i in ids])
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-6
