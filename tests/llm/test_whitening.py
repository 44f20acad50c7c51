"""Components against numpy's eigenvectors, exact figures against whole-number sums."""

from __future__ import annotations

import math

import numpy as np
import pytest

from shelfcast.llm import catalog
from shelfcast.llm import whitening as W


def plain(vectors: list[list[float]], components: int = W.COMPONENTS):
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    covariance = centred.T @ centred / n
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    values, columns = values[order], columns[:, order]
    return n, deviations, centred @ columns / np.sqrt(values), values / np.trace(covariance)


def compare(rows, vectors, tolerance=1e-7):
    n, deviations, white, share = plain(vectors)
    width = min(W.COMPONENTS, len(vectors[0]))
    assert len(rows) == len(vectors) * width
    got = np.zeros((len(vectors), width))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[r["vec_id"]]
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9)
    signs = np.sign((got * white).sum(0))
    assert np.abs(got - white * signs).max() < tolerance
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("d", [1, 2, 3, 12, 70])
def test_pairs_of_symmetric_matrices(d):
    random = np.random.default_rng(d)
    a = random.standard_normal((d, d))
    cases = [a @ a.T, a + a.T, np.eye(d), np.diag(np.arange(d) % 3 + 1.0), np.zeros((d, d)),
             np.kron(np.eye(d), np.ones((2, 2))), 1e-9 * a @ a.T, np.outer(a[0], a[0])]
    for matrix in cases:
        values, columns = W.leading_pairs(matrix, 8)
        expected = np.sort(np.linalg.eigvalsh(matrix))[::-1][: len(values)]
        scale = np.abs(matrix).max() or 1.0
        assert np.abs(values - expected).max(initial=0) < 1e-12 * scale * len(matrix)
        assert np.abs(matrix @ columns - columns * values).max(initial=0) < 1e-12 * scale * len(matrix)
        assert np.abs(columns.T @ columns - np.eye(len(values))).max(initial=0) < 1e-11


def test_sturm_count_counts_eigenvalues():
    random = np.random.default_rng(3)
    diagonal, off = random.standard_normal(20), random.standard_normal(19)
    off[7] = 0
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-4, 4, 50)
    assert W.sturm_count(diagonal, off, at).tolist() == [(values < x).sum() for x in at]


def test_rows_that_hold_no_numbers_are_dropped(spark):
    random = np.random.default_rng(0)
    good = random.standard_normal((40, 5)).tolist()
    rows = [(k, v, 1, 2.0) for k, v in enumerate(good)]
    rows += [(90, None, 1, 2.0), (91, [1.0, None, 1.0, 1.0, 1.0], 1, 2.0), (92, [math.nan] + [0.0] * 4, 1, 2.0), (93, [0.0] * 4 + [math.inf], 1, 2.0),
             (94, [], 1, 2.0), (95, [1.0, 2.0], 1, 2.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, whitened double").repartition(3)
    compare(W.whitened(df, ["vec_id"]).collect(), good)


def test_repeats_ties_and_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    twice = [[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0], [0.0, -1.0]] * 2
    rows = W.whitened(spark.createDataFrame(list(enumerate(twice)), schema), ["vec_id"]).collect()
    assert len(rows) == 16 and {r["explained"] for r in rows} == {0.5} and rows[0]["identity_error"] < 1e-9
    for same in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        assert W.whitened(spark.createDataFrame(list(enumerate(same)), schema), ["vec_id"]).collect() == []
    # One direction only: the other one cannot be scaled.
    line = [[float(k), float(k)] for k in range(5)]
    assert {r["component"] for r in W.whitened(spark.createDataFrame(list(enumerate(line)), schema), ["vec_id"]).collect()} == {1}


def test_deviations_stay_exact_beyond_doubles():
    gaps = np.array([[2**31, 3], [1, -1]], dtype=np.int64)
    assert W._squares(gaps) == [2**62 + 9, 2]
    assert W._squares(np.array([[2**31, 2**31]], dtype=np.int64)) == [None]


def test_query_equals_plain_components(spark, folder):
    vectors = [r["embedding"] for r in catalog.table(spark, folder, "embeddings").orderBy("vec_id").collect()]
    compare(catalog.QUERIES["op13_whitening"](spark, folder).collect(), vectors)
