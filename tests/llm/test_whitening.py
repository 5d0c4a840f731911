"""Whitening against exact arithmetic, and the eigenvectors against known ones."""

import math
from fractions import Fraction

import numpy as np
import pytest

from orderloom.llm import whitening
from orderloom.llm.common import ship_package
from orderloom.llm.queries import QUERIES
from tests.conftest import SF_SMALL

HIGH = whitening.HIGH


def turned(values, seed):
    """A matrix with known eigenvalues and eigenvectors, built from reflections in extended precision."""
    draw = np.random.default_rng(seed)
    n = len(values)
    q = np.eye(n, dtype=HIGH)
    for _ in range(n):
        v = draw.normal(size=n).astype(HIGH)
        q = q - 2 * np.outer(v, v @ q) / (v @ v)
    a = (q * np.array(values, HIGH)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 1],
        [5, 3 + 1e-9, 3, 3 - 1e-9, 1],
        [1e6, 1 + 1e-7, 1, 1 - 1e-7, 1e-3, 1e-6],
        [2 + 1e-8, 2 + 1e-8 - 1e-12, 2, 1],
        [1 + k * 1e-10 for k in range(12, 0, -1)],
        list(np.linspace(3, 1, 64)),
    ],
)
def test_clustered_eigenvalues(values):
    a, q = turned(values, len(values))
    found, x = whitening.eigenvectors(a)
    norm = max(abs(v) for v in values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17 * norm * len(values)
    assert np.abs(found - np.array(values, HIGH)).max() < 1e-17 * norm * len(values)
    gaps = [min(abs(v - w) for w in values if w != v) for v in values]
    for k, gap in enumerate(gaps):
        # The vector is as good as the entries of the matrix allow.
        assert min(np.abs(x[:, k] - q[:, k]).max(), np.abs(x[:, k] + q[:, k]).max()) < 64 * len(values) * whitening.EPS * norm / gap


def test_equal_eigenvalues_and_none():
    for values in ([2, 2, 2, 1], [1, 1, 1], [0, 0], [3, 0, 0]):
        a, _ = turned(values, 3)
        found, x = whitening.eigenvectors(a)
        assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
        assert np.abs(a @ x - x * found).max() < 1e-16
    assert len(whitening.eigenvectors(np.zeros((0, 0)))[0]) == 0


def test_products_are_exact():
    z = np.random.default_rng(1).integers(-(1 << 45), 1 << 45, (50, 3))
    want = [[sum(int(r[i]) * int(r[j]) for r in z) for j in range(3)] for i in range(3)]
    assert whitening._products(z).tolist() == want


SCHEMA = "vec_id bigint, embedding array<float>, n string, whitened string, component string"


def frame(spark, vectors):
    ship_package(spark)
    rows = [(k, v, "a", "b", "c") for k, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute(vectors):
    """Exact x, n, sums, deviations, covariance."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in vectors]
    n, size = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(size)]
    covariance = [[sum(Fraction(n * r[i] - s[i], n) * Fraction(n * r[j] - s[j], n) for r in x) / n for j in range(size)] for i in range(size)]
    deviation = [sum((n * r[d] - s[d]) ** 2 for d in range(size)) for r in x]
    return x, n, s, covariance, deviation


@pytest.mark.parametrize(("size", "scale"), [(5, 1.0), (12, 1.0), (3, 1e4)])
def test_whitened_by_exact_arithmetic(spark, size, scale):
    draw = np.random.default_rng(size)
    mix = draw.normal(size=(size, size))
    good = [(k, (scale * (draw.normal(size=size) @ mix)).tolist()) for k in range(60)]
    good += [good[0], (None, good[1][1])]
    bad = [(900, None), (901, [None] + [1.0] * (size - 1)), (902, [math.nan] * size), (903, [math.inf] + [0.0] * (size - 1)), (904, []), (905, [1.0])]
    rows = whitening.whiten(frame(spark, good + bad)).collect()
    x, n, s, covariance, deviation = brute(good)
    count = min(8, size)
    assert len(rows) == n * count and {r["n"] for r in rows} == {n}
    by_id = {}
    for r in rows:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    a = np.array([[whitening._high(v.numerator) / whitening._high(v.denominator) for v in row] for row in covariance])
    values, vectors = np.linalg.eigh(a.astype(float))
    values, vectors = values[::-1], vectors[:, ::-1]
    for place in range(1, 60):
        own = by_id[good[place][0]]
        for k in range(count):
            want = (np.array(x[place]) - np.array(s) / n) @ vectors[:, k] / math.sqrt(values[k])
            assert abs(abs(own[k + 1]["whitened"]) - abs(want)) < 1e-6
            assert abs(own[k + 1]["explained"] - values[k] / values.sum()) < 1e-9
            assert own[k + 1]["deviation"] == (deviation[place] if deviation[place] < 1 << 63 else None)
    w = np.array([[by_id[key][k + 1]["whitened"] for k in range(count)] for key, _ in good[:1] * 2 + good[1:60] + [(None, 0)]])
    error = np.abs(np.cov(w.T, bias=True) - np.eye(count)).max()
    reported = {r["identity_error"] for r in rows}
    assert len(reported) == 1 and max(reported) < 1e-9 and error < 1e-9


def test_tables_without_components(spark):
    one = [(1, [1.0, 2.0])]
    for vectors in ([], [(1, None)], [(1, [])], one, one * 5):
        found = whitening.whiten(frame(spark, vectors))
        assert found.isEmpty() and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # A dimension that never changes has no component, and the length of most vectors counts.
    rows = whitening.whiten(frame(spark, [(k, [float(k), 1.0]) for k in range(6)] + [(9, [1.0])])).collect()
    assert sorted((r["vec_id"], r["component"]) for r in rows) == [(k, 1) for k in range(6)]


def test_query(spark):
    rows = QUERIES["op12_whitening"](spark, SF_SMALL).collect()
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in table])
    place = {key: k for k, (key, _) in enumerate(table)}
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    scores = centred @ vectors[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert len(rows) == 8 * len(x)
    for r in rows:
        k = place[r["vec_id"]]
        assert abs(abs(r["whitened"]) - abs(scores[k, r["component"] - 1])) < 1e-8
        assert r["deviation"] == deviation[k] and r["identity_error"] < 1e-10
        assert abs(r["explained"] * values.sum() / values[::-1][r["component"] - 1] - 1) < 1e-9
