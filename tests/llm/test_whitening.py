"""Whitening against plain numpy; the solver on hard spectra; odd vectors."""

import numpy as np
import pytest

from proclivity.llm import contour, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, entries string, n int"


@pytest.mark.parametrize("spectrum", [
    np.random.default_rng(1).exponential(10, 64), 1 + 1e-6 * np.random.default_rng(2).random(64), np.repeat([5.0, 3, 1, 0], 10),
    np.r_[np.random.default_rng(3).random(5), np.zeros(59)], np.array([3.0]), np.array([1.0, 1]), 2.0 ** -np.arange(64), np.ones(64),
])
def test_solver_finds_all(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((len(spectrum),) * 2))
    matrix = (q * spectrum) @ q.T
    e, v = contour.largest_components(matrix, 32)
    assert len(e) == min(32, (spectrum > 2e-11 * spectrum.max()).sum())
    assert np.allclose(e, np.sort(spectrum)[::-1][: len(e)], rtol=1e-9, atol=1e-13 * spectrum.max())
    assert np.abs(matrix @ v - v * e).max() < 1e-13 * spectrum.max() and np.abs(v.T @ v - np.eye(len(e))).max() < 1e-13


def test_inertia_counts():
    m = np.random.default_rng(7).standard_normal((30, 30))
    m, shifts = m + m.T, np.linspace(-20, 20, 81)
    values = np.linalg.eigvalsh(m)
    counts = contour.Inertia(m)
    assert [counts.above(s) for s in shifts] == [(values > s).sum() for s in shifts]


def plain(vectors, components=32):
    """(x, n, S, V, e) over the given vectors."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    v = centred.T @ centred / n
    e = np.sort(np.linalg.eigvalsh(v))[::-1][:components]
    return x, n, s, v, e


def compare(got, vectors, ids):
    x, n, s, v, e = plain(vectors)
    got = sorted(got, key=lambda r: (r.vec_id, r.component))
    k = len(got) // n
    assert [r.vec_id for r in got] == [i for i in ids for _ in range(k)] and [r.component for r in got] == list(range(1, k + 1)) * n
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    assert [r.deviation for r in got] == [d for d in deviation for _ in range(k)]
    assert np.allclose([r.explained for r in got[:k]], e[:k] / np.trace(v), rtol=1e-9)
    w = np.array([r.whitened for r in got]).reshape(n, k)
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9 and all(r.identity_error < 1e-9 and r.n == n for r in got)
    # The coordinates times deviations reproduce projections: V's action on them scales by e.
    axes = (x - s / n).T @ w / n / np.sqrt(e[:k])
    assert np.allclose(v @ axes, axes * e[:k], atol=1e-9 * e[0])
    return k


def test_query_equals_plain(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    kept = [r for r in table if r.embedding is not None]
    assert compare(queries.QUERIES["op13_contour_whitening"](spark, sf).collect(), [r.embedding for r in kept], [r.vec_id for r in kept]) == 32


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [rng.normal(size=5).astype(np.float32).tolist() for _ in range(40)]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)]
    rows += [(90, None, "x", 1), (91, [1.0, None, 1.0, 1.0, 1.0], "x", 1), (92, [float("nan")] * 5, "x", 1), (93, [float("inf")] * 5, "x", None)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert compare(got, good, range(40)) == 5
    # Repeated rows count again; a dimension that never varies adds no component.
    twice = [(i // 2, [*good[i // 2][:3], 7.0, 7.0], None, 1) for i in range(80)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(twice, SCHEMA)).collect()} == {1, 2, 3}
    null_key = whitening.whiten(spark.createDataFrame([(None, v, "x", 1) for v in good], SCHEMA)).collect()
    assert len(null_key) == 200 and {r.vec_id for r in null_key} == {None}


def test_nothing_to_whiten(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "x", 1), (2, [1.0, 2.0], "x", 1)], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], "x", 1) for i in range(9)], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [], "x", 1) for i in range(3)], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], "x", 1), (2, [1.0, 2.0], "x", 1)], SCHEMA)).count()


def test_exact_squares():
    big = np.array([[3_037_000_499, 5], [1, 2]], np.int64)
    assert whitening._squares(big).tolist() == [3_037_000_499**2 + 25, 5]
    with pytest.raises(OverflowError):
        whitening._squares(np.array([[3_037_000_500, 0]], np.int64))
