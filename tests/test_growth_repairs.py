"""Neighbours of many wide rows: bounds by matrix products, blocks instead of cells that rule out little."""

import numpy as np
import pytest

from proclivity.models import neighbours


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12, 1e145])
@pytest.mark.parametrize("shift", [0.0, 1e5])
def test_bounds_lose_no_neighbour(monkeypatch, scale, shift):
    monkeypatch.setattr(neighbours, "FIRST_PART", 16)
    monkeypatch.setattr(neighbours, "HELD", 2000)
    rng = np.random.default_rng(3)
    known, asked = rng.integers(0, 4, (700, 6)) * scale + shift, rng.integers(0, 4, (90, 6)) * scale + shift
    places, distances = neighbours._nearest(asked, known, 9, 2)
    d = neighbours._distances(asked, known, 2)
    want = np.argsort(d, axis=1, kind="stable")[:, :9]
    assert (places == want).all() and (distances == np.take_along_axis(d, want, axis=1)).all()


def test_nearest_multiplies_matrices_instead_of_all_distances(monkeypatch):
    pairs = []
    plain = neighbours._pairs
    monkeypatch.setattr(neighbours, "_pairs", lambda a, b, p: pairs.append(a.shape[1]) or plain(a, b, p))
    rng = np.random.default_rng(4)
    known, asked = rng.normal(size=(20_000, 8)), rng.normal(size=(500, 8))
    places, _ = neighbours._nearest(asked, known, 5, 2)
    assert sum(pairs) < len(known) * len(asked) / 100
    assert (places == np.argsort(neighbours._distances(asked, known, 2), axis=1, kind="stable")[:, :5]).all()


def test_wide_vectors_are_sent_once_per_block(spark):
    """Where bounds rule out little, the training vectors meet all queries in one cell; rows with gaps stay unscored."""
    rng = np.random.default_rng(5)
    names = [f"x{i}" for i in range(20)]
    x, y = rng.normal(size=(400, 20)), rng.integers(0, 2, 400)
    schema = ", ".join(f"{n} double" for n in names)
    train = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], f"{schema}, label int")
    test = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[:50] + 0.1)] + [(50, None, *[0.0] * 19)], f"id int, {schema}")
    few = neighbours.NearestNeighbours(names, 7, matrix_bytes=0).fit(train)
    out = few.transform(test)
    got = {r.id: r.score for r in out.collect()}
    want = {r.id: r.score for r in neighbours.NearestNeighbours(names, 7).fit(train).transform(test).collect()}
    assert got == want and got[50] is None and len(got) == 51
