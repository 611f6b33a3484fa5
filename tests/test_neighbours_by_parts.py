"""Neighbours beyond one matrix: training vectors come part by part, and no vector is written once per block."""

import glob

import numpy as np
import pytest

from proclivity.models import neighbours
from proclivity.session import Rolling, scratch_dir


def _plain(asked, known, n, pos, k, p):
    """The k nearest by distance, rows and positive rows."""
    d = neighbours._distances(asked, known, p)
    return [sorted(zip(row, n, pos))[:k] for row in d]


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize(("scale", "shift"), [(1.0, 0.0), (1e-3, 1e6), (1e10, 0.0), (1e145, 0.0)])
def test_parts_one_after_the_other_equal_all_at_once(monkeypatch, p, scale, shift):
    monkeypatch.setattr(neighbours, "LEAF", 16)
    monkeypatch.setattr(neighbours, "FIRST_PART", 24)
    monkeypatch.setattr(neighbours, "HELD", 1000)
    rng = np.random.default_rng(p)
    # Grid points: many equal distances, which rows and positive rows decide.
    known, asked = rng.integers(0, 3, (600, 7)) * scale + shift, rng.integers(0, 3, (80, 7)) * scale + shift
    n = rng.integers(1, 4, 600)
    pos = rng.integers(0, n + 1)
    if p == 3 and scale > 1e100:
        pytest.skip("powers beyond doubles")
    near = neighbours._nobody(len(asked), 11)
    for part in np.array_split(rng.permutation(600), [5, 200, 210, 450]):
        neighbours._search(asked, near, neighbours.Known(known[part], n[part], pos[part]), p)
    got = [[tuple(e) for e in row] for row in near]
    assert got == _plain(asked, known, n, pos, 11, p)


def test_fewer_vectors_than_neighbours_and_odd_rows(monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 2)
    known = np.array([[0.0, 0.0], [0.0, 2.0], [5.0, 0.0]])
    near = neighbours._nobody(2, 4)
    neighbours._search(np.array([[0.0, 0.0], [5.0, 1.0]]), near, neighbours.Known(known, np.array([1, 2, 1]), np.array([1, 0, 1])), 2)
    assert np.isnan(near[:, 3, 0]).all() and near[0, :3, 0].tolist() == [0.0, 2.0, 5.0]
    assert neighbours._votes(near, False).tolist() == [0.5, 0.5]
    far = neighbours._nobody(1, 2)
    neighbours._search(np.array([[np.inf, 0.0]]), far, neighbours.Known(known, np.ones(3), np.ones(3)), 2)
    assert np.isinf(far[0, :, 0]).all() and neighbours._votes(far, False).tolist() == [1.0]
    same = np.zeros((5, 3))
    assert neighbours._nearest(same, np.ones((9, 3)), 4, 2)[1].tolist() == [[3**0.5] * 4] * 5


def test_no_vector_is_written_once_per_block(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 5)
    monkeypatch.setattr(neighbours, "TRAIN_CHUNK", 60)
    rng = np.random.default_rng(9)
    names = [f"x{i}" for i in range(12)]
    schema = ", ".join(f"{n} double" for n in names)
    x, y = rng.normal(size=(240, 12)), rng.integers(0, 2, 240)
    train = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], f"{schema}, label int")
    test = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(60, 12)))], f"id int, {schema}")
    written, write = [], Rolling.write

    def counting(self, df):
        out = write(self, df)
        written.append(out.count())
        return out

    monkeypatch.setattr(Rolling, "write", counting)
    old = set(glob.glob(f"{scratch_dir(spark)}/*/asked-*") + glob.glob(f"{scratch_dir(spark)}/*/neighbours-*"))
    model = neighbours.NearestNeighbours(names, 5, matrix_bytes=0).fit(train)
    out = model.transform(test)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Generate" not in plan
    # Both sides of the fit, then the distinct rows asked for once a round: never a product of rows and blocks.
    assert written == [240, 240, 60, 60, 60, 60, 60, 60, 60]
    kept = set(glob.glob(f"{scratch_dir(spark)}/*/asked-*") + glob.glob(f"{scratch_dir(spark)}/*/neighbours-*")) - old
    assert len(kept) == 2 and all(len(glob.glob(f"{folder}/*")) == 1 for folder in kept)
    whole = neighbours.NearestNeighbours(names, 5).fit(train).transform(test)
    assert {r.id: r.score for r in out.collect()} == {r.id: r.score for r in whole.collect()}
