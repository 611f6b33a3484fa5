"""Spearman matrices with gaps against ranks by pair in plain pandas; both ways of finding ranks; hot values."""

import numpy as np
import pandas as pd
import pytest

from proclivity.operators import rank_correlation
from proclivity.operators.rank_correlation import gap_sets, spearman_matrix


def frame(spark, table: dict):
    rows = [tuple(None if v is None or v != v else float(v) for v in r) for r in zip(*table.values(), strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in table))


def check(df, table, **options):
    data = pd.DataFrame(table, dtype=float)
    want = data.corr(method="spearman")
    got = {(r.feature_a, r.feature_b): r for r in spearman_matrix(df, **options).collect()}
    assert len(got) == len(table) ** 2
    for (a, b), r in got.items():
        both = data[[a, b]].dropna() if a != b else data[[a]].dropna()
        assert r.n == len(both)
        spread = both.nunique().min() > 1 if len(both) else False
        expected = want.loc[a, b] if spread else None
        assert (r.correlation is None) == (expected is None), (a, b)
        assert expected is None or abs(r.correlation - expected) < 1e-12, (a, b, r.correlation, expected)


def mixed(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    gap = rng.random(n) < 0.3
    coarse = np.where(rng.random(n) < 0.8, 0.0, rng.integers(-2, 3, n))
    table = {
        "plain": x, "coarse": coarse, "with.dot": np.where(gap, np.nan, x**3 + rng.normal(size=n)), "same gaps": np.where(gap, np.nan, rng.random(n)),
        "other": np.where(rng.random(n) < 0.5, np.nan, -x), "constant": np.ones(n), "empty": np.full(n, np.nan), "late": np.where(~gap, np.nan, x),
    }
    return {c: v.tolist() for c, v in table.items()}


@pytest.mark.parametrize("lookup_bytes", [0, rank_correlation.LOOKUP_BYTES])
def test_gaps_ties_and_constants(spark, lookup_bytes):
    table = mixed()
    check(frame(spark, table).repartition(5), table, lookup_bytes=lookup_bytes)


def test_gap_sets(spark):
    table = mixed()
    sets = dict(zip(table, gap_sets(frame(spark, table), list(table)), strict=True))
    assert sets["plain"] == sets["coarse"] == sets["constant"] == 0 and sets["with.dot"] == sets["same gaps"] != 0
    assert len(set(sets.values())) == 5


def test_one_value_holds_most_rows(spark):
    """Both ways agree where nearly all rows share a value, on more rows than are held at once."""
    df = spark.range(30_000).selectExpr("CASE WHEN id % 50 = 0 THEN id ELSE 7 END AS a", "CASE WHEN id % 3 > 0 THEN id % 11 END AS b", "-id AS c")
    both = [spearman_matrix(df, lookup_bytes=n).toPandas().sort_values(["feature_a", "feature_b"]) for n in (0, 10**9)]
    assert np.allclose(both[0]["correlation"], both[1]["correlation"], atol=1e-13) and (both[0]["n"].to_numpy() == both[1]["n"].to_numpy()).all()
    want = df.toPandas().astype(float).corr(method="spearman")
    assert all(abs(want.loc[a, b] - c) < 1e-12 for a, b, c in both[0][["feature_a", "feature_b", "correlation"]].itertuples(index=False))


def test_small_frames(spark):
    assert spearman_matrix(spark.createDataFrame([], "a double, b int")).where("n <> 0 OR correlation IS NOT NULL").count() == 0
    assert spearman_matrix(spark.createDataFrame([("x",)], "a string")).count() == 0
    (one,) = spearman_matrix(spark.createDataFrame([(1.0,), (float("nan"),), (-0.0,), (0.0,)], "a double")).collect()
    assert (one.n, one.correlation) == (3, 1.0)
