"""Exact quantiles and running totals against brute force, with limits small enough to matter."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from proclivity.operators import quantiles, running

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def numbers(spark):
    n = 20_000
    rng = np.random.default_rng(3)
    smooth = rng.gamma(2.0, 3.0, n)
    # One value holds a third of the rows; the rest are distinct.
    hot = np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(0, 50, n))
    few = rng.integers(0, 5, n).astype(float)
    rows = [
        (int(i % 3 if i % 7 else 0), float(a), float(b), float(c), None)
        for i, (a, b, c) in enumerate(zip(smooth, hot, few))
    ]
    df = spark.createDataFrame(rows, "g int, smooth double, hot double, few double, empty double")
    return df.withColumn("gappy", F.when(F.col("smooth") > 4, F.col("smooth"))).cache()


@pytest.mark.parametrize("limit", [50, 1_000, 1_000_000])
def test_matches_numpy(numbers, limit):
    columns = ["smooth", "hot", "few", "gappy", "empty"]
    got = quantiles.exact_quantiles(numbers, columns, PROBS, exact_values=limit)
    pdf = numbers.toPandas()
    for c in columns[:-1]:
        want = np.quantile(pdf[c].dropna().astype(float), PROBS)
        assert np.allclose(got[c], want, rtol=0, atol=1e-9), c
    assert got["empty"] == [None] * len(PROBS)


def test_two_values_only(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("double").alias("x"))
    got = quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], exact_values=1)
    assert got["x"] == [0.0, 0.5, 1.0]


@pytest.mark.parametrize("small", [100, 1_000_000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(numbers, small, descending):
    counts = numbers.groupBy("g", "hot").agg(F.count(F.lit(1)).alias("n"))
    got = running.running_sums(
        counts, ["g"], "hot", ["n"], descending=descending, small_group=small
    ).toPandas()
    want = counts.toPandas().sort_values("hot", ascending=not descending)
    want["n_upto"] = want.groupby("g")["n"].cumsum()
    merged = got.merge(want, on=["g", "hot"])
    assert len(merged) == len(want)
    assert (merged.n_upto_x == merged.n_upto_y).all()


def test_grouped_order_statistics(numbers, monkeypatch):
    monkeypatch.setattr(running, "SMALL_GROUP", 100)
    got = running.order_statistics(numbers, ["g"], "hot", [0.25, 0.5], bounded_groups=False)
    pdf = numbers.toPandas()
    for row in got.collect():
        want = np.quantile(pdf[pdf.g == row["g"]].hot, [0.25, 0.5])
        assert np.allclose([row["q0"], row["q1"]], want)


def test_strata_without_buffer(spark, monkeypatch):
    from proclivity.operators import imputation

    rows = [("a", "x", 1.0), ("a", "x", 3.0), ("a", None, 9.0), (None, "x", 50.0), ("b", "y", 2.0)]
    df = spark.createDataFrame(rows, "h string, u string, v double")
    whole = imputation.stratified_medians(df, "v", ["h", "u"])
    monkeypatch.setattr(imputation, "fits_one_buffer", lambda *a: False)
    ranged = imputation.stratified_medians(df, "v", ["h", "u"])
    def key(r):
        return str(r)

    assert sorted(map(tuple, whole.collect()), key=key) == sorted(map(tuple, ranged.collect()), key=key)
    assert {(r["h"], r["__depth"]): r["__median"] for r in whole.collect()} == {
        ("a", 2): 2.0,
        ("a", 1): 3.0,
        ("b", 2): 2.0,
        ("b", 1): 2.0,
    }
