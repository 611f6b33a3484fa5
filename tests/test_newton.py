"""Shared Newton fits against Spark ML's logistic regression; passes do not grow with the number of fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from proclivity.models import newton
from proclivity.models.newton import Fit, fit_together, scores_of, training_rows, without
from proclivity.operators import model_selection
from proclivity.operators.splitting import balanced_weight

FEATURES = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def people(spark):
    noise = lambda k: F.expr(f"pmod(hash(id, {k}), 2000) / 1000D - 1")
    rows = spark.range(1500).select("id", *[noise(i).alias(f"x{i}") for i in range(5)], (noise(1) * 0.6 + noise(7) * 40).alias("x5"))
    wish = F.expr("2 * x0 - 1.5 * x1 + 0.5 * x2 + 0.02 * x5 - 1.2")
    return rows.withColumn("TARGET_B", (wish + noise(9) * 1.5 > 0).cast("int")).withColumn("fold", (F.col("id") % 5).cast("int")).cache()


def plain(df, features, c=1.0, intercept=True):
    """(coefficients, intercept) of Spark ML on its own."""
    rows = balanced_weight(df, "TARGET_B", "w")
    rows = VectorAssembler(inputCols=features, outputCol="v").transform(rows)
    total = rows.agg(F.sum("w")).first()[0]
    model = LogisticRegression(
        featuresCol="v", labelCol="TARGET_B", weightCol="w", regParam=1 / (c * total), standardization=False, maxIter=2000, tol=1e-14, fitIntercept=intercept
    ).fit(rows)
    return np.append(model.coefficients.toArray(), model.intercept)


def test_equal_to_separate_fits(people):
    fits = [Fit(range(6)), Fit([0, 2, 5], c=0.01), Fit(range(6), held=3), Fit([1, 4], held=0, c=10.0), Fit([0, 1], intercept=False)]
    rows = training_rows(people, FEATURES, fold="fold")
    passes = fit_together(rows, fits, 6)
    assert passes == max(f.passes for f in fits) <= 12 and all(f.converged for f in fits)
    for f in fits:
        own = people if f.held is None else people.where(F.col("fold") != f.held)
        want = plain(own, [FEATURES[i] for i in f.columns], f.c, f.intercept)
        assert np.allclose(f.beta, want, atol=1e-6, rtol=1e-6), (f.columns, f.beta, want)


def test_passes_do_not_grow_with_fits(people):
    rows = training_rows(people, FEATURES, fold="fold")
    one, many = fit_together(rows, [Fit(range(6))], 6), fit_together(rows, [Fit(range(6)), *[Fit(range(6), held=k) for k in range(5)]], 6)
    assert many <= one + 1


def test_warm_start_needs_few_passes(people):
    rows = training_rows(people, FEATURES)
    fit = Fit(range(6))
    fit_together(rows, [fit], 6)
    for gone in ([3], [3, 4]):
        start = without(fit, gone)
        cold = Fit(start.columns)
        warm_passes, cold_passes = fit_together(rows, [start], 6), fit_together(rows, [cold], 6)
        assert np.allclose(start.beta, cold.beta, atol=1e-7) and warm_passes < cold_passes


def test_scores_of_held_out_folds(people):
    fits = [Fit(range(6), held=k) for k in range(5)]
    rows = training_rows(people, FEATURES, fold="fold")
    fit_together(rows, fits, 6)
    scored = scores_of(rows, fits, 6)
    assert scored.count() == people.count() and scored.where("fit <> fold").isEmpty()


def reference_elimination(df, features, step=1):
    kept, rank = list(features), {}
    while len(kept) > 1:
        squared = sorted(zip(plain(df, kept)[:-1] ** 2, kept, strict=True))
        out = [f for _, f in squared[: min(step, len(kept) - 1)]]
        rank |= {f: len(kept) - len(out) + 1 for f in out}
        kept = [f for f in kept if f not in out]
    return rank | {kept[0]: 1}


@pytest.mark.parametrize("step", [1, 2])
def test_elimination_equals_full_refits(people, step):
    table = model_selection.eliminate_features(people, FEATURES, step=step)
    assert {r.feature: r.ranking for r in table.collect()} == reference_elimination(people, FEATURES, step)


def test_elimination_passes(people):
    rows = training_rows(people, FEATURES)
    _, passes = model_selection._eliminate(rows, FEATURES, 1, 1000)
    assert passes <= 8 + 4 * len(FEATURES)


def test_curve_equals_separate_fits(people):
    train, val = people.where("id % 3 > 0"), people.where("id % 3 = 0")
    ranking = model_selection.eliminate_features(train, FEATURES)
    ranks = {r.feature: r.ranking for r in ranking.collect()}
    curve = model_selection.elimination_curve(train, val, FEATURES, ranking, every=2).collect()
    assert [r.n_features for r in curve] == [2, 4, 6]
    data = val.toPandas()
    for r in curve:
        kept = [f for f in FEATURES if ranks[f] <= r.n_features]
        beta = plain(train, kept)
        s = data[kept].to_numpy() @ beta[:-1]
        pos, neg = s[data.TARGET_B == 1], s[data.TARGET_B == 0]
        area = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        assert abs(r.score - area) < 1e-9


def test_edges(spark, people):
    with pytest.raises(Exception, match="missing values"):
        fit_together(training_rows(spark.createDataFrame([(1, None), (0, 2.0)], "TARGET_B int, a double"), ["a"]), [Fit([0])], 1)
    constant = people.withColumn("c", F.lit(3.0))
    fit = Fit([0, 1])
    fit_together(training_rows(constant, ["x0", "c"]), [fit], 2)
    assert fit.converged and abs(fit.coefficients[1]) < 1e-6
    separable = people.withColumn("s", F.col("TARGET_B") * 50.0)
    fit = Fit([0], c=1000.0)
    fit_together(training_rows(separable, ["s"]), [fit], 1)
    data = balanced_weight(separable, "TARGET_B", "w").select("s", "TARGET_B", "w").toPandas()

    def loss(beta):
        margin = (data["s"] * beta[0] + beta[1]) * (2 * data["TARGET_B"] - 1)
        return (data["w"] * np.logaddexp(0, -margin)).sum() + beta[0] ** 2 / 2000

    assert fit.converged and loss(fit.beta) <= loss(plain(separable, ["s"], 1000.0)) + 1e-9
    only = Fit([])
    fit_together(training_rows(people, FEATURES), [only], 6)
    assert only.converged and abs(only.beta[0]) < 1e-8  # balanced weights: no preference


def test_halving(people):
    """A start far off, where full steps overshoot, still ends at the minimum."""
    rows = training_rows(people, FEATURES)
    far, near = Fit(range(6), c=100.0, beta=np.full(7, 9.0)), Fit(range(6), c=100.0)
    fit_together(rows, [far, near], 6)
    assert far.converged and np.allclose(far.beta, near.beta, atol=1e-6)
    assert newton.SMALL_STEP <= 1e-6
