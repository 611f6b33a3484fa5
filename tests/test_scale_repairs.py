"""Operators that must not depend on the width squared, on one task or on an open-ended loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from proclivity.models.classifiers import Classifier
from proclivity.operators import evaluation, outliers, profiling, quantiles
from proclivity.operators.correlation import null_correlations, null_overlaps


def test_null_overlaps_by_pair(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, 2), (3, 4, None)], "a int, b int, c int")
    got = {(r.feature_a, r.feature_b): (r.nulls_a, r.nulls_b, r.both, r.n) for r in null_overlaps(df, ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): (1, 2, 1, 3), ("a", "c"): (1, 2, 0, 3), ("b", "c"): (2, 2, 1, 3)}


def test_null_overlaps_without_rows_or_pairs(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert [(r.both, r.n) for r in null_overlaps(empty, ["a", "b"]).collect()] == [(0, 0)]
    assert null_correlations(empty, ["a", "b"]).first()["correlation"] is None
    assert null_overlaps(empty, ["a"]).count() == 0


def test_outlier_sides_are_the_sizes_of_the_split(spark):
    df = spark.range(200).select(
        F.when(F.col("id") < 5, 1e6).otherwise(F.col("id") % 7).alias("x"),
        F.when(F.col("id") % 50 == 0, -1e6).otherwise(F.col("id") % 11).alias("y"),
    )
    sizes = {(r["feature"], r["outlying"]): r["rows"] for r in outliers.outlier_sides(df, ["x", "y"]).collect()}
    pairs = outliers.split_by_outliers(df, ["x", "y"]) | {"ANY": outliers.split_by_outliers(df, ["x", "y"], per_column=False)}
    assert sizes == {(c, bool(k)): side.count() for c, pair in pairs.items() for k, side in enumerate(pair)}


def test_first_reaching_needs_no_window_over_all_rows(spark):
    shares = spark.range(1, 11).select("id", F.lit(0.1).alias("share"))
    got = evaluation.first_reaching(shares, "id", "share", 0.55)
    assert {r["components_needed"] for r in got.collect()} == {6}
    assert {r["components_needed"] for r in evaluation.first_reaching(shares, "id", "share", 2.0).collect()} == {10}


@pytest.mark.parametrize("edges", [[0.0, 0.001], [0.999, 1.0]])
def test_quantile_search_ends_when_every_bracket_misses(spark, monkeypatch, edges):
    monkeypatch.setattr(quantiles, "_edges", lambda position: list(edges))
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).cast("double").alias("x"))
    got = quantiles.exact_quantiles(df, ["x"], [0.25, 0.5], exact_values=200)
    assert np.allclose(got["x"], np.quantile(np.arange(1000), [0.25, 0.5]))


def test_rows_without_score_count_in_the_decisions_only(spark):
    df = spark.createDataFrame(
        [(0.9, 1, 1), (0.2, 0, 0), (0.4, 0, 1), (None, 1, 1), (None, 1, 0)], "score double, prediction int, TARGET_B int"
    )
    got = evaluation.evaluate_classification(df, "prediction", score="score").first()
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (1, 1, 1, 2)
    assert got["roc_auc"] == 1.0
    blank = evaluation.evaluate_classification(df.where("score IS NULL"), "prediction", score="score").first()
    assert (blank["fp"], blank["tp"], blank["roc_auc"]) == (1, 1, None)


def test_score_histogram_without_scores(spark):
    df = spark.createDataFrame([(None,), (None,)], "score double")
    rows = profiling.score_histogram(df, bins=4).collect()
    assert sorted((r["bin"], r["bin_start"], r["count"]) for r in rows) == [(0, 0.0, 0), (1, 0.25, 0), (2, 0.5, 0), (3, 0.75, 0)]


def test_logistic_penalty_follows_the_weights(spark):
    rows = [(i, float(i % 10), int(i % 10 > 7 or i % 17 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "CONTROL_NUMBER long, x double, TARGET_B int")
    positives = sum(y for _, _, y in rows)
    fitted = Classifier("LogisticRegression", {"C": 0.01}, features=["x"], weighting="positive").fit(df)
    # Positives weigh as much as all negatives together.
    assert abs(fitted.model.getRegParam() - 1 / (0.01 * 2 * (400 - positives))) < 1e-12
