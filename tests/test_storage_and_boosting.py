"""Columns that do not fit narrow types stay wide; boosting keeps one table and the weights of the plain recursion."""

import math
import os

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from proclivity.models.boosting import SammeBoost
from proclivity.operators.cleaning import reduce_storage, storage_overflows
from proclivity.session import Rolling, scratch_dir


def test_storage(spark):
    rows = [(1, 2**31, 1.5, 1e39, None), (None, -5, float("inf"), 2.0, None), (2**31 - 1, 7, float("nan"), -1e300, None)]
    df = spark.createDataFrame(rows, "a long, b long, c double, d double, e long")
    small = reduce_storage(df)
    assert dict(small.dtypes) == {"a": "int", "b": "bigint", "c": "float", "d": "double", "e": "int"}
    assert {r.feature: r.overflows for r in storage_overflows(df).collect()} == {"a": 0, "b": 1, "c": 0, "d": 2, "e": 0}
    assert [r.b for r in small.collect()] == [2**31, -5, 7] and [r.d for r in small.collect()] == [1e39, 2.0, -1e300]
    assert dict(reduce_storage(df.limit(0)).dtypes)["b"] == "int" and reduce_storage(spark.createDataFrame([("x",)], "t string")).dtypes == [("t", "string")]


@pytest.fixture(scope="module")
def vectors(spark):
    noise = lambda k: F.expr(f"pmod(hash(id, {k}), 500) / 250D - 1")
    rows = spark.range(300).select(noise(1).alias("a"), noise(2).alias("b"), noise(3).alias("e"))
    rows = rows.withColumn("label", ((F.col("a") * F.col("b") + F.col("e") / 3) > 0).cast("double"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).select("features", "label").cache()


def test_weights_equal_plain_recursion(vectors):
    """The trees' own misses, put through the recursion in plain numbers, give the same factors."""
    model = SammeBoost({"n_estimators": 12, "max_depth": 1}).fit(vectors)
    assert len(model.trees) > 5
    weight = np.full(vectors.count(), 1 / vectors.count())
    label = np.array([r.label for r in vectors.collect()])
    for tree, alpha in zip(model.trees, model.state["alphas"], strict=True):
        missed = np.array([r.prediction for r in tree.transform(vectors).collect()]) != label
        error = weight[missed].sum() / weight.sum()
        assert abs(alpha - math.log((1 - error) / error)) < 1e-9
        weight = np.where(missed, weight * math.exp(alpha), weight) / weight.sum()


def test_rounds_leave_no_files_and_no_growing_plan(spark, vectors, monkeypatch):
    plans = []
    write = Rolling.write
    monkeypatch.setattr(Rolling, "write", lambda self, df: plans.append(len(df._jdf.queryExecution().optimizedPlan().toString())) or write(self, df))
    before = {d for d, _, _ in os.walk(scratch_dir(spark)) if "/boost-" in d}
    SammeBoost({"n_estimators": 15, "max_depth": 1}).fit(vectors)
    assert len(plans) > 8 and max(plans[2:]) < 1.1 * min(plans[2:])
    assert {d for d, _, _ in os.walk(scratch_dir(spark)) if "/boost-" in d} == before
