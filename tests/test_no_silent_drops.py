"""Parameters, columns and rows that were once dropped without a word."""

import numpy as np
import pytest

from proclivity.models.classifiers import Classifier
from proclivity.operators.correlation import spearman_with_target
from proclivity.operators.encoding import OneHotEncoder
from proclivity.operators.splitting import stratified_folds, stratified_split
from proclivity.sources.files import load_train_data


@pytest.mark.parametrize(
    "kind, params",
    [
        ("DecisionTree", {"max_leaf_nodes": 2}), ("DecisionTree", {"no_such": 3}), ("DecisionTree", {"min_samples_split": 9}),
        ("RandomForestClassifier", {"max_features": "third"}), ("MLPClassifier", {"solver": "adam"}), ("LogisticRegression", {"penalty": "none"}),
    ],
)
def test_unsupported_parameters_raise(kind, params):
    with pytest.raises(ValueError):
        Classifier(kind, params)


def test_supported_parameters_pass():
    Classifier("DecisionTree", {"min_samples_split": 9, "min_samples_leaf": 26, "max_features": 3})


def test_undeclared_columns_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CONTROL_NUMBER,TARGET_B,EXTRA\n1,0,x\n")
    row = load_train_data(spark, str(tmp_path), "a.csv").first()
    assert row.EXTRA == "x" and row.TARGET_B == 0
    spark.createDataFrame([(1, 0, 2.5)], "CONTROL_NUMBER long, TARGET_B int, EXTRA double").write.parquet(str(tmp_path / "b.parquet"))
    row = load_train_data(spark, str(tmp_path), "b.parquet").first()
    assert row.EXTRA == 2.5 and row.CHILDREN is None


def test_equal_output_names_raise(spark):
    frame = spark.createDataFrame([("B_C", "x"), ("y", "C")], "A string, A_B string")
    with pytest.raises(ValueError, match="A_B_C"):
        OneHotEncoder().fit(frame).transform(frame)


def test_missing_labels_raise(spark):
    frame = spark.createDataFrame([(1, 0), (2, None)], "CONTROL_NUMBER long, TARGET_B int")
    with pytest.raises(ValueError):
        stratified_split(frame)
    with pytest.raises(ValueError):
        stratified_folds(frame, 2)


def test_spearman_with_any_target(spark):
    rng = np.random.default_rng(1)
    rows = [(int(y), float(x), None if i % 7 == 0 else float(x * y)) for i, (x, y) in enumerate(zip(rng.integers(0, 5, 400), rng.integers(0, 9, 400)))]
    frame = spark.createDataFrame(rows, "t int, a double, b double")
    pandas = frame.toPandas()
    want = {c: pandas[[c, "t"]].dropna().rank().corr().iloc[0, 1] for c in "ab"}
    got = {r.feature: r.correlation for r in spearman_with_target(frame, ["a", "b"], "t").collect()}
    assert got == pytest.approx(want, abs=1e-9)
