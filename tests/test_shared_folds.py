"""Folds are written once for all compared models."""

from pyspark.sql import functions as F

from proclivity.models.classifiers import Classifier
from proclivity.plans import experiments


def test_compared_models_share_their_folds(spark, monkeypatch):
    df = spark.range(80).select(
        F.col("id").alias("CONTROL_NUMBER"),
        (F.col("id") % 3 == 0).cast("int").alias("TARGET_B"),
        (F.col("id") % 4).cast("double").alias("INCOME_GROUP"),
    )
    models = {
        "tree": Classifier("DecisionTree", {"max_depth": 2}, ["INCOME_GROUP"]),
        "bayes": Classifier("GaussianNB", {"var_smoothing": 1e-3}, ["INCOME_GROUP"]),
    }
    alone = {n: experiments.run_cross_validation(m, df, 2).first() for n, m in models.items()}
    written, materialize = [], experiments.materialize
    monkeypatch.setattr(experiments, "materialize", lambda frame, label: written.append(label) or materialize(frame, label))
    got = {r["model"]: r for r in experiments.compare_models(models, df, 2).collect()}
    assert written == ["folds"]
    assert {n: tuple(r)[1:] for n, r in got.items()} == {n: tuple(r) for n, r in alone.items()}
