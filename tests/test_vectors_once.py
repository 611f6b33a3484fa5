"""Fits of folds that read vectors have them assembled once, and give what separate fits give."""

import pytest
from pyspark.sql import functions as F

from proclivity.models import classifiers
from proclivity.plans import shared_fits, tuning


@pytest.fixture(scope="module")
def folded(spark):
    i = F.col("id")
    rows = spark.range(300).select(
        i.alias("CONTROL_NUMBER"),
        F.when(i % 50 != 7, ((i * 7919) % 13 < 4).cast("int")).alias("TARGET_B"),
        ((i * 31) % 101).cast("double").alias("a"),
        ((i * 7919) % 13).cast("int").alias("b.c"),
        ((i * 53) % 3).cast("int").alias("__fold"),
    )
    return rows.repartition(3).cache()


def separate(classifier, folded, number):
    """(tn, fp, fn, tp) of one fit from the columns themselves."""
    known = folded.where("TARGET_B IS NOT NULL")
    rest, held = (known, known) if number == -1 else (known.where(F.col("__fold") != number), known.where(F.col("__fold") == number))
    scored = classifier.fit(rest.drop("__fold")).transform(held.drop("__fold")).select("TARGET_B", "prediction").collect()
    return tuple(sum((r[0], r[1]) == k for r in scored) for k in ((0, 0), (0, 1), (1, 0), (1, 1)))


@pytest.mark.parametrize(
    ("kind", "sets"),
    [
        ("DecisionTree", [{"max_depth": 2, "min_samples_leaf": 5}, {"max_depth": 4, "max_features": "sqrt"}]),
        ("GradientBoosting", [{"n_estimators": 2}]),
        ("AdaBoost", [{"n_estimators": 2, "max_depth": 1}]),
    ],
)
def test_trials_share_their_vectors(spark, folded, monkeypatch, kind, sets):
    models = [classifiers.build_model(kind, p) for p in sets]
    want = [[separate(m, folded, i) for i in (0, 1, 2, -1)] for m in models]
    assembled, assemble = [], classifiers.assemble
    for module in (classifiers, shared_fits):
        monkeypatch.setattr(module, "assemble", lambda df, features: assembled.append(features) or assemble(df, features))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    scores = tuning.objectives(kind, sets, folded, folds=3)
    assert assembled == [["a", "b.c"]]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert scores == [(sum(map(tuning._f1, w[:-1])) / 3, tuning._f1(w[-1])) for w in want]
    assert shared_fits.separate_confusions(models, folded, 3) == want


def test_fold_scores_fit_from_shared_vectors(folded, monkeypatch):
    model = classifiers.build_model("DecisionTree", {"max_depth": 3})
    want = {i: separate(model, folded, i) for i in (0, 1, 2, -1)}
    assembled, assemble = [], shared_fits.assemble
    monkeypatch.setattr(shared_fits, "assemble", lambda df, features: assembled.append(features) or assemble(df, features))
    rows = shared_fits.fold_scores(model, folded, 3, whole=True).collect()
    assert assembled == [["a", "b.c"]]
    assert {i: tuple(sum((r.TARGET_B, r.prediction) == k for r in rows if r.fold == i) for k in ((0, 0), (0, 1), (1, 0), (1, 1))) for i in want} == want
