"""Classifiers find a planted signal, weights act as they should, plans run end to end."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from proclivity.models import neighbours
from proclivity.models.classifiers import WEIGHTS, Classifier, build_model
from proclivity.operators import model_selection
from proclivity.operators.evaluation import probability_metrics
from proclivity.plans import experiments, scoring, tuning
from proclivity.schema import ID_COLUMN, TARGET_COLUMN

PARAMS = {
    "GradientBoosting": {"n_estimators": 5},
    "LogisticRegression": {"max_iter": 30},
    "AdaBoost": {"n_estimators": 3, "max_depth": 2},
    "DecisionTree": {"max_depth": 4},
    "RandomForestClassifier": {"n_estimators": 10, "max_depth": 5},
    "ExtraTreesClassifier": {"n_estimators": 10, "max_depth": 5},
    "GaussianNB": {},
    "KNeighborsClassifier": {"n_neighbors": 7},
    "MLPClassifier": {"hidden_layer_sizes": (4,), "max_iter": 40},
}


@pytest.fixture(scope="module")
def frame(spark):
    i = F.col("id")
    a, b = (i * 7919 % 1009) / 1009, (i * 104729 % 997) / 997
    return spark.range(800).select(
        i.alias(ID_COLUMN),
        ((a + b / 4) > 0.85).cast("int").alias(TARGET_COLUMN),
        a.alias("a"),
        b.alias("b"),
        ((i * 31 % 101) / 101).alias("noise"),
    ).cache()


@pytest.mark.parametrize("kind", sorted(WEIGHTS))
def test_planted_signal(frame, kind):
    model = build_model(kind, PARAMS[kind], features=["a", "b", "noise"])
    out = model.fit(frame).transform(frame)
    assert set(out.columns) == {ID_COLUMN, TARGET_COLUMN, "score", "prediction"}
    assert probability_metrics(out).first()["roc_auc"] > 0.8


def test_same_seed_same_scores(frame):
    model = Classifier("RandomForestClassifier", PARAMS["RandomForestClassifier"], ["a", "b", "noise"])
    one, two = model.fit(frame).transform(frame), model.fit(frame).transform(frame)
    assert one.exceptAll(two).count() == 0


def test_weights_raise_recall(frame):
    rare = frame.withColumn(TARGET_COLUMN, (F.col("a") + F.col("noise") / 2 > 1.2).cast("int"))
    recall = {}
    for w in (None, "balanced"):
        model = Classifier("LogisticRegression", {"C": 0.05}, ["a", "b"], weighting=w)
        recall[w] = probability_metrics(model.fit(rare).transform(rare)).first()["recall"]
    assert recall["balanced"] > recall[None]


def test_neighbours_by_matrix_need_no_shuffle(spark):
    rows = [(float(i % 7), float(i % 3), i % 2, "kept") for i in range(60)]
    train = spark.createDataFrame(rows, "a double, `b.c` double, label int, other string")
    model = neighbours.NearestNeighbours(["a", "b.c"], 3).fit(train)
    out = model.transform(train)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and out.columns == [*train.columns, "score", "prediction"] and out.count() == 60
    odd = spark.createDataFrame([(None, 1.0, 0, "x"), (-0.0, 0.0, 1, None)], train.schema)
    got = model.transform(odd).collect()
    assert got[0].score is None and got[0].prediction is None and got[1].score is not None
    nobody = neighbours.NearestNeighbours(["a"], 3).fit(train.limit(0).select("a", "label"))
    assert nobody.transform(train.select("a")).where("score IS NOT NULL").isEmpty()


@pytest.mark.parametrize("matrix_bytes", [0, neighbours.MATRIX_BYTES])
@pytest.mark.parametrize(("k", "weights", "p"), [(1, "uniform", 2), (7, "uniform", 1), (5, "distance", 2)])
def test_neighbours_match_brute_force(spark, monkeypatch, k, weights, p, matrix_bytes):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 20)
    monkeypatch.setattr(neighbours, "TRAIN_CHUNK", 40)
    rng = np.random.default_rng(k)
    x, y = rng.normal(size=(300, 3)), rng.integers(0, 2, 300)
    # A third of the training rows share one vector and one label.
    x[:100], y[:100] = 0.25, 1
    ask = np.vstack([rng.normal(size=(60, 3)), x[:5], x[150:155]])
    train = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, label int")
    test = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(ask)], "id int, a double, b double, c double")
    model = neighbours.NearestNeighbours(["a", "b", "c"], k, weights, p, matrix_bytes=matrix_bytes).fit(train)
    got = {r["id"]: r["score"] for r in model.transform(test).collect()}
    assert len(got) == len(ask)
    for i, point in enumerate(ask):
        d = (np.abs(x - point) ** p).sum(axis=1) ** (1 / p)
        order = np.argsort(d, kind="stable")[:k]
        w = np.ones(k)
        if weights == "distance":
            w = (d[order] == 0).astype(float) if d[order[0]] == 0 else 1 / d[order]
        assert abs(got[i] - (w * y[order]).sum() / w.sum()) < 1e-9


def test_unknown_model():
    with pytest.raises(ValueError):
        build_model("Nope")


def test_elimination_keeps_signal(frame):
    ranking = model_selection.eliminate_features(frame, ["a", "b", "noise"], max_iter=30)
    ranks = {r["feature"]: r["ranking"] for r in ranking.collect()}
    assert ranks == {"a": 1, "b": 2, "noise": 3}
    curve = model_selection.elimination_curve(frame, frame, ["a", "b", "noise"], ranking, every=1, max_iter=30)
    assert "a" in [r["feature"] for r in model_selection.wrapper_family(ranking, curve).collect()]


def test_importances_and_components(frame):
    table = model_selection.forest_importances(frame, ["a", "b", "noise"], trees=10, max_depth=4)
    assert table.first()["feature"] == "a"
    parts = model_selection.component_variances(frame, ["a", "b", "noise"]).collect()
    assert abs(max(r["cumulative_variance"] for r in parts) - 1) < 1e-9


def test_search_and_final_scoring(frame):
    space = {"max_depth": ("int", 2, 3), "min_samples_leaf": ("int", 5, 6)}
    table, predictions = tuning.train_all_models(
        ["DecisionTree", "GaussianNB"], frame, frame, frame.drop(TARGET_COLUMN), trials=1, spaces={"DecisionTree": space}, folds=2
    )
    assert table.count() == 2 and set(predictions) == {"DecisionTree", "GaussianNB"}
    model = Classifier("DecisionTree", {"max_depth": 3}, ["a", "b", "noise"])
    test = frame.drop(TARGET_COLUMN)
    submission, report = scoring.refit_and_score(frame, frame, test, model)
    assert submission.columns == [ID_COLUMN, TARGET_COLUMN] and submission.count() == 800
    assert report.first()["sample"] == "in-sample"


def test_draw_stays_in_range():
    import random

    generator = random.Random(1)
    for _ in range(50):
        p = tuning.draw(tuning.SPACES["GradientBoosting"], generator)
        assert 0.01 <= p["learning_rate"] <= 0.3 and 50 <= p["n_estimators"] <= 400
        assert 1e-9 <= tuning.draw(tuning.SPACES["GaussianNB"], generator)["var_smoothing"] <= 0.1


def test_cross_validation_scores_every_row_once(frame):
    model = Classifier("GaussianNB", {}, ["a", "b"])
    scores = experiments.cross_validated_scores(model, frame, folds=3)
    assert scores.count() == 800
