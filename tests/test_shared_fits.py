"""Validation and search by shared passes give what separate fits give; halving keeps the best and is repeatable."""

import pytest
from pyspark.sql import functions as F

from proclivity.models import newton
from proclivity.models.classifiers import Classifier
from proclivity.operators.evaluation import probability_metrics
from proclivity.operators.splitting import stratified_folds
from proclivity.plans import experiments, shared_fits, tuning

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def people(spark):
    noise = lambda k: F.expr(f"pmod(hash(id, {k}), 2000) / 1000D - 1")
    rows = spark.range(1200).select((F.col("id") + 1).alias("CONTROL_NUMBER"), noise(1).alias("a"), noise(2).alias("b"), (noise(3) + noise(1)).alias("c"))
    wish = F.col("a") * 2 - F.col("b") + F.expr("pmod(hash(CONTROL_NUMBER, 8), 2000) / 700D - 1.4") > 0.7
    return rows.withColumn("TARGET_B", wish.cast("int")).cache()


@pytest.fixture(scope="module")
def folded(people):
    return stratified_folds(people, 4, column="__fold").cache()


def separate(classifier, folded, folds, whole=False):
    """Metrics of one fit after the other."""
    parts = []
    for i in [*range(folds), *([shared_fits.WHOLE] if whole else [])]:
        rest = folded if i < 0 else folded.where(F.col("__fold") != i)
        held = folded if i < 0 else folded.where(F.col("__fold") == i)
        scored = classifier.on(FEATURES).fit(rest.drop("__fold")).transform(held.drop("__fold"))
        parts.append(probability_metrics(scored, with_counts=True).first())
    return parts


@pytest.mark.parametrize("classifier", [
    Classifier("LogisticRegression", {"C": 0.1}), Classifier("LogisticRegression", {"fit_intercept": False}, weighting=None),
    Classifier("GaussianNB", {"var_smoothing": 1e-3}), Classifier("DecisionTree", {"max_depth": 3}),
], ids=lambda c: f"{c.kind}-{c.weighting}")
def test_folds_equal_separate_fits(folded, classifier):
    want = separate(classifier, folded, 4, whole=True)
    scored = shared_fits.fold_scores(classifier, folded, 4, whole=True)
    got = {r.fold: r for r in probability_metrics(scored, by=["fold"], with_counts=True).collect()}
    for i, w in zip([0, 1, 2, 3, shared_fits.WHOLE], want, strict=True):
        assert abs(got[i].roc_auc - w.roc_auc) < 1e-3
        assert all(abs(got[i][c] - w[c]) <= 1 for c in ("tn", "fp", "fn", "tp"))


@pytest.mark.parametrize("kind,sets", [("LogisticRegression", [{"C": 0.01}, {"C": 5.0, "fit_intercept": False}]), ("GaussianNB", [{"var_smoothing": s} for s in (1e-9, 0.1)])])
def test_counts_equal_scores(folded, kind, sets):
    """Confusions counted without a row per fit equal those of the scored rows."""
    models = [Classifier(kind, p, FEATURES) for p in sets]
    for model, counts in zip(models, shared_fits.shared_confusions(models, folded, 4), strict=True):
        got = {r.fold: r for r in probability_metrics(shared_fits.fold_scores(model, folded, 4, whole=True), by=["fold"], with_counts=True).collect()}
        assert counts == [tuple(got[i][c] for c in ("tn", "fp", "fn", "tp")) for i in [0, 1, 2, 3, shared_fits.WHOLE]]


def test_passes_do_not_grow_with_trials(people, monkeypatch):
    seen = []
    sums = newton._sums
    monkeypatch.setattr(newton, "_sums", lambda rows, fits, width: seen.append(len(fits)) or sums(rows, fits, width))
    study = tuning.search("LogisticRegression", people, trials=12, folds=3)
    assert seen[0] == 12 * 4 and len(seen) < 20 and len(study.trials) == 12 and all(t["share"] == 1.0 for t in study.trials)


def test_same_seed_same_study(people):
    one, two = (tuning.search("GaussianNB", people, trials=5, folds=3, seed=4) for _ in range(2))
    assert one.trials == two.trials and one.best in one.trials


def test_rungs():
    assert tuning.rungs(10**9, 100) == pytest.approx([1 / 81, 1 / 27, 1 / 9, 1 / 3, 1.0])
    assert tuning.rungs(500, 100) == [1.0] and tuning.rungs(10**9, 2) == [1.0]
    assert tuning.rungs(4000, 100) == pytest.approx([1 / 3, 1.0])


def test_halving(people, monkeypatch):
    """The best third of each rung goes on; the winner was measured on all rows."""
    rows_seen = []

    def scores(kind, sets, rows, *_):
        rows_seen.append((len(sets), rows.count()))
        return [(p["max_depth"] / 100, 0.0) for p in sets]

    monkeypatch.setattr(tuning, "objectives", scores)
    study = tuning.search("DecisionTree", people, trials=9, least_rows=50)
    assert [n for n, _ in rows_seen] == [9, 3, 1] and rows_seen[-1][1] == people.count()
    assert rows_seen[0][1] < rows_seen[1][1] < rows_seen[2][1]
    assert study.best["params"]["max_depth"] == max(t["params"]["max_depth"] for t in study.trials)
    assert sorted(t["share"] for t in study.trials) == pytest.approx([1 / 9] * 6 + [1 / 3] * 2 + [1.0])


def test_cross_validation_summary(people):
    row = experiments.run_cross_validation(Classifier("LogisticRegression", {}, FEATURES), people, folds=3).first()
    assert 0.7 < row["roc_auc_mean"] < 1


def test_tuned_models_by_kind(people):
    table, _ = tuning.train_all_models(["GaussianNB", "LogisticRegression"], people, people, trials={"GaussianNB": 2, "LogisticRegression": 3}, folds=3)
    assert {r.model for r in table.collect()} == {"GaussianNB", "LogisticRegression"}
