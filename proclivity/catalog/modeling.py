"""Queries: classifiers, feature selection by models, experiments, tuning and scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.catalog.person_sql import with_persons
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import NUM, OUTLIER_COLUMNS, RANKED, clean_stages_fitted, each, r6
from proclivity.catalog.support import rounded
from proclivity.models.classifiers import Classifier, baseline_models
from proclivity.operators import evaluation, model_selection, selection
from proclivity.operators.features import add_engineered_features
from proclivity.operators.preprocessing import SCENARIOS, Preprocessor
from proclivity.operators.splitting import stratified_split
from proclivity.plans import experiments, scoring, tuning
from proclivity.plans.cleaning_chain import CleaningChain, clean_each_split
from proclivity.plans.persons import person_frame
from proclivity.plans.selection_run import SelectionRun, select_features
from proclivity.schema import ID_COLUMN, TARGET_COLUMN
from proclivity.session import materialize, scratch_dir

_memo: dict[tuple, DataFrame] = {}


def _once(spark, sf, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _memo:
        _memo[key] = materialize(make(), name)
    return _memo[key]


def split_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The stratified 70/30 split of the raw person table."""
    whole = _once(spark, sf, "split", lambda: stratified_split(person_frame(spark, sf)))

    def part(name: str) -> DataFrame:
        return whole.where(F.col("split") == name).drop("split")

    return part("train"), part("val")


def clean_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both parts through the cleaning chain fitted on the training part, text one-hot encoded."""
    train, val = split_parts(spark, sf)
    made = {}

    def make(name: str):
        if not made:
            chain = CleaningChain(encode="onehot", drop=["WEALTH_RATING"])
            made.update(clean_each_split({"train": train, "val": val}, chain))
        return made[name]

    return (
        _once(spark, sf, "clean_train", lambda: make("train")),
        _once(spark, sf, "clean_val", lambda: make("val")),
    )


def prepared_parts(spark, sf) -> tuple[DataFrame, DataFrame, list[str]]:
    """Derived columns and the linear preparation on top of the cleaned parts."""
    train, val = (add_engineered_features(df) for df in clean_parts(spark, sf))
    fitted = []

    def step():
        if not fitted:
            fitted.append(Preprocessor("linear").fit(train))
        return fitted[0]

    a = _once(spark, sf, "prep_train", lambda: step().transform(train))
    b = _once(spark, sf, "prep_val", lambda: step().transform(val))
    return a, b, [c for c in a.columns if c not in (ID_COLUMN, TARGET_COLUMN)]


@register(
    "clean_splits_row_counts",
    with_persons(
        "SELECT CASE WHEN r <= round(0.7 * n) THEN 'train' ELSE 'val' END AS split, count(*) AS rows, "
        "avg(TARGET_B) AS target_rate FROM ranked GROUP BY 1",
        RANKED.format(seed=5),
    ),
)
def clean_splits_row_counts(spark, sf):
    train, val = clean_parts(spark, sf)
    return train.select(F.lit("train").alias("split"), TARGET_COLUMN).unionAll(
        val.select(F.lit("val").alias("split"), TARGET_COLUMN)
    ).groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(TARGET_COLUMN).alias("target_rate"))


# Classifiers ---------------------------------------------------------------------------------

_MODEL_QUERIES = {
    "model_logistic_regression": ("LogisticRegression", {}),
    "model_random_forest": ("RandomForestClassifier", {"n_estimators": 50, "max_depth": 6}),
    "model_decision_tree": ("DecisionTree", {"max_depth": 8, "min_samples_leaf": 20}),
    "model_gradient_boosting": ("GradientBoosting", {"n_estimators": 20}),
    "model_extra_trees": ("ExtraTreesClassifier", {"n_estimators": 50, "max_depth": 6}),
    "model_adaboost": ("AdaBoost", {"n_estimators": 8, "max_depth": 4}),
    "model_nearest_neighbours": ("KNeighborsClassifier", {"n_neighbors": 15}),
    "model_multilayer_perceptron": ("MLPClassifier", {"hidden_layer_sizes": (16,), "max_iter": 50}),
}


def _model_query(name: str, kind: str, params: dict) -> None:
    def run(spark, sf):
        train, val, features = prepared_parts(spark, sf)
        return experiments.evaluate_classifier(Classifier(kind, params, features), train, val)

    register(name)(run)


for _name, (_kind, _params) in _MODEL_QUERIES.items():
    _model_query(_name, _kind, _params)

_BAYES = ["PCT_ATTRIBUTE1", "PCT_ATTRIBUTE2", "MEDIAN_HOME_VALUE", "MEDIAN_HOUSEHOLD_INCOME", "PEP_STAR"]




def bayes_sql(columns: list[str], rows: str, fit: str, keys: str, smoothing: float = 1e-9) -> str:
    """Scores of Gaussian Bayes for all of ``rows``, fitted on those of ``fit``."""
    return (
        f"SELECT {keys}, {r6('1 / (1 + exp(-greatest(least(odds, 700), -700)))')} AS score, CASE WHEN odds > 0 THEN 1 ELSE 0 END AS prediction FROM ("
        f"SELECT {keys}, ln(n1 / n0) + "
        + each(
            columns,
            lambda c: f"(0.5 * ln((v0_{c} + extra) / (v1_{c} + extra)) + power({c} - m0_{c}, 2) / (2 * (v0_{c} + extra)) - power({c} - m1_{c}, 2) / (2 * (v1_{c} + extra)))",
            " + ",
        )
        + f" AS odds FROM {rows} CROSS JOIN (SELECT CAST(count(*) FILTER (TARGET_B = 0) AS DOUBLE) AS n0, "
        f"CAST(count(*) FILTER (TARGET_B = 1) AS DOUBLE) AS n1, {smoothing!r} * greatest("
        + each(columns, lambda c: f"var_pop({c})", ", ")
        + ") AS extra, "
        + each(
            columns,
            lambda c: ", ".join(
                f"avg({c}) FILTER (TARGET_B = {k}) AS m{k}_{c}, var_pop({c}) FILTER (TARGET_B = {k}) AS v{k}_{c}"
                for k in (0, 1)
            ),
        )
        + f" FROM {fit}))"
    )


@register("model_gaussian_bayes", with_persons(bayes_sql(_BAYES, "persons", "persons", "CONTROL_NUMBER, TARGET_B")))
def model_gaussian_bayes(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN, *_BAYES)
    return rounded(Classifier("GaussianNB", {}, _BAYES).fit(df).transform(df))


# Selection by models -------------------------------------------------------------------------


_runs: dict[tuple, SelectionRun] = {}
#: Trees of this depth: the full one takes minutes on the smallest tables (see the README).
SELECTION_DEPTH = 8


def _selection(spark, sf) -> SelectionRun:
    """One selection run of all families per application and table folder, for the queries that look at its tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _runs:
        train, val, features = prepared_parts(spark, sf)
        path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/selected-{uuid.uuid4().hex}"
        _runs[key] = select_features(train, val, features, max_depth=SELECTION_DEPTH, path=path)
    return _runs[key]


@register("selection_run_votes")
def selection_run_votes(spark, sf):
    """Families, parts and consensus, from fitted selectors."""
    return _selection(spark, sf).votes


@register("selection_run_matrix")
def selection_run_matrix(spark, sf):
    return _selection(spark, sf).matrix


@register("recursive_elimination")
def recursive_elimination(spark, sf):
    train, _, features = prepared_parts(spark, sf)
    return model_selection.eliminate_features(train, features)


@register("elimination_curve")
def elimination_curve(spark, sf):
    train, val, features = prepared_parts(spark, sf)
    return model_selection.elimination_curve(train, val, features, _selection(spark, sf).ranking)


@register("wrapper_family")
def wrapper_family(spark, sf):
    run = _selection(spark, sf)
    return model_selection.wrapper_family(run.ranking, run.curve)


@register("lasso_coefficients")
def lasso_coefficients(spark, sf):
    train, _, features = prepared_parts(spark, sf)
    table = model_selection.penalised_coefficients(train, features, penalty="l1")
    kept = model_selection.lasso_features(table)
    return selection.keep_features(table, kept)


@register("ridge_reference")
def ridge_reference(spark, sf):
    train, val, features = prepared_parts(spark, sf)
    ridge = Classifier("LogisticRegression", {"penalty": "l2", "max_iter": 1000}, features)
    return experiments.evaluate_classifier(ridge, train, val)


@register("forest_importances_above_mean")
def forest_importances_above_mean(spark, sf):
    table = _selection(spark, sf).importances
    return selection.keep_features(table, model_selection.above_mean(table))


@register("principal_components")
def principal_components(spark, sf):
    train, _, features = prepared_parts(spark, sf)
    return model_selection.component_variances(train, features)


# Experiments ---------------------------------------------------------------------------------


def small_baselines() -> dict[str, dict]:
    """The two candidates that need few jobs, for the registered experiments."""
    return baseline_models(["Logistic Regression", "Decision Tree"])


@register("feature_set_scenarios")
def feature_set_scenarios(spark, sf):
    train, val = split_parts(spark, sf)
    return experiments.evaluate_feature_set("Baseline", train, val, small_baselines(), SCENARIOS)


@register("feature_scenario_comparison")
def feature_scenario_comparison(spark, sf):
    train, val = clean_parts(spark, sf)
    final = _selection(spark, sf).votes.where(F.col("method") == "consensus")
    selected = [r["feature"] for r in final.collect()]
    return experiments.compare_feature_scenarios(train, val, small_baselines(), selected)


@register("cross_validation_summary")
def cross_validation_summary(spark, sf):
    train, _, features = prepared_parts(spark, sf)
    return experiments.run_cross_validation(
        Classifier("DecisionTree", {"max_depth": 4}, features), train
    )


@register("cross_validated_models")
def cross_validated_models(spark, sf):
    train, _, features = prepared_parts(spark, sf)
    models = {
        "tree": Classifier("DecisionTree", {"max_depth": 3}, features),
        "bayes": Classifier("GaussianNB", {"var_smoothing": 1e-3}, features),
    }
    return experiments.compare_models(models, train)


@register("tuning_trials")
def tuning_trials(spark, sf):
    train, _ = clean_parts(spark, sf)
    return tuning.search("LogisticRegression", train).table(spark)


@register("tuning_trials_bayes")
def tuning_trials_bayes(spark, sf):
    train, _ = clean_parts(spark, sf)
    return tuning.search("GaussianNB", train).table(spark)


@register("tuning_trials_tree")
def tuning_trials_tree(spark, sf):
    train, _ = clean_parts(spark, sf)
    return tuning.search("DecisionTree", train, trials=3).table(spark)


@register("tuned_models")
def tuned_models(spark, sf):
    train, val = clean_parts(spark, sf)
    trials = {"LogisticRegression": 100, "GaussianNB": 100, "DecisionTree": 1}
    return tuning.train_all_models(list(trials), train, val, trials=trials)[0]


@register("final_fold_scores")
def final_fold_scores(spark, sf):
    train, val = clean_parts(spark, sf)
    return scoring.fold_scores(train, val)


@register("final_predictions")
def final_predictions(spark, sf):
    """The refit is on two halves of the training part; the rows scored are none of these."""
    train, val = clean_parts(spark, sf)
    halves = [train.where(F.col(ID_COLUMN) % 2 == k) for k in (0, 1)]
    return scoring.refit_and_score(*halves, val.drop(TARGET_COLUMN))[0]


# One person in four is held back as a table the stored chain has never seen.
_SEEN = "CONTROL_NUMBER % 4 <> 1"
_CHAIN_FEATURES = OUTLIER_COLUMNS


@register(
    "stored_chain_scores",
    with_persons(
        bayes_sql(
            _CHAIN_FEATURES,
            f"(SELECT * FROM tamed WHERE NOT ({_SEEN}))",
            f"(SELECT * FROM tamed WHERE {_SEEN})",
            "CONTROL_NUMBER",
            1e-3,
        ),
        *clean_stages_fitted(_SEEN),
    ),
)
def stored_chain_scores(spark, sf):
    """Cleaning and classifier, fitted on one part, stored, loaded again, and put to the unseen part."""
    people = person_frame(spark, sf)
    seen, unseen = people.where(_SEEN), people.where(f"NOT ({_SEEN})").drop(TARGET_COLUMN)
    path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/chain-{uuid.uuid4().hex}"
    scoring.fit_chain(seen, Classifier("GaussianNB", {"var_smoothing": 1e-3}, _CHAIN_FEATURES)).write().overwrite().save(path)
    return rounded(scoring.score_unseen(path, unseen))


@register("final_in_sample_report")
def final_in_sample_report(spark, sf):
    train, val = clean_parts(spark, sf)
    return scoring.refit_and_score(train, val, val.drop(TARGET_COLUMN))[1]


@register("validation_threshold_search")
def validation_threshold_search(spark, sf):
    train, val, features = prepared_parts(spark, sf)
    model = Classifier("LogisticRegression", {}, features).fit(train)
    return evaluation.best_f1_threshold(model.transform(val))
