"""Evaluation of classifiers over preparation scenarios and feature sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.operators.evaluation import fold_summary, probability_metrics
from proclivity.operators.features import add_engineered_features
from proclivity.operators.preprocessing import Preprocessor, fit_families, keep_named, prepare_modeling_frame
from proclivity.operators.reshape import stack_results, with_gaps
from proclivity.operators.splitting import stratified_folds
from proclivity.plans.shared_fits import fold_scores
from proclivity.schema import TARGET_COLUMN
from proclivity.session import materialize

METRIC_NAMES = ("threshold", "accuracy", "precision", "recall", "f1", "roc_auc")


def prepared_pair(
    train: DataFrame, validation: DataFrame, family: str, drop_high_missing: bool = True
):
    """Preparation fitted on train, applied to both, written for the fits that follow."""
    model = Preprocessor(family, drop_high_missing).fit(train)
    return (
        model,
        materialize(model.transform(train), "prepared"),
        materialize(model.transform(validation), "prepared"),
    )


def prepared_families(
    train: DataFrame, validation: DataFrame, families: set[str], drop_high_missing: bool = True
) -> dict:
    """``prepared_pair`` of each family; what the families have in common is fitted once."""
    models = fit_families(train, sorted(families), drop_high_missing)
    return {
        family: (
            model,
            materialize(model.transform(train), "prepared"),
            materialize(model.transform(validation), "prepared"),
        )
        for family, model in models.items()
    }


def evaluate_classifier(
    classifier,
    train: DataFrame,
    validation: DataFrame,
    threshold: float = 0.5,
    train_metrics: bool = False,
    target: str = TARGET_COLUMN,
) -> DataFrame:
    """One row of validation metrics, with ``train_roc_auc`` and ``train_f1`` when asked."""
    model = classifier.fit(train)

    def scored(df: DataFrame, part: str) -> DataFrame:
        return model.transform(df).select(F.lit(part).alias("part"), target, "score")

    if not train_metrics:
        rows = scored(validation, "val")
    else:
        rows = scored(validation, "val").unionByName(scored(train, "train"))
    table = probability_metrics(rows, "score", target, threshold, by=["part"])
    columns = [F.max(F.when(F.col("part") == "val", F.col(m))).alias(m) for m in METRIC_NAMES]
    if train_metrics:
        columns += [
            F.max(F.when(F.col("part") == "train", F.col(m))).alias(f"train_{m}")
            for m in ("roc_auc", "f1")
        ]
    return table.agg(*columns)


def evaluate_feature_set(
    name: str,
    train: DataFrame,
    validation: DataFrame,
    models: dict[str, dict],
    scenarios: list[dict],
) -> DataFrame:
    """One row per scenario and model; a preparation is fitted once per scenario and family."""
    rows = []
    for s in scenarios:
        as_text = s["income_group_as_categorical"]
        drop = s["drop_high_missing_features"]
        left = prepare_modeling_frame(train, as_text)
        right = prepare_modeling_frame(validation, as_text)
        prepared = prepared_families(left, right, {m["family"] for m in models.values()}, drop)
        for model_name, config in models.items():
            step, a, b = prepared[config["family"]]
            groups = step.groups
            metrics = evaluate_classifier(config["estimator"].on(step.outputs), a, b)
            dropped = ", ".join(groups["dropped_high_missing_features"]) or "None"
            labels = {
                "feature_set": name,
                "scenario_name": s["scenario_name"],
                "model": model_name,
                "model_family": config["family"],
                "income_group_role": "categorical" if as_text else "numeric",
                "wealth_rating_strategy": "drop_if_missing_ge_40pct" if drop else "keep_with_imputation",
                "n_continuous_numeric_features": len(groups["continuous_numeric_features"]),
                "n_coded_numeric_features": len(groups["coded_numeric_features"]),
                "n_categorical_features": len(groups["categorical_features"]),
                "dropped_high_missing": dropped,
            }
            rows.append(_labelled(metrics, labels))
    return _results(train, rows)


def _labelled(metrics: DataFrame, labels: dict) -> DataFrame:
    return metrics.select(*[F.lit(v).alias(k) for k, v in labels.items()], *metrics.columns)


def _results(df: DataFrame, rows: list[DataFrame]) -> DataFrame:
    # Each part is one row; fetching them keeps the models out of the plan of the result.
    schema = stack_results(rows).schema
    collected = [r for part in rows for r in part.collect()]
    return df.sparkSession.createDataFrame(
        [tuple(r.asDict().get(n) for n in schema.names) for r in collected], schema
    ).orderBy(F.desc("roc_auc"), "model")


def compare_feature_scenarios(
    train: DataFrame,
    validation: DataFrame,
    models: dict[str, dict],
    selected: list[str],
) -> DataFrame:
    """Every model on raw columns, with derived ones, and with derived and selected ones."""
    rows = []
    for scenario in ("raw", "+FE", "+FE+FS"):
        left, right = (
            (train, validation)
            if scenario == "raw"
            else (add_engineered_features(train), add_engineered_features(validation))
        )
        prepared = prepared_families(left, right, {m["family"] for m in models.values()})
        for name, config in models.items():
            step, a, b = prepared[config["family"]]
            features = list(step.outputs)
            if scenario == "+FE+FS":
                a, b = keep_named(a, selected), keep_named(b, selected)
                features = [c for c in features if c in a.columns]
                if not features:
                    continue
            metrics = evaluate_classifier(
                config["estimator"].on(features), a, b, train_metrics=True
            )
            labels = {
                "scenario": scenario,
                "model": name,
                "model_family": config["family"],
                "n_features_kept": len(features),
            }
            rows.append(_labelled(metrics, labels))
    return with_gaps(_results(train, rows))


def _folded(df: DataFrame, folds: int, target: str, key: str, seed: int) -> DataFrame:
    return materialize(stratified_folds(df, folds, target, key, seed, "__fold"), "folds")


def cross_validated_scores(
    classifier, df: DataFrame, folds: int = 5, target: str = TARGET_COLUMN, seed: int = 1
) -> DataFrame:
    """``(fold, target, score, prediction)`` of every row, scored by the model of the other folds.

    The folds are fitted together where the classifier allows it (see ``shared_fits``)."""
    return fold_scores(classifier, _folded(df, folds, target, classifier.key, seed), folds)


def run_cross_validation(
    classifier, df: DataFrame, folds: int = 5, target: str = TARGET_COLUMN, seed: int = 42
) -> DataFrame:
    """One row with mean and deviation of the five metrics over stratified folds."""
    return _fold_metrics(cross_validated_scores(classifier, df, folds, target, seed), target)


def _fold_metrics(scores: DataFrame, target: str) -> DataFrame:
    return fold_summary(probability_metrics(scores, "score", target, by=["fold"]))


def compare_models(
    models: dict, df: DataFrame, folds: int = 5, target: str = TARGET_COLUMN, seed: int = 42
) -> DataFrame:
    """Cross-validated metrics of each model, best area first; models of one key share the written folds."""
    folded = {key: _folded(df, folds, target, key, seed) for key in {m.key for m in models.values()}}
    rows = [
        _labelled(_fold_metrics(fold_scores(m, folded[m.key], folds), target), {"model": name})
        for name, m in models.items()
    ]
    schema = rows[0].schema
    collected = [tuple(r) for part in rows for r in part.collect()]
    return df.sparkSession.createDataFrame(collected, schema).orderBy(
        F.desc("roc_auc_mean"), "model"
    )
