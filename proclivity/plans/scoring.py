"""Final model: cross-validation, refit on all labelled rows, batch scoring of the test rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.models.classifiers import build_model
from proclivity.operators.evaluation import probability_metrics
from proclivity.operators.preprocessing import Preprocessor, align_columns
from proclivity.operators.reshape import stack_results
from proclivity.plans.cleaning_chain import CleaningChain
from proclivity.plans.experiments import cross_validated_scores
from proclivity.schema import ID_COLUMN, TARGET_COLUMN
from proclivity.session import written
from proclivity.sources.files import build_submission

# The chosen model and its parameters.
FINAL_KIND = "DecisionTree"
FINAL_PARAMS = {
    "max_depth": 3,
    "min_samples_split": 9,
    "min_samples_leaf": 26,
    "max_features": "sqrt",
}


def final_model(kind: str = FINAL_KIND, params: dict | None = None):
    """The chosen model, with positives weighted by negatives over positives."""
    return build_model(kind, FINAL_PARAMS if params is None else params, weighting="positive")


def fold_scores(train: DataFrame, validation: DataFrame, model=None, folds: int = 5) -> DataFrame:
    """``(fold, f1…)`` of the model over stratified folds of all labelled rows."""
    rows = stack_results([train, validation])
    scores = cross_validated_scores(model or final_model(), rows, folds)
    return probability_metrics(scores, by=["fold"])


def refit_and_score(
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    model=None,
    key: str = ID_COLUMN,
    target: str = TARGET_COLUMN,
) -> tuple[DataFrame, DataFrame]:
    """``(submission, in_sample_report)``.

    The report is on validation rows the refit has seen, hence labelled in-sample.
    """
    fitted = (model or final_model()).fit(stack_results([train, validation]))
    features = fitted.state["features"]
    submission = build_submission(fitted.transform(align_columns(test, [key, *features])))
    report = probability_metrics(fitted.transform(validation)).withColumn(
        "sample", F.lit("in-sample")
    )
    return submission, report


def fit_chain(
    train: DataFrame,
    classifier=None,
    cleaning: CleaningChain | None = None,
    family: str | None = None,
    target: str = TARGET_COLUMN,
) -> PipelineModel:
    """Cleaning, optionally the preparation of a model family, and a classifier, fitted one on the other's output.

    The result holds all that scoring needs: ``write().save(path)`` stores it, ``PipelineModel.load(path)`` reads it in
    any application that sees the path. A classifier without features takes all columns but key and target.
    """
    steps = [(cleaning or CleaningChain(encode="onehot")).fit(train)]
    current = steps[0].transform(train)
    if family is not None:
        steps.append(Preprocessor(family).fit(current))
        current = steps[-1].transform(current)
    with written(current, "chain-train") as rows:
        steps.append((classifier or final_model()).fit(rows))
    return PipelineModel(steps)


def score_unseen(chain: PipelineModel | str, rows: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """``(key, score, prediction)`` of rows without target, by a fitted chain or the path of a stored one."""
    model = PipelineModel.load(chain) if isinstance(chain, str) else chain
    return model.transform(rows).select(col(key), "score", "prediction")
