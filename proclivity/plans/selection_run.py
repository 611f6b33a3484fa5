"""A whole feature selection: filters, elimination, penalties and importances, their votes, and the final choice."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.operators import model_selection, profiling, selection
from proclivity.operators.correlation import spearman_with_target
from proclivity.operators.reshape import stack_results
from proclivity.schema import TARGET_COLUMN
from proclivity.sources.files import write_selection


@dataclass
class SelectionRun:
    """Tables of a selection: one row per feature (and method or size) each."""

    variances: DataFrame
    correlations: DataFrame
    anova: DataFrame
    ranking: DataFrame
    curve: DataFrame
    lasso: DataFrame
    importances: DataFrame
    #: ``(method, feature)`` of the six signals, and of the families, their parts and the consensus.
    signals: DataFrame
    votes: DataFrame
    #: One row per feature: Keep or Discard per signal, and the final decision.
    matrix: DataFrame


def _as(method: str, frame: DataFrame) -> DataFrame:
    return frame.select(F.lit(method).alias("method"), "feature")


def select_features(
    train: DataFrame,
    validation: DataFrame,
    features: list[str],
    target: str = TARGET_COLUMN,
    step: int = 1,
    every: int = 5,
    max_iter: int = 1000,
    c: float = 1.0,
    trees: int = 300,
    max_depth: int = model_selection.MAX_DEPTH,
    at_least: int = 2,
    path: str | None = None,
) -> SelectionRun:
    """Runs all families on prepared, null-free features and lets them vote.

    Filter: Spearman or ANOVA with the target, unless near-constant. Wrapper: elimination down to the size whose refit
    has the best validation area. Embedded: L1 coefficients that are not zero, or forest importances above their mean.
    A feature stays with ``at_least`` families for it. With ``path`` the lists are written there as one JSON object.
    """
    spark = train.sparkSession
    variances = profiling.variances(train, features)
    correlations = spearman_with_target(train, features, target)
    anova = selection.anova_test(train, features, target)
    ranking = model_selection.eliminate_features(train, features, target, step, max_iter)
    curve = model_selection.elimination_curve(train, validation, features, ranking, target, every, max_iter)
    # One row per size: written down so that the choices below do not score the validation rows again.
    curve = spark.createDataFrame(curve.collect(), "n_features int, score double")
    lasso = model_selection.penalised_coefficients(train, features, target, "l1", c, max_iter)
    importances = model_selection.forest_importances(train, features, target, trees, max_depth)

    varied = selection.drop_features(
        selection.names(spark, features), variances.where(F.col("variance") < selection.VARIANCE_THRESHOLD)
    )
    by_lasso, by_tree = model_selection.lasso_features(lasso), model_selection.above_mean(importances)
    wrapper = model_selection.wrapper_family(ranking, curve)
    found = {
        "Variance": varied,
        "Spearman": correlations.where(F.abs("correlation") >= selection.CORRELATION_THRESHOLD),
        "ANOVA": anova.where(F.col("p_value") < selection.P_VALUE_THRESHOLD),
        "RFE": wrapper,
        "Lasso": by_lasso,
        "Random Forest": by_tree,
    }
    signals = _kept(stack_results([_as(name, frame) for name, frame in found.items()]))

    def of(name: str) -> DataFrame:
        return signals.where(F.col("method") == name)

    associated = selection.union_names(of("Spearman"), of("ANOVA"))
    families = stack_results([
        _as("filter", selection.keep_features(associated, of("Variance"))),
        _as("wrapper", of("RFE")),
        _as("embedded", selection.embedded_family(of("Lasso"), of("Random Forest"))),
    ])
    final = selection.consensus(families, at_least)
    parts = [_as("embedded_lasso", of("Lasso")), _as("embedded_tree", of("Random Forest")), _as("consensus", final)]
    votes = _kept(stack_results([families, *parts]))
    matrix = selection.decision_matrix(selection.names(spark, features), signals, votes.where(F.col("method") == "consensus"))
    if path is not None:
        write_selection(votes, path)
    return SelectionRun(variances, correlations, anova, ranking, curve, lasso, importances, signals, votes, matrix)


def _kept(votes: DataFrame) -> DataFrame:
    """A small table of names as it is now: at most one row per method and feature."""
    return votes.sparkSession.createDataFrame(votes.distinct().collect(), "method string, feature string")
