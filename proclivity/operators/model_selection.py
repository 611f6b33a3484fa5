"""Model-based feature selection: elimination, penalties, importances, components."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.models.newton import Fit, fit_together, packed, scores_of, training_rows, without
from proclivity.operators.evaluation import first_reaching, roc_auc
from proclivity.operators.preprocessing import assemble
from proclivity.operators.splitting import balanced_weight
from proclivity.schema import TARGET_COLUMN
from proclivity.session import written


#: The deepest trees Spark ML grows.
MAX_DEPTH = 30
#: Rounds of an elimination that are fitted together.
AHEAD = 8


def _training_vectors(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """``(label, weight, features)`` with balanced weights."""
    rows = balanced_weight(df, target, "__weight")
    frame = assemble(
        rows.select(
            col(target).cast("double").alias("__label"), "__weight", *[col(c) for c in features]
        ),
        features,
        "__features",
    )
    return frame


def _logistic(rows: int, penalty: str = "l2", c: float = 1.0, max_iter: int = 1000):
    # Balanced weights sum up to the number of rows.
    return LogisticRegression(
        featuresCol="__features",
        labelCol="__label",
        weightCol="__weight",
        regParam=1.0 / (c * rows),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False,
        maxIter=max_iter,
    )


def eliminate_features(
    df: DataFrame,
    features: list[str],
    target: str = TARGET_COLUMN,
    step: int = 1,
    max_iter: int = 1000,
) -> DataFrame:
    """``(feature, ranking)``: drop the smallest squared coefficient and refit, down to one.

    Rank 1 is the feature kept longest. ``step`` features go at a time. Rounds share their passes over the written rows:
    a fit's second derivatives foresee which features go in the next ``AHEAD`` rounds, these are fitted together, and
    counted up to the first whose features turn out to be others. So ranks are those of one round after another.
    """
    with written(packed(training_rows(df, features, target)), "elimination") as rows:
        rank, _ = _eliminate(rows, features, step, max_iter)
    return _ranking_frame(df.sparkSession, rank)


def _eliminate(rows: DataFrame, features: list[str], step: int, max_iter: int, ahead: int = AHEAD) -> tuple[dict[str, int], int]:
    """Rank of each feature, and the number of passes."""
    if not features:
        raise ValueError("at least one feature is needed")
    fit, rank = Fit(range(len(features))), {}
    passes = 0 if len(features) == 1 else fit_together(rows, [fit], len(features), max_iter=max_iter)
    while len(fit.columns) > 1:
        if not fit.converged:
            raise ArithmeticError(f"the fit on {len(fit.columns)} features needs more than {max_iter} passes")
        guesses, last = [], fit
        while len(last.columns) > 1 and len(guesses) < ahead:
            gone = _smallest(last, step)
            last = without(last, gone)
            guesses.append((gone, last))
        # The last feature needs no fit.
        going = [g for _, g in guesses if len(g.columns) > 1]
        if going:
            passes += fit_together(rows, going, len(features), max_iter=max_iter)
        for gone, following in guesses:
            if not fit.converged or set(_smallest(fit, step)) != set(gone):
                break
            # One rank per round: the round's features share it, the next round ranks above.
            rank |= {features[fit.columns[i]]: len(fit.columns) - len(gone) + 1 for i in gone}
            fit = following
    rank[features[fit.columns[0]]] = 1
    return rank, passes


def _smallest(fit: Fit, step: int) -> list[int]:
    """Places in ``fit.columns`` of the coefficients that go next: the smallest squares, all but one at most."""
    order = sorted(range(len(fit.columns)), key=lambda i: (float(fit.coefficients[i]) ** 2, fit.columns[i]))
    return order[: min(step, len(fit.columns) - 1)]


def _ranking_frame(spark, rank: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(rank.items()), "feature string, ranking int")


def elimination_curve(
    train: DataFrame,
    validation: DataFrame,
    features: list[str],
    ranking: DataFrame,
    target: str = TARGET_COLUMN,
    every: int = 5,
    max_iter: int = 1000,
) -> DataFrame:
    """``(n_features, score)``: validation area of a refit on the best n features.

    All sizes are fitted together: the passes over the rows do not grow with the number of sizes.
    """
    ranks = {r["feature"]: r["ranking"] for r in ranking.collect()}
    sizes = list(range(every, len(features) + 1, every))
    if not sizes or sizes[-1] != len(features):
        sizes.append(len(features))
    fits = [Fit([i for i, f in enumerate(features) if ranks[f] <= n]) for n in sizes]
    with written(packed(training_rows(train, features, target)), "curve") as rows:
        fit_together(rows, fits, len(features), max_iter=max_iter)
    scored = scores_of(training_rows(validation, features, target), fits, len(features))
    areas = roc_auc(scored, "score", "y", by=["fit"])
    names = train.sparkSession.createDataFrame(list(enumerate(sizes)), "fit int, n_features int")
    return areas.join(names, "fit").select("n_features", F.col("roc_auc").alias("score")).orderBy("n_features")


def wrapper_family(ranking: DataFrame, curve: DataFrame) -> DataFrame:
    """Features within the size at which the curve has its first maximum."""
    best = curve.orderBy(F.desc("score"), "n_features").first()["n_features"]
    return ranking.where(F.col("ranking") <= best).select("feature")


def penalised_coefficients(
    df: DataFrame,
    features: list[str],
    target: str = TARGET_COLUMN,
    penalty: str = "l1",
    c: float = 1.0,
    max_iter: int = 1000,
) -> DataFrame:
    """``(feature, coefficient)`` of a balanced logistic model with an L1 or L2 penalty."""
    with written(_training_vectors(df, features, target), "vectors") as frame:
        model = _logistic(frame.count(), penalty, c, max_iter).fit(frame)
    rows = [(f, float(w)) for f, w in zip(features, model.coefficients, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def lasso_features(coefficients: DataFrame) -> DataFrame:
    return coefficients.where(F.col("coefficient") != 0).select("feature")


def forest_importances(
    df: DataFrame,
    features: list[str],
    target: str = TARGET_COLUMN,
    trees: int = 300,
    max_depth: int = MAX_DEPTH,
    seed: int = 5,
) -> DataFrame:
    """``(feature, importance)`` of a balanced forest, largest first; trees are as deep as Spark ML grows them."""
    forest = RandomForestClassifier(
        featuresCol="__features",
        labelCol="__label",
        weightCol="__weight",
        numTrees=trees,
        maxDepth=max_depth,
        seed=seed,
    )
    with written(_training_vectors(df, features, target), "vectors") as frame:
        model = forest.fit(frame)
    weights = model.featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(features, weights, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def above_mean(importances: DataFrame) -> DataFrame:
    """Features whose importance exceeds the mean; the table has one row per feature."""
    mean = importances.agg(F.avg("importance").alias("m")).first()["m"]
    return importances.where(F.col("importance") > F.lit(mean)).select("feature")


def component_variances(
    df: DataFrame, features: list[str], threshold: float = 0.95
) -> DataFrame:
    """Cumulative explained variance per component and the number that reaches the threshold."""
    vectors = assemble(df.select(*[col(c) for c in features]), features)
    model = PCA(k=len(features), inputCol="features", outputCol="pc").fit(vectors)
    shares = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    table = df.sparkSession.createDataFrame(shares, "component int, share double")
    return first_reaching(table, "component", "share", threshold)
