"""Classifiers by name on named columns, all with the same output: ``score`` and ``prediction``.

Most kinds are Spark ML estimators. Parameters carry their usual tabular names and are mapped here; those without a
counterpart (leaf-node and split-size limits, solver choices, random split points, unlimited depth) are an error.
"""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.models.bayes import GaussianBayes
from proclivity.models.boosting import SammeBoost
from proclivity.models.neighbours import NearestNeighbours
from proclivity.operators.base import FittedStep, Step
from proclivity.operators.preprocessing import assemble
from proclivity.operators.splitting import balanced_weight, positive_weight
from proclivity.schema import ID_COLUMN, TARGET_COLUMN, require_columns

#: Depth of trees unless given: the deepest that Spark ML grows.
MAX_DEPTH = 30
_STRATEGY = {"sqrt": "sqrt", "log2": "log2", None: "all"}

# How each kind weighs the classes.
WEIGHTS = {
    "GradientBoosting": "positive",
    "LogisticRegression": "balanced",
    "AdaBoost": "balanced",
    "DecisionTree": "balanced",
    "RandomForestClassifier": "balanced",
    "ExtraTreesClassifier": "balanced",
    "GaussianNB": None,
    "KNeighborsClassifier": None,
    "MLPClassifier": None,
}


_TREE = {"criterion", "max_depth", "min_samples_split", "min_samples_leaf", "max_features"}
# Parameters each kind acts on; anything else is an error.
PARAMETERS = {
    "GradientBoosting": {"n_estimators", "learning_rate", "subsample", *_TREE} - {"criterion"},
    "LogisticRegression": {"C", "penalty", "max_iter", "fit_intercept"},
    "AdaBoost": {"n_estimators", "learning_rate", *_TREE} - {"max_features", "criterion"},
    "DecisionTree": _TREE,
    "RandomForestClassifier": {"n_estimators", "bootstrap", *_TREE},
    "ExtraTreesClassifier": {"n_estimators", "bootstrap", *_TREE},
    "GaussianNB": {"var_smoothing"},
    "KNeighborsClassifier": {"n_neighbors", "weights", "p"},
    "MLPClassifier": {"hidden_layer_sizes", "max_iter"},
}


def check_parameters(kind: str, p: dict) -> None:
    """Raises on parameters the kind would ignore, before any job runs.

    A split size is accepted only where it cannot act: each side of a split has ``min_samples_leaf`` rows anyway.
    """
    unknown = sorted(set(p) - PARAMETERS[kind])
    if unknown:
        raise ValueError(f"{kind} does not support {', '.join(unknown)}; choose from {sorted(PARAMETERS[kind])}")
    if p.get("min_samples_split", 2) > 2 * p.get("min_samples_leaf", 1):
        raise ValueError("min_samples_split beyond twice min_samples_leaf is not supported")
    if p.get("criterion", "gini") not in ("gini", "entropy", "log_loss"):
        raise ValueError(f"unknown criterion {p['criterion']!r}")
    if p.get("penalty", "l2") not in ("l1", "l2"):
        raise ValueError(f"unknown penalty {p['penalty']!r}")
    depth = p.get("max_depth", MAX_DEPTH)
    if isinstance(depth, bool) or not isinstance(depth, int) or not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"max_depth must be a whole number up to {MAX_DEPTH}; unlimited depth is not available")
    _subset(p.get("max_features"))


def _subset(value) -> str:
    """Spark ML's name of a feature subset: a rule, a whole number of features or a share of them."""
    if isinstance(value, bool) or not (value in _STRATEGY or isinstance(value, (int, float)) and value > 0):
        raise ValueError(f"unknown max_features {value!r}")
    if isinstance(value, float) and value > 1:
        raise ValueError("a share of features is at most 1")
    return _STRATEGY[value] if value in _STRATEGY else str(value)


def _tree_params(p: dict, seed: int) -> dict:
    return {
        "maxDepth": p.get("max_depth", MAX_DEPTH),
        "minInstancesPerNode": p.get("min_samples_leaf", 1),
        "seed": seed,
    }


def _impurity(p: dict) -> str:
    return "gini" if p.get("criterion", "gini") == "gini" else "entropy"


def _forest(p: dict, seed: int, bootstrap: bool, trees: int = 100) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=p.get("n_estimators", trees),
        impurity=_impurity(p),
        bootstrap=p.get("bootstrap", bootstrap),
        featureSubsetStrategy=_subset(p.get("max_features", "sqrt")),
        **_tree_params(p, seed),
    )


def _estimator(kind: str, p: dict, width: int, total_weight, seed: int):
    """The Spark ML estimator of a kind; ``total_weight`` gives the sum of row weights when the penalty needs it."""
    if kind == "LogisticRegression":
        # The penalty is set against the summed loss, Spark ML divides the loss by the sum of the weights.
        return LogisticRegression(
            regParam=1.0 / (p.get("C", 1.0) * total_weight()),
            elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0,
            maxIter=p.get("max_iter", 100),
            fitIntercept=p.get("fit_intercept", True),
            standardization=False,
        )
    if kind == "DecisionTree":
        if p.get("max_features") is None:
            return DecisionTreeClassifier(impurity=_impurity(p), **_tree_params(p, seed))
        # Feature subsets per node: a forest of one tree on all rows.
        return _forest({**p, "n_estimators": 1}, seed, bootstrap=False)
    if kind == "RandomForestClassifier":
        return _forest(p, seed, bootstrap=True)
    if kind == "ExtraTreesClassifier":
        return _forest(p, seed, bootstrap=False)
    if kind == "GradientBoosting":
        return GBTClassifier(
            maxIter=p.get("n_estimators", 100),
            stepSize=p.get("learning_rate", 0.1),
            subsamplingRate=p.get("subsample", 1.0),
            featureSubsetStrategy=_subset(p.get("max_features")),
            **_tree_params({"max_depth": 3, **p}, seed),
        )
    if kind == "MLPClassifier":
        hidden = list(p.get("hidden_layer_sizes", (100,)))
        return MultilayerPerceptronClassifier(
            layers=[width, *hidden, 2], maxIter=p.get("max_iter", 200), seed=seed
        )
    raise ValueError(f"unknown model {kind!r}")


#: Kinds that read the feature columns by name; the others read one assembled vector.
NAMED = {"GaussianNB", "KNeighborsClassifier"}


class Classifier(Step):
    """``build_model(kind, params)`` bound to feature columns and a 0/1 target."""

    def __init__(
        self,
        kind: str,
        params: dict | None = None,
        features: list[str] | None = None,
        target: str = TARGET_COLUMN,
        key: str = ID_COLUMN,
        weighting: str | None = "default",
        seed: int = 1,
    ):
        super().__init__()
        if kind not in WEIGHTS:
            raise ValueError(f"unknown model {kind!r}; choose from {sorted(WEIGHTS)}")
        if weighting not in ("default", "balanced", "positive", None):
            raise ValueError(f"unknown weighting {weighting!r}")
        self.kind = kind
        self.settings = dict(params or {})
        check_parameters(kind, self.settings)
        self.features = features
        self.target = target
        self.key = key
        self.weighting = WEIGHTS[kind] if weighting == "default" else weighting
        self.seed = seed

    def on(self, features: list[str]) -> Classifier:
        """The same model for other feature columns."""
        return Classifier(
            self.kind, self.settings, features, self.target, self.key, self.weighting, self.seed
        )

    def _fit(self, df: DataFrame) -> ClassifierModel:
        features = self.features or [c for c in df.columns if c not in (self.key, self.target)]
        require_columns(df, [*features, self.target])
        rows = df.where(col(self.target).isNotNull()).select(
            col(self.target).cast("double").alias("label"), *[col(c) for c in features]
        )
        if self.kind == "GaussianNB":
            smoothing = self.settings.get("var_smoothing", 1e-9)
            return ClassifierModel(GaussianBayes(features, smoothing).fit(rows), features, named=True)
        if self.kind == "KNeighborsClassifier":
            p = self.settings
            step = NearestNeighbours(
                features, p.get("n_neighbors", 5), p.get("weights", "uniform"), p.get("p", 2)
            )
            return ClassifierModel(step.fit(rows), features, named=True)
        rows = self._weighted(rows)
        return self._fit_frame(assemble(rows, features), rows, features)

    def fit_vectors(self, vectors: DataFrame, features: list[str], sizes: dict) -> ClassifierModel:
        """The same fit on columns ``label`` and ``features``, the latter assembled; ``sizes`` are the rows by class."""
        rows = self._weighted(vectors.select("label", "features"), sizes)
        return self._fit_frame(rows, rows, features)

    def _weighted(self, rows: DataFrame, sizes: dict | None = None) -> DataFrame:
        if self.weighting == "balanced":
            return balanced_weight(rows, "label", "weight", sizes)
        if self.weighting == "positive":
            return positive_weight(rows, "label", "weight", sizes)
        return rows

    def _fit_frame(self, frame: DataFrame, rows: DataFrame, features: list[str]) -> ClassifierModel:
        if self.kind == "AdaBoost":
            return ClassifierModel(SammeBoost(self.settings, self.seed).fit(frame), features)

        def total_weight() -> float:
            if "weight" not in rows.columns:
                return float(rows.count())
            return rows.agg(F.sum("weight")).first()[0]

        estimator = _estimator(self.kind, self.settings, len(features), total_weight, self.seed)
        if "weight" in frame.columns and estimator.hasParam("weightCol"):
            estimator = estimator.copy({estimator.getParam("weightCol"): "weight"})
        return ClassifierModel(estimator.fit(frame), features)


class ClassifierModel(FittedStep):
    """Adds ``score`` (probability of 1) and ``prediction``; feature columns are dropped.

    ``named`` models read the feature columns by name, others one assembled vector.
    """

    parts = ("model",)

    def __init__(self, model, features: list[str], named: bool = False):
        super().__init__({"features": features, "named": named})
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        features = self.state["features"]
        require_columns(df, features, error=KeyError)
        kept = [c for c in df.columns if c not in set(features)]
        scored = self.model.transform(df if self.state["named"] else assemble(df, features))
        if "score" not in scored.columns:
            scored = scored.withColumn("score", F.get(vector_to_array("probability"), 1))
        return scored.select(
            *[col(c) for c in kept], "score", F.col("prediction").cast("int").alias("prediction")
        )


def build_model(kind: str, params: dict | None = None, **options) -> Classifier:
    """Unfitted classifier by name; an unknown name is an error."""
    return Classifier(kind, params, **options)


# The baseline classifiers and the family their inputs are prepared for.
BASELINES = {
    "Logistic Regression": ("linear", "LogisticRegression", {"max_iter": 1000}),
    "Random Forest": ("tree", "RandomForestClassifier", {"n_estimators": 300}),
    "Decision Tree": ("tree", "DecisionTree", {"max_depth": 8, "min_samples_leaf": 20}),
    "Extra Trees": ("tree", "ExtraTreesClassifier", {"n_estimators": 300}),
    "Gradient Boosting": ("tree", "GradientBoosting", {}),
}


def baseline_models(names: list[str] | None = None, seed: int = 5) -> dict[str, dict]:
    """``{name: {"family", "estimator"}}``; boosting is unweighted here as in the comparison."""
    return {
        name: {
            "family": family,
            "estimator": Classifier(
                kind,
                params,
                weighting=None if kind == "GradientBoosting" else "default",
                seed=seed,
            ),
        }
        for name, (family, kind, params) in BASELINES.items()
        if names is None or name in names
    }
