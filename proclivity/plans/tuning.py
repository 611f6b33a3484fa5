"""Hyperparameter search by cross-validated F1, and the table over all tuned models.

Parameter sets are drawn on the driver by a seeded generator from declared ranges. Trials are stopped by successive
halving on growing shares of the rows, or fitted all together where the kind allows it.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.models.classifiers import NAMED, build_model
from proclivity.operators.evaluation import COUNTS, evaluate_classification
from proclivity.operators.splitting import split_share, stratified_folds
from proclivity.plans.shared_fits import WHOLE, fold_scores, separate_confusions, shared_confusions, shares_passes
from proclivity.schema import ID_COLUMN, TARGET_COLUMN
from proclivity.session import written

# Searched ranges. ("int", low, high), ("float", low, high), ("log", low, high),
# ("power", low exponent, high exponent) and ("one", choices).
_FOREST_SPACE = {
    "n_estimators": ("int", 100, 500),
    "criterion": ("one", ["gini", "entropy", "log_loss"]),
    "max_depth": ("int", 3, 15),
    "min_samples_leaf": ("int", 1, 15),
    "bootstrap": ("one", [True, False]),
    "max_features": ("one", ["sqrt", "log2"]),
}
SPACES: dict[str, dict] = {
    "GradientBoosting": {
        "n_estimators": ("int", 50, 400),
        "learning_rate": ("log", 0.01, 0.3),
        "subsample": ("float", 0.5, 1.0),
        "max_features": ("one", ["sqrt", "log2", None]),
        "max_depth": ("int", 2, 5),
        "min_samples_leaf": ("int", 1, 10),
    },
    "LogisticRegression": {
        "C": ("log", 0.001, 10.0),
        "max_iter": ("int", 200, 1000),
        "fit_intercept": ("one", [True, False]),
    },
    "AdaBoost": {
        "max_depth": ("int", 1, 4),
        "min_samples_leaf": ("int", 1, 8),
        "n_estimators": ("int", 50, 300),
        "learning_rate": ("log", 0.01, 1.0),
    },
    "DecisionTree": {
        "max_depth": ("int", 3, 10),
        "min_samples_leaf": ("int", 5, 30),
        "max_features": ("one", ["sqrt", "log2", None]),
    },
    "RandomForestClassifier": _FOREST_SPACE,
    "ExtraTreesClassifier": _FOREST_SPACE,
    "KNeighborsClassifier": {
        "n_neighbors": ("int", 3, 30),
        "weights": ("one", ["uniform", "distance"]),
        "p": ("int", 1, 2),
    },
    "GaussianNB": {"var_smoothing": ("power", -9, -1)},
    "MLPClassifier": {
        "hidden_layer_sizes": ("one", [(64,), (128,), (64, 32), (128, 64), (128, 64, 32)]),
        "max_iter": ("int", 200, 1000),
    },
}


def draw(space: dict, generator: random.Random) -> dict:
    """One parameter set."""
    out = {}
    for name, rule in space.items():
        how, *args = rule
        if how == "int":
            out[name] = generator.randint(*args)
        elif how == "float":
            out[name] = generator.uniform(*args)
        elif how == "log":
            out[name] = math.exp(generator.uniform(math.log(args[0]), math.log(args[1])))
        elif how == "power":
            out[name] = 10 ** generator.uniform(*args)
        else:
            out[name] = generator.choice(args[0])
    return out


@dataclass
class Study:
    """All trials of a search: parameters, the share of the rows that a trial got to, fold mean F1 and training F1.

    Only trials that got to all rows can win.
    """

    kind: str
    trials: list[dict] = field(default_factory=list)

    @property
    def best(self) -> dict:
        return max((t for t in self.trials if t["share"] == 1.0), key=lambda t: (t["f1"], -t["trial"]))

    def table(self, spark) -> DataFrame:
        rows = [
            (self.kind, t["trial"], t["share"], t["f1"], t["train_f1"], {k: str(v) for k, v in t["params"].items()})
            for t in self.trials
        ]
        return spark.createDataFrame(
            rows,
            "model string, trial int, share double, f1 double, train_f1 double, parameters map<string,string>",
        )


def objective(
    kind: str,
    params: dict,
    folded: DataFrame,
    folds: int = 5,
    target: str = TARGET_COLUMN,
    parallelism: int | None = None,
) -> tuple[float, float]:
    """Mean F1 over the folds in ``__fold``, and F1 of a fit on all rows on those rows."""
    return objectives(kind, [params], folded, folds, target, parallelism)[0]


def objectives(
    kind: str,
    parameter_sets: list[dict],
    folded: DataFrame,
    folds: int = 5,
    target: str = TARGET_COLUMN,
    parallelism: int | None = None,
) -> list[tuple[float, float]]:
    """``objective`` of many parameter sets.

    Fits that are sums over rows (see ``shared_fits``) are made together, for all sets and folds; others one by one,
    some at a time, from vectors assembled once for all of them.
    """
    models = [build_model(kind, p, target=target) for p in parameter_sets]
    if models and shares_passes(models[0]):
        counts = shared_confusions(models, folded, folds)
    elif models and models[0].kind not in NAMED:
        counts = separate_confusions(models, folded, folds, parallelism=parallelism)
    else:
        counts = [_separate_confusions(m, folded, folds, target, parallelism) for m in models]
    return [(sum(map(_f1, c[:-1])) / folds, _f1(c[-1])) for c in counts]


def _f1(counts: tuple[int, int, int, int]) -> float:
    _, fp, fn, tp = counts
    return 2 * tp / (2 * tp + fp + fn) if tp else 0.0


def _separate_confusions(model, folded: DataFrame, folds: int, target: str, parallelism: int | None) -> list[tuple]:
    """``(tn, fp, fn, tp)`` of each fold and, last, of the fit on all rows."""
    scored = fold_scores(model, folded, folds, whole=True, parallelism=parallelism or 2)
    hit, wish = F.col("prediction") == 1, F.col(target) == 1
    counts = scored.groupBy("fold").agg(
        *[F.count_if(c).alias(n) for n, c in zip(COUNTS, (~hit & ~wish, hit & ~wish, ~hit & wish, hit & wish), strict=True)]
    )
    found = {r["fold"]: tuple(r[n] for n in COUNTS) for r in counts.collect()}
    return [found.get(i, (0, 0, 0, 0)) for i in [*range(folds), WHOLE]]


def rungs(rows: int, trials: int, keep: int = 3, least_rows: int = 1000) -> list[float]:
    """Growing shares of the rows, ending with all: each ``keep`` times the last, the first with ``least_rows`` at least."""
    shares = [1.0]
    while len(shares) < 8 and trials >= keep ** len(shares) and rows * shares[0] / keep >= least_rows:
        shares.insert(0, shares[0] / keep)
    return shares


def search(
    kind: str,
    train: DataFrame,
    trials: int = 100,
    folds: int = 5,
    target: str = TARGET_COLUMN,
    seed: int = 1,
    parallelism: int | None = None,
    space: dict | None = None,
    key: str = ID_COLUMN,
    keep: int = 3,
    least_rows: int = 1000,
) -> Study:
    """Random search by successive halving; the same seed gives the same study.

    Folds are assigned and written once. All trials are measured on a share of the rows drawn by hash; the best
    ``1 / keep`` of them go on to the next larger share, and those that are left are measured on all rows, one of which
    wins. Kinds whose fits share passes measure all trials on all rows at once, as the number of passes is the same.
    """
    drawn = stratified_folds(train.where(F.col(target).isNotNull()), folds, target, column="__fold")
    with written(drawn.withColumn("__share", split_share(key, seed)), "folds") as folded:
        generator = random.Random(seed)
        study = Study(kind, [{"trial": i, "params": draw(space or SPACES[kind], generator)} for i in range(trials)])
        together = shares_passes(build_model(kind, {}, target=target))
        shares = [1.0] if together else rungs(folded.count(), trials, keep, least_rows)
        going = list(study.trials)
        for n, share in enumerate(shares):
            rows = (folded if share == 1.0 else folded.where(F.col("__share") < share)).drop("__share")
            scores = objectives(kind, [t["params"] for t in going], rows, folds, target, parallelism)
            for trial, (f1, train_f1) in zip(going, scores, strict=True):
                trial |= {"share": share, "f1": f1, "train_f1": train_f1}
            if n + 1 < len(shares):
                going = sorted(going, key=lambda t: (-t["f1"], t["trial"]))[: max(1, -(-len(going) // keep))]
    return study


def train_all_models(
    kinds: list[str] | None,
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame | None = None,
    trials: int | dict[str, int] = 100,
    target: str = TARGET_COLUMN,
    spaces: dict[str, dict] | None = None,
    folds: int = 5,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``(model, parameters, f1, accuracy, precision, recall)`` by F1, and predictions per model.

    Each kind (all nine by default) is searched with ``trials`` trials, or as many as a dictionary names for it (100
    otherwise), refitted on all training rows and measured on the validation rows.
    """
    spark = train.sparkSession
    rows, predictions = [], {}
    for kind in kinds or SPACES:
        number = trials.get(kind, 100) if isinstance(trials, dict) else trials
        study = search(kind, train, number, folds, target, space=(spaces or {}).get(kind))
        params = study.best["params"]
        model = build_model(kind, params).fit(train)
        got = evaluate_classification(model.transform(validation), "prediction", target).first()
        rows.append(
            (
                kind,
                {k: str(v) for k, v in params.items()},
                *[round(got[m], 4) for m in ("f1", "accuracy", "precision", "recall")],
            )
        )
        if test is not None:
            predictions[kind] = model.transform(test)
    table = spark.createDataFrame(
        rows,
        "model string, parameters map<string,string>, f1 double, accuracy double, precision double, recall double",
    )
    return table.orderBy(F.desc("f1"), "model"), predictions
