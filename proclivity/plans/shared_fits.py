"""Fits of all folds at once, for the classifiers whose fits are sums over rows.

Ridge logistic regression shares every Newton pass between the folds; Gaussian Bayes needs the class moments of each fold
once, and the moments without a fold follow from them. Other classifiers are fitted fold by fold, some at a time, from
vectors assembled once for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.models.bayes import GaussianBayes
from proclivity.models.classifiers import NAMED, Classifier, ClassifierModel
from proclivity.models.newton import Fit, confusions, fit_together, packed, scores_of, training_rows
from proclivity.operators.preprocessing import assemble
from proclivity.operators.reshape import stack_results
from proclivity.session import materialize, written

#: Number of the fit on all rows among the folds.
WHOLE = -1


def shares_passes(classifier: Classifier) -> bool:
    """Whether all folds of this classifier are fitted from shared passes."""
    if classifier.kind == "LogisticRegression":
        return classifier.settings.get("penalty", "l2") == "l2"
    return classifier.kind == "GaussianNB"


def fold_scores(
    classifier: Classifier, folded: DataFrame, folds: int, fold: str = "__fold", whole: bool = False, parallelism: int = 2
) -> DataFrame:
    """``(fold, target, score, prediction)`` of every row, scored by the model of the other folds.

    ``folded`` is a written table with the fold number of each row. With ``whole`` every row comes a second time, with fold
    ``WHOLE``, scored by a model of all rows. Rows without target are left out.
    """
    target = classifier.target
    features = classifier.features or [c for c in folded.columns if c not in (classifier.key, target, fold)]
    known = folded.where(col(target).isNotNull())
    numbers = [*range(folds), *([WHOLE] if whole else [])]
    if not shares_passes(classifier):
        return _one_by_one(classifier.on(features), known, numbers, fold, parallelism)
    if classifier.kind == "GaussianNB":
        return _bayes(classifier, known, features, numbers, fold)
    p = classifier.settings
    fits = [Fit(range(len(features)), p.get("C", 1.0), None if i == WHOLE else i, p.get("fit_intercept", True)) for i in numbers]
    rows = materialize(packed(training_rows(known, features, target, fold)), "fold-rows")
    fit_together(rows, fits, len(features), classifier.weighting, p.get("max_iter", 100))
    scored = scores_of(rows, fits, len(features))
    number = F.when(F.col("fit") == folds, F.lit(WHOLE)).otherwise(F.col("fit"))
    return scored.select(
        number.alias("fold"),
        F.col("y").cast(folded.schema[target].dataType).alias(target),
        "score",
        (F.col("score") > 0.5).cast("int").alias("prediction"),
    )


def shared_confusions(classifiers: list[Classifier], folded: DataFrame, folds: int, fold: str = "__fold") -> list[list[tuple]]:
    """For each classifier of one kind that shares passes: ``(tn, fp, fn, tp)`` of each fold and, last, of all rows.

    All classifiers and folds are fitted and counted together; no row is written per fit.
    """
    first = classifiers[0]
    target = first.target
    features = first.features or [c for c in folded.columns if c not in (first.key, target, fold)]
    known, numbers = folded.where(col(target).isNotNull()), [*range(folds), WHOLE]
    if first.kind == "GaussianNB":
        # The log odds are linear in the features and their squares.
        moments = GaussianBayes(features, label=target).moments(known, F.col(fold))
        fits = []
        for c in classifiers:
            step = GaussianBayes(features, c.settings.get("var_smoothing", 1e-9), target)
            models = [step.model([m for m in moments if m[0] != i]) for i in numbers]
            fits += [Fit(range(2 * len(features)), held=None if i == WHOLE else i, beta=m.linear()) for i, m in zip(numbers, models, strict=True)]
        squares = [F.pow(col(c).cast("double"), F.lit(2.0)) for c in features]
        rows = known.select(
            col(target).cast("double").alias("y"), col(fold).cast("int").alias("fold"), F.array(*[col(c).cast("double") for c in features], *squares).alias("x")
        )
        width = 2 * len(features)
        counts = confusions(rows, fits, width)
    else:
        width = len(features)
        fits = [
            Fit(range(width), c.settings.get("C", 1.0), None if i == WHOLE else i, c.settings.get("fit_intercept", True))
            for c in classifiers
            for i in numbers
        ]
        with written(packed(training_rows(known, features, target, fold)), "fold-rows") as rows:
            fit_together(rows, fits, width, first.weighting, max(c.settings.get("max_iter", 100) for c in classifiers))
            counts = confusions(rows, fits, width)
    per = len(numbers)
    return [counts[k : k + per] for k in range(0, len(counts), per)]


@contextmanager
def _fits_from_vectors(first: Classifier, known: DataFrame, fold: str) -> Iterator[tuple[DataFrame, Callable]]:
    """Assembled rows (``label``, ``__fold``, ``features``), and a function that fits a classifier without a fold on them.

    Vectors are assembled and class sizes counted once for all classifiers and folds, as a fit reads its rows several
    times. They keep the order and partitions of the rows, on which Spark ML's sample for split points depends, and are
    held for the length of a block; what a lost executor held is assembled again from ``known``.
    """
    target = first.target
    features = first.features or [c for c in known.columns if c not in (first.key, target, fold)]
    rows = known.select(col(target).cast("double").alias("label"), col(fold).alias("__fold"), *[col(c) for c in features])
    vectors = assemble(rows, features).persist()

    def fit(classifier: Classifier, number: int) -> ClassifierModel:
        sizes: dict = {}
        for (held, label), n in found.items():
            if held != number:
                sizes[label] = sizes.get(label, 0) + n
        rest = vectors if number == WHOLE else vectors.where(F.col("__fold") != number)
        return classifier.fit_vectors(rest, features, sizes)

    try:
        found = {(r["__fold"], r["label"]): r["count"] for r in vectors.groupBy("__fold", "label").count().collect()}
        yield vectors, fit
    finally:
        vectors.unpersist()


def separate_confusions(
    classifiers: list[Classifier], folded: DataFrame, folds: int, fold: str = "__fold", parallelism: int | None = None
) -> list[list[tuple]]:
    """``shared_confusions`` for kinds that read vectors and are fitted one by one, some at a time (by default as many as
    a classifier has fits)."""
    numbers = [*range(folds), WHOLE]
    with _fits_from_vectors(classifiers[0], folded.where(col(classifiers[0].target).isNotNull()), fold) as (vectors, fit):

        def one(classifier: Classifier, number: int) -> tuple:
            held = vectors if number == WHOLE else vectors.where(F.col("__fold") == number)
            scored = fit(classifier, number).model.transform(held)
            hit, wish = F.col("prediction") == 1, F.col("label") == 1
            cells = (~hit & ~wish, hit & ~wish, ~hit & wish, hit & wish)
            return tuple(scored.select(*[F.count_if(c) for c in cells]).first())

        fits = [(c, i) for c in classifiers for i in numbers]
        with ThreadPool(parallelism or len(numbers)) as pool:
            counts = pool.starmap(inheritable_thread_target(folded.sparkSession)(one), fits, chunksize=1)
    per = len(numbers)
    return [counts[k : k + per] for k in range(0, len(counts), per)]


def _scored(model, held: DataFrame, number: int, target: str) -> DataFrame:
    return model.transform(held).select(F.lit(number).alias("fold"), col(target), "score", F.col("prediction").cast("int").alias("prediction"))


def _bayes(classifier: Classifier, known: DataFrame, features: list[str], numbers: list[int], fold: str) -> DataFrame:
    step = GaussianBayes(features, classifier.settings.get("var_smoothing", 1e-9), classifier.target)
    models = step.fit_without_each(known, fold, numbers)
    parts = []
    for number, model in zip(numbers, models, strict=True):
        held = known if number == WHOLE else known.where(col(fold) == number)
        parts.append(_scored(model, held, number, classifier.target))
    return stack_results(parts)


def _one_by_one(classifier: Classifier, known: DataFrame, numbers: list[int], fold: str, parallelism: int) -> DataFrame:
    def one(number: int) -> DataFrame:
        held = known if number == WHOLE else known.where(col(fold) == number)
        return _scored(fit(classifier, number), held.drop(fold), number, classifier.target)

    def from_columns(_, number: int):
        return classifier.fit((known if number == WHOLE else known.where(col(fold) != number)).drop(fold))

    by_name = nullcontext((None, from_columns))
    with (by_name if classifier.kind in NAMED else _fits_from_vectors(classifier, known, fold)) as (_, fit):
        with ThreadPool(min(parallelism, len(numbers))) as pool:
            return stack_results(pool.map(inheritable_thread_target(known.sparkSession)(one), numbers))
