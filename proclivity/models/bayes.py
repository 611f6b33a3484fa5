"""Gaussian naive Bayes with variance smoothing: one aggregation to fit, a projection to score."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.sqltext import as_double, ident, number
from proclivity.operators.base import FittedStep, Step


class GaussianBayes(Step):
    """Class means and population variances per feature.

    ``var_smoothing`` times the largest feature variance is added to every variance; the smoothing
    is a parameter, which the Spark ML class does not offer.
    """

    def __init__(self, features: list[str], var_smoothing: float = 1e-9, label: str = "label"):
        super().__init__()
        self.features = features
        self.var_smoothing = var_smoothing
        self.label = label

    def _fit(self, df: DataFrame) -> GaussianBayesModel:
        return self.model(self.moments(df, F.lit(0)))

    def fit_without_each(self, df: DataFrame, fold: str, numbers: list[int]) -> list[GaussianBayesModel]:
        """A model for each of ``numbers``: of the rows outside that fold, of all rows if no row has that number.

        The moments of every fold come from one aggregation; those without a fold are put together from the others.
        """
        moments = self.moments(df, F.col(fold))
        return [self.model([m for m in moments if m[0] != number]) for number in numbers]

    def moments(self, df: DataFrame, fold) -> list[tuple]:
        """``(fold, class, rows, means, variances)``: at most one per fold and class."""
        label = ident(self.label)
        grouped = (
            df.where(f"{label} IN (0, 1)")
            .groupBy(fold.alias("fold"), F.expr(f"CAST({label} AS INT)").alias("k"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.expr("array(" + ", ".join(f"avg({as_double(c)})" for c in self.features) + ")").alias("m"),
                F.expr("array(" + ", ".join(f"var_pop({as_double(c)})" for c in self.features) + ")").alias("v"),
            )
        )
        return sorted((r["fold"], r["k"], r["n"], list(r["m"]), list(r["v"])) for r in grouped.collect())

    def model(self, moments: list[tuple]) -> GaussianBayesModel:
        """The model of the rows behind these moments (see ``moments``)."""
        if {k for _, k, *_ in moments} != {0, 1}:
            raise ValueError("both classes are needed")
        sizes, means, inner = [], [], []
        for label in (0, 1):
            own = [(n, m, v) for _, k, n, m, v in moments if k == label]
            size = sum(n for n, _, _ in own)
            mean = [sum(n * m[i] for n, m, _ in own) / size for i in range(len(self.features))]
            # Variance of the whole from the variances within and between its parts.
            spread = [sum(n * (v[i] + (m[i] - mean[i]) ** 2) for n, m, v in own) / size for i in range(len(self.features))]
            sizes, means, inner = [*sizes, size], [*means, mean], [*inner, spread]
        priors = [n / sum(sizes) for n in sizes]
        # Variance over all rows from the variances within and between the classes.
        largest = max(
            sum(priors[k] * inner[k][i] for k in (0, 1))
            + priors[0] * priors[1] * (means[0][i] - means[1][i]) ** 2
            for i in range(len(self.features))
        )
        extra = self.var_smoothing * largest
        return GaussianBayesModel(
            {
                "features": self.features,
                "priors": priors,
                "means": means,
                "variances": [[v + extra for v in row] for row in inner],
            }
        )


class GaussianBayesModel(FittedStep):
    def linear(self) -> np.ndarray:
        """The log odds as coefficients of the features, of their squares, and a constant."""
        (m0, m1), (v0, v1), (p0, p1) = (np.array(self.state[k]) for k in ("means", "variances", "priors"))
        constant = math.log(p1 / p0) + (0.5 * np.log(v0 / v1) + m0**2 / (2 * v0) - m1**2 / (2 * v1)).sum()
        return np.concatenate([m1 / v1 - m0 / v0, 1 / (2 * v0) - 1 / (2 * v1), [constant]])

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        terms = [number(math.log(s["priors"][1] / s["priors"][0]))]
        for i, c in enumerate(s["features"]):
            x = as_double(c)
            m0, m1 = s["means"][0][i], s["means"][1][i]
            v0, v1 = s["variances"][0][i], s["variances"][1][i]
            terms.append(
                f"({number(0.5 * math.log(v0 / v1))} + power({x} - {number(m0)}, 2) / {number(2 * v0)}"
                f" - power({x} - {number(m1)}, 2) / {number(2 * v1)})"
            )
        out = df.withColumn("__odds", F.expr(" + ".join(terms)))
        return out.withColumns(
            {
                # Beyond this range the probability is 0 or 1 in double precision anyway.
                "score": 1 / (1 + F.exp(-F.greatest(F.least(F.col("__odds"), F.lit(700.0)), F.lit(-700.0)))),
                "prediction": (F.col("__odds") > 0).cast("double"),
            }
        ).drop("__odds")
