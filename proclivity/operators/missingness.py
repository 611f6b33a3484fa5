"""Diagnostics of missingness: can gaps be predicted, where do they occur, which go together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col, double
from proclivity.models.newton import Fit, fit_together, moments, packed, scores_of
from proclivity.operators.correlation import null_correlations, overlap_counts
from proclivity.operators.profiling import (
    columns_with_nulls,
    group_null_rate,
    missing_percentages,
    null_rate_by_quantile,
    recode,
)
from proclivity.operators.quantiles import exact_quantiles
from proclivity.operators.running import running_sums
from proclivity.operators.summary import column_stats
from proclivity.schema import ID_COLUMN, TARGET_COLUMN, numeric_columns
from proclivity.session import written

REPORT = "variable string, pct_missing double, auc double, verdict string, top_predictors string"
# Areas from which gaps count as not at random or likely at random.
MNAR_FROM = 0.70
MAR_FROM = 0.60


def verdict(auc: Column) -> Column:
    return F.when(auc >= MNAR_FROM, "MNAR").when(auc >= MAR_FROM, "Likely MAR").otherwise("MCAR / weak")


def analyse_mnar(
    df: DataFrame,
    target: str = TARGET_COLUMN,
    key: str = ID_COLUMN,
    columns: list[str] | None = None,
    max_iter: int = 500,
) -> DataFrame:
    """One row per column with nulls: how well the other numeric columns predict its gaps.

    Medians and deviations come from shared passes; the filled predictors are written once, around their means and over
    their deviations. All columns are fitted together, each with the penalty of its own predictors over their deviations,
    and their areas are counted together. Rows in which all other predictors are null are left out, as are columns whose
    gap never or always occurs among the rest.
    """
    spark = df.sparkSession
    features = [c for c in df.columns if c not in (target, key)]
    predictors = numeric_columns(df, features)
    candidates = columns_with_nulls(df, [c for c in features if columns is None or c in columns])
    medians = {c: v[0] for c, v in exact_quantiles(df, predictors, [0.5]).items()}
    shares = column_stats(df, candidates, ["null_share"])
    predictors = [c for c in predictors if medians[c] is not None]
    filled = df.select(*[F.coalesce(col(c).cast("double"), double(medians[c])).alias(c) for c in predictors])
    center = column_stats(filled, predictors, ["mean", "std"])
    flags = list(dict.fromkeys([*candidates, *predictors]))
    gaps = [col(c).isNull().cast("double") for c in flags]
    values = [
        (F.coalesce(col(c).cast("double"), double(medians[c])) - double(center[c]["mean"])) / double(center[c]["std"] or 1.0)
        for c in predictors
    ]
    width = len(flags) + len(predictors)
    place = {c: len(flags) + i for i, c in enumerate(predictors)}
    fits = [
        Fit([place[p] for p in predictors if p != c], label=flags.index(c), unless=[flags.index(p) for p in predictors if p != c])
        for c in candidates
        if any(p != c for p in predictors)
    ]
    wide = df.select(F.lit(0.0).alias("y"), F.lit(0).alias("fold"), F.array(*gaps, *values).cast("array<double>").alias("x"))
    rows = []
    with written(packed(wide), "gaps") as blocks:
        going = []
        for fit, (sizes, deviations) in zip(fits, moments(blocks, fits, width) if fits else [], strict=True):
            if sizes.min() > 0:
                # Without deviation a predictor tells nothing and has no coefficient.
                varied = np.flatnonzero(deviations > 0)
                going.append(Fit([fit.columns[i] for i in varied], label=fit.label, unless=fit.unless, factors=deviations[varied] ** 2))
        if going:
            fit_together(blocks, going, width, None, max_iter)
            counts = scores_of(blocks, going, width).groupBy("fit", "score", "y").agg(F.count(F.lit(1)).alias("n"))
            with written(counts, "gap-scores") as scored:
                areas = _areas(scored)
        for k, fit in enumerate(going):
            c = flags[fit.label]
            others = [p for p in predictors if p != c]
            strength = dict.fromkeys(others, 0.0) | {predictors[i - len(flags)]: abs(w) for i, w in zip(fit.columns, fit.coefficients, strict=True)}
            top = sorted(others, key=lambda p: (-strength[p], p))[:3]
            rows.append((c, shares[c]["null_share"] * 100, areas[k], ", ".join(top)))
    if not rows:
        return spark.createDataFrame([], REPORT)
    table = spark.createDataFrame(
        rows, "variable string, pct double, auc double, top_predictors string"
    )
    return table.select(
        "variable",
        F.round("pct", 2).alias("pct_missing"),
        F.round("auc", 4).alias("auc"),
        verdict(F.col("auc")).alias("verdict"),
        "top_predictors",
    ).orderBy(F.desc("auc"), "variable")


def _areas(scored: DataFrame) -> dict[int, float]:
    """Area under the ROC curve per fit, ties counted half, from counted ``(fit, score, y, n)``.

    With running totals in rising order of the score, the area is the mean share of the rows of class 0 below a row of class 1.
    """
    by_score = scored.groupBy("fit", "score").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum("n").alias("n"))
    upto = running_sums(by_score, ["fit"], "score", ["n", "pos"])
    neg, below = F.col("n") - F.col("pos"), F.col("n_upto") - F.col("pos_upto") - (F.col("n") - F.col("pos"))
    pairs = F.sum((F.col("pos") * (below + neg / 2)).cast("double"))
    sums = upto.groupBy("fit").agg(pairs.alias("pairs"), F.sum("pos").alias("pos"), F.sum(neg).alias("neg"))
    return {r["fit"]: r["pairs"] / (r["pos"] * r["neg"]) for r in sums.collect()}


def explain_mnar(df: DataFrame) -> dict[str, DataFrame]:
    """The three tables behind the known gaps: by gift quintile, by owner, by recency."""
    owner = {"H": "Homeowner", "U": "Renter"}
    return {
        "WEALTH_RATING": null_rate_by_quantile(df, "LIFETIME_GIFT_AMOUNT", "WEALTH_RATING", 5),
        "DONOR_AGE": group_null_rate(df, "HOME_OWNER", "DONOR_AGE").withColumn(
            "category", recode(F.col("category"), owner)
        ),
        "MONTHS_SINCE_LAST_PROM_RESP": group_null_rate(
            df, "RECENCY_STATUS_96NK", "MONTHS_SINCE_LAST_PROM_RESP"
        ).orderBy(F.desc("null_rate"), "category"),
    }


def missingness_patterns(df: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Correlations of the null flags and counts of joint gaps."""
    return {
        "correlations": null_correlations(df, columns),
        "overlaps": overlap_counts(df, columns),
    }


def overlap_heatmap(
    df: DataFrame, columns: list[str] | None = None, top_n: int | None = None, exclude=()
) -> DataFrame:
    """Correlations of the null flags among the columns with most nulls."""
    names = [c for c in (columns or df.columns) if c in df.columns and c not in exclude]
    if not names:
        raise ValueError("no columns to compare")
    if top_n is not None:
        ranked = missing_percentages(df, names, top_n).collect()
        names = [r["feature"] for r in ranked]
    return null_correlations(df, names)
