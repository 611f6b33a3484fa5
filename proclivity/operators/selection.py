"""Feature selection: filters, votes, consensus and the decision matrix."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col, neg_log10
from proclivity.functions.sqltext import as_double, ident
from proclivity.operators.summary import feature_table
from proclivity.schema import TARGET_COLUMN

FAMILIES = ("filter", "wrapper", "embedded")
METHODS = ("filter", "wrapper", "embedded", "embedded_lasso", "embedded_tree", "consensus")
# Column names of the decision matrix.
SIGNALS = ("Variance", "Spearman", "ANOVA", "RFE", "Lasso", "Random Forest")

VARIANCE_THRESHOLD = 0.01
CORRELATION_THRESHOLD = 0.05
P_VALUE_THRESHOLD = 0.05


def anova_f(df: DataFrame, columns: list[str], target: str = TARGET_COLUMN) -> DataFrame:
    """``(feature, f_score, df_between, df_within)`` of the one-way test between the two classes.

    One wide aggregation: sizes, means and squared deviations of both classes per column.
    """

    measures = {
        f"{short}{label}": lambda c, f=f, label=label: (
            f"{f}(CASE WHEN {ident(target)} = {label} THEN {as_double(c)} END)"
        )
        for label in (0, 1)
        for short, f in (("n", "count"), ("m", "avg"), ("v", "var_pop"))
    }
    wide = feature_table(df, columns, measures)
    n0, n1, m0, m1 = (F.col(x) for x in ("n0", "n1", "m0", "m1"))
    n = n0 + n1
    grand = F.try_divide(n0 * m0 + n1 * m1, n)
    between = n0 * (m0 - grand) * (m0 - grand) + n1 * (m1 - grand) * (m1 - grand)
    within = n0 * F.col("v0") + n1 * F.col("v1")
    return wide.select(
        "feature",
        F.try_divide(between, F.try_divide(within, n - 2)).alias("f_score"),
        F.lit(1).cast("bigint").alias("df_between"),
        (n - 2).alias("df_within"),
    )


def f_tail_one(f: float, within: float) -> float:
    """P(F > f) for one and ``within`` degrees of freedom.

    With one degree above, F is a squared t value; its two-sided tail is a regularised incomplete
    beta function, here by continued fraction, and the normal tail once ``within`` is large.
    """
    if f <= 0:
        return 1.0
    if within > 1e6:
        return math.erfc(math.sqrt(f / 2))
    x = within / (within + f)
    a, b = within / 2, 0.5
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(b, a, 1 - x)
    return _beta_tail(a, b, x)


def _beta_tail(a: float, b: float, x: float) -> float:
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    # Modified Lentz evaluation of the standard continued fraction.
    c, d = 1.0, 1.0 / _away_from_zero(1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 20_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / _away_from_zero(1 + step * d)
            c = _away_from_zero(1 + step / c)
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h / a


def _away_from_zero(x: float) -> float:
    return x if abs(x) > 1e-300 else 1e-300


def anova_test(df: DataFrame, columns: list[str], target: str = TARGET_COLUMN) -> DataFrame:
    """``(feature, f_score, p_value)``; one row per feature passes through the driver."""
    rows = [
        (
            r["feature"],
            r["f_score"],
            None if r["f_score"] is None else f_tail_one(r["f_score"], float(r["df_within"])),
        )
        for r in anova_f(df, columns, target).collect()
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, f_score double, p_value double")


def top_anova(scores: DataFrame, top_n: int = 20) -> DataFrame:
    """Largest F scores with -log10 of their p-value."""
    return (
        scores.withColumn("neg_log_p", neg_log10(F.col("p_value")))
        .orderBy(F.col("f_score").desc_nulls_last(), "feature")
        .limit(top_n)
    )


def names(spark, features) -> DataFrame:
    """A one-column frame of feature names."""
    return spark.createDataFrame([(f,) for f in features], "feature string")


def union_names(*frames: DataFrame) -> DataFrame:
    """Distinct names found in any of the frames."""
    return reduce(lambda a, b: a.union(b), [f.select("feature") for f in frames]).distinct()


def intersect_names(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("feature").intersect(b.select("feature"))


def keep_features(table: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of a report whose feature is in ``kept``."""
    return table.join(kept.select("feature"), "feature", "left_semi")


def drop_features(table: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of a report whose feature is not in ``dropped``."""
    return table.join(dropped.select("feature"), "feature", "left_anti")


def filter_family(
    variance_table: DataFrame, spearman_table: DataFrame, anova_table: DataFrame
) -> DataFrame:
    """Associated by Spearman or ANOVA, and not near-constant."""
    near = variance_table.where(F.col("variance") < VARIANCE_THRESHOLD)
    associated = union_names(
        spearman_table.where(F.abs("correlation") >= CORRELATION_THRESHOLD),
        anova_table.where(F.col("p_value") < P_VALUE_THRESHOLD),
    )
    return drop_features(associated, near)


def embedded_family(lasso: DataFrame, tree: DataFrame) -> DataFrame:
    return union_names(lasso, tree)


def vote_counts(votes: DataFrame) -> DataFrame:
    """``(feature, votes)`` from ``(method, feature)`` rows of the three families."""
    return (
        votes.where(F.col("method").isin(*FAMILIES))
        .groupBy("feature")
        .agg(F.count_distinct("method").alias("votes"))
    )


def consensus(votes: DataFrame, at_least: int = 2) -> DataFrame:
    """Features named by at least two families."""
    return vote_counts(votes).where(F.col("votes") >= at_least).select("feature")


def decision_matrix(features: DataFrame, signals: DataFrame, final: DataFrame) -> DataFrame:
    """One row per feature: Keep or Discard per signal, votes and final decision.

    ``signals`` holds ``(method, feature)`` rows whose method is one of the six signal names.
    """
    pivoted = (
        signals.select("feature", "method", F.lit("Keep").alias("d"))
        .groupBy("feature")
        .pivot("method", list(SIGNALS))
        .agg(F.first("d"))
    )
    chosen = final.select("feature", F.lit("Keep").alias("final"))
    joined = features.join(pivoted, "feature", "left").join(chosen, "feature", "left")
    votes = reduce(lambda a, b: a + b, [col(s).isNotNull().cast("int") for s in SIGNALS])
    return joined.select(
        "feature",
        *[F.coalesce(col(s), F.lit("Discard")).alias(s) for s in SIGNALS],
        votes.alias("Keep Votes"),
        F.coalesce("final", F.lit("Discard")).alias("Final Decision"),
    ).orderBy(F.desc("Final Decision"), F.desc("Keep Votes"), "feature")
