"""Helpers of the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.catalog.votes_sql import SIGNAL_RULES
from proclivity.functions.sqltext import as_double, ident
from proclivity.operators.reshape import stack_results
from proclivity.operators.selection import consensus, drop_features, embedded_family, union_names
from proclivity.operators.selection import names as selection_names
from proclivity.operators.summary import feature_table
from proclivity.plans.persons import person_frame
from proclivity.schema import NUMERIC_COLUMNS, TARGET_COLUMN
from proclivity.session import materialize


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that both engines print the same digits."""
    return df.selectExpr(
        *[
            f"round({as_double(f.name)}, {digits}) + 0D AS {ident(f.name)}"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else ident(f.name)
            for f in df.schema.fields
        ]
    )


def profile_frame(spark, sf) -> DataFrame:
    """``(feature, nulls, mean, top, var, corr)`` of the numeric person columns."""

    def corr(c):
        y = f"CASE WHEN {c} IS NOT NULL THEN CAST({TARGET_COLUMN} AS DOUBLE) END"
        return f"try_divide(covar_samp({c}, {y}), stddev_samp({c}) * stddev_samp({y}))"

    return feature_table(
        person_frame(spark, sf),
        NUMERIC_COLUMNS,
        {
            "nulls": lambda c: f"count_if({c} IS NULL)",
            "mean": lambda c: f"avg({c})",
            "top": lambda c: f"max({c})",
            "var": lambda c: f"var_samp({c})",
            "corr": corr,
        },
    )


_signals: dict[tuple[str, str], DataFrame] = {}


def signal_frame(spark, sf) -> DataFrame:
    """``(method, feature)`` of the six signals, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _signals:
        _signals[key] = materialize(_build_signals(spark, sf), "signals")
    return _signals[key]


def _build_signals(spark, sf) -> DataFrame:
    rules = F.array(
        *[F.when(F.expr(rule), F.lit(name)) for name, rule in SIGNAL_RULES.items()]
    )
    return (
        profile_frame(spark, sf)
        .select("feature", F.explode(rules).alias("method"))
        .where(F.col("method").isNotNull())
        .select("method", "feature")
    )


def family_frame(spark, sf) -> DataFrame:
    """``(method, feature)`` of the three families."""
    signals = signal_frame(spark, sf)

    def of(name: str) -> DataFrame:
        return signals.where(F.col("method") == name)

    near = drop_features(selection_names(spark, NUMERIC_COLUMNS), of("Variance"))
    families = {
        "filter": drop_features(union_names(of("Spearman"), of("ANOVA")), near),
        "wrapper": of("RFE"),
        "embedded": embedded_family(of("Lasso"), of("Random Forest")),
    }
    return stack_results(
        [f.select(F.lit(name).alias("method"), "feature") for name, f in families.items()]
    )


def vote_frame(spark, sf) -> DataFrame:
    """Families, the two embedded parts and the consensus."""
    signals, families = signal_frame(spark, sf), family_frame(spark, sf)
    parts = [
        signals.where(F.col("method") == "Lasso").select(F.lit("embedded_lasso").alias("method"), "feature"),
        signals.where(F.col("method") == "Random Forest").select(
            F.lit("embedded_tree").alias("method"), "feature"
        ),
        consensus(families).select(F.lit("consensus").alias("method"), "feature"),
    ]
    return stack_results([families, *parts])
