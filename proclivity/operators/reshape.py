"""Reshapes of result tables: scenario comparison, best rows, tidy metrics, logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.columns import col

# Order of the comparison scenarios and of the compared metrics.
SCENARIO_ORDER = ["raw", "+FE", "+FE+FS"]
COMPARED = ["roc_auc", "train_roc_auc", "gap_roc_auc", "f1", "train_f1", "gap_f1"]


def stack_results(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_gaps(results: DataFrame) -> DataFrame:
    """Train minus validation for area and F1."""
    return results.withColumns(
        {
            "gap_roc_auc": F.col("train_roc_auc") - F.col("roc_auc"),
            "gap_f1": F.col("train_f1") - F.col("f1"),
        }
    )


def compare_scenarios(
    results: DataFrame, scenarios: list[str] | None = None, metrics: list[str] | None = None
) -> DataFrame:
    """One row per model, columns ``<scenario>_<metric>`` in the order of the scenarios."""
    scenarios = SCENARIO_ORDER if scenarios is None else scenarios
    metrics = COMPARED if metrics is None else metrics
    return (
        results.groupBy("model")
        .pivot("scenario", scenarios)
        .agg(*[F.first(col(m), ignorenulls=True).alias(m) for m in metrics])
    )


def best_per_group(results: DataFrame, group: str, metric: str, tie_break: str) -> DataFrame:
    """The row with the largest metric in each group."""
    order = Window.partitionBy(col(group)).orderBy(col(metric).desc_nulls_last(), col(tie_break))
    return (
        results.withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def top_by(table: DataFrame, order: list[Column], n: int | None = None) -> DataFrame:
    """Sorted report, cut to the first n rows when asked."""
    ordered = table.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def largest_coefficients(table: DataFrame, value: str = "coefficient", top_n: int = 20) -> DataFrame:
    """Non-zero coefficients, largest magnitude first."""
    return top_by(
        table.where(col(value) != 0).withColumn("abs_coefficient", F.abs(col(value))),
        [F.desc("abs_coefficient"), F.col("feature")],
        top_n,
    )


def metric_table(row: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """``(metric, value)`` rows from a one-row frame of metrics."""
    names = metrics or row.columns
    return row.select(*[col(m).cast("double").alias(m) for m in names]).unpivot(
        [], names, "metric", "value"
    )


def melt(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Wide to long: ``(keys…, feature, value)``."""
    keys = keys or []
    return df.select(*[col(k) for k in keys], *[col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, columns, "feature", "value"
    )
