"""One-pass statistics of many columns, for fits (driver dict) and for reports (small frame)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import as_double, ident, number, text

# Aggregates per column as SQL text.
MEASURES: dict[str, str] = {
    "count": "count({c})",
    "nulls": "count_if({c} IS NULL)",
    "null_share": "avg(CAST({c} IS NULL AS DOUBLE))",
    "min": "min({c})",
    "max": "max({c})",
    "mean": "avg({c})",
    "std_pop": "stddev_pop({c})",
    "std": "stddev_samp({c})",
    "var": "var_samp({c})",
}


def column_stats(
    df: DataFrame, columns: list[str], measures: list[str]
) -> dict[str, dict[str, object]]:
    """Fitted statistics on the driver: a few numbers per column, one job for all."""
    if not columns:
        return {}
    row = df.selectExpr(
        *[
            f"{MEASURES[m].format(c=ident(c))} AS {m}{i}"
            for i, c in enumerate(columns)
            for m in measures
        ]
    ).first()
    return {c: {m: row[f"{m}{i}"] for m in measures} for i, c in enumerate(columns)}


def adjusted_skewness(
    df: DataFrame, columns: list[str], means: dict[str, float | None] | None = None
) -> dict[str, float | None]:
    """Sample skewness with the small-sample factor; 0 without spread, null below three values.

    Moments are taken around the mean, which plain averages of powers can do in one cheap pass once
    the mean is known.
    """
    if means is None:
        means = {c: s["mean"] for c, s in column_stats(df, columns, ["mean"]).items()}
    names = [c for c in columns if means[c] is not None]
    out: dict[str, float | None] = dict.fromkeys(columns)
    if not names:
        return out
    away = {c: f"({as_double(c)} - {number(float(means[c]))})" for c in names}
    row = df.selectExpr(
        *[f"count({ident(c)}) AS n{i}" for i, c in enumerate(names)],
        *[f"avg({away[c]} * {away[c]}) AS s{i}" for i, c in enumerate(names)],
        *[f"avg({away[c]} * {away[c]} * {away[c]}) AS t{i}" for i, c in enumerate(names)],
    ).first()
    for i, c in enumerate(names):
        n, second, third = row[f"n{i}"], row[f"s{i}"], row[f"t{i}"]
        if n < 3:
            continue
        # Spread below the rounding noise of the mean itself counts as none.
        if second <= (float(means[c]) * 1e-14) ** 2:
            out[c] = 0.0
        else:
            out[c] = third / second**1.5 * math.sqrt(n * (n - 1)) / (n - 2)
    return out


def feature_table(
    df: DataFrame, columns: list[str], measures: dict[str, Callable[[str], Column | str]]
) -> DataFrame:
    """Lazy report ``(feature, measure…)`` from a single wide aggregation.

    ``measures`` maps an output name to a function from a column name to an aggregate, as SQL text
    or as a column; the one aggregate row is then unfolded into one row per column.
    """
    made = [
        (f"{name}_{i}", make(c))
        for i, c in enumerate(columns)
        for name, make in measures.items()
    ]
    if all(isinstance(e, str) for _, e in made):
        wide = df.selectExpr(*[f"{e} AS {ident(n)}" for n, e in made])
    else:
        wide = df.agg(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in made])
    cells = ", ".join(
        f"{text(c)}, " + ", ".join(ident(f"{name}_{i}") for name in measures)
        for i, c in enumerate(columns)
    )
    names = ", ".join(ident(n) for n in ("feature", *measures))
    return wide.selectExpr(f"stack({len(columns)}, {cells}) AS ({names})")


def value_counts(df: DataFrame, columns: list[str], missing: str | None = None) -> DataFrame:
    """Rows per ``(feature, category)`` for many text columns in one shuffle of partial counts."""
    cells = df.select(*[col(c).cast("string").alias(c) for c in columns])
    long = cells.unpivot([], columns, "feature", "category")
    if missing is not None:
        long = long.fillna(missing, ["category"])
    return long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("count"))


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent non-null value of each column, the smallest on ties.

    Values are counted per (column, value) before the best is taken, so no buffer has to
    hold all distinct values of a column. All columns must share one type.
    """
    if not columns:
        return {}
    counts = (
        df.select(*[col(c) for c in columns])
        .unpivot([], columns, "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("feature").agg(F.max("n").alias("n"))
    # One row per column: bounded by the schema, so it can be broadcast.
    winners = (
        counts.join(F.broadcast(best), ["feature", "n"])
        .groupBy("feature")
        .agg(F.min("value").alias("value"))
    )
    return {r["feature"]: r["value"] for r in winners.collect()}
