"""Correlation tables: Pearson with pairwise deletion, Spearman with the target, and correlation of gaps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import as_double, ident
from proclivity.operators.profiling import engineered_summary
from proclivity.operators.running import running_sums
from proclivity.operators.summary import column_stats
from proclivity.schema import TARGET_COLUMN, numeric_columns

_PARTS = ["n", "sa", "sb", "qa", "qb", "ab"]


def pearson_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(feature_a, feature_b, n, correlation)`` for all ordered pairs, nulls dropped pair by pair.

    Each task reduces its rows to one set of cross-product matrices (width squared numbers,
    whatever the row count) and Spark adds these up. A pair without spread gives null.
    """
    names = numeric_columns(df, columns)
    stats = column_stats(df, names, ["mean"])
    centers = np.array([float(stats[c]["mean"] or 0.0) for c in names])
    width = len(names)

    def cross_products(batches):
        total = np.zeros((len(_PARTS), width, width))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - centers
            there = ~np.isnan(x)
            x[~there] = 0.0
            m = there.astype(float)
            sums, squares = x.T @ m, (x * x).T @ m
            total += [m.T @ m, sums, sums.T, squares, squares.T, x.T @ x]
        yield pd.DataFrame({p: [total[i].ravel()] for i, p in enumerate(_PARTS)})

    schema = ", ".join(f"{p} array<double>" for p in _PARTS)
    parts = df.select(*[col(c).cast("double").alias(c) for c in names]).mapInPandas(
        cross_products, schema
    )
    cells = (
        parts.select(F.posexplode(F.arrays_zip(*_PARTS)).alias("cell", "v"))
        .groupBy("cell")
        .agg(*[F.sum(f"v.{p}").alias(p) for p in _PARTS])
    )
    n = F.col("n")
    spread_a = n * F.col("qa") - F.col("sa") * F.col("sa")
    spread_b = n * F.col("qb") - F.col("sb") * F.col("sb")
    # Spread below rounding noise of its own terms counts as none.
    varies = (spread_a > n * F.col("qa") * 1e-12) & (spread_b > n * F.col("qb") * 1e-12)
    product = n * F.col("ab") - F.col("sa") * F.col("sb")
    label = F.array(*[F.lit(c) for c in names])
    return cells.select(
        F.get(label, F.floor(F.col("cell") / width).cast("int")).alias("feature_a"),
        F.get(label, F.col("cell") % width).alias("feature_b"),
        n.cast("bigint").alias("n"),
        F.when(varies, F.try_divide(product, F.sqrt(spread_a) * F.sqrt(spread_b))).alias(
            "correlation"
        ),
    )


def lower_triangle(matrix: DataFrame, order: list[str]) -> DataFrame:
    """Keep the pairs on or below the diagonal for the given feature order."""
    place = F.create_map(*[x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i))])
    return matrix.where(place[F.col("feature_a")] >= place[F.col("feature_b")])


def target_correlations(
    df: DataFrame,
    target: str = TARGET_COLUMN,
    method: str = "pearson",
    columns: list[str] | None = None,
    top_n: int | None = None,
) -> DataFrame:
    """``(feature, correlation)`` with the target, strongest first; undefined ones left out."""
    names = [c for c in numeric_columns(df, columns) if c != target]
    if method == "spearman":
        table = spearman_with_target(df, names, target)
    elif method == "pearson":
        table = engineered_summary(df, names, target).select(
            "feature", F.col("target_corr").alias("correlation")
        )
    else:
        raise ValueError(f"method {method!r} is not pearson or spearman")
    table = table.where(F.col("correlation").isNotNull()).orderBy(
        F.abs("correlation").desc(), "feature"
    )
    return table if top_n is None else table.limit(top_n)


def spearman_with_target(
    df: DataFrame, columns: list[str], target: str = TARGET_COLUMN
) -> DataFrame:
    """Spearman correlation of each column with a numeric target, nulls dropped per column.

    Rows are counted per (feature, value, target). Average ranks of values and of targets follow from running
    counts, both among the rows where the feature is known, and the correlation from weighted sums.
    """
    y = col(target).cast("double")
    long = (
        df.where(y.isNotNull())
        .selectExpr(f"{as_double(target)} AS __y", *[f"{as_double(c)} AS {ident(c)}" for c in columns])
        .unpivot(["__y"], columns, "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value", "__y")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def ranks(of: str, name: str) -> DataFrame:
        counts = long.groupBy("feature", F.col(of).alias("value")).agg(F.sum("n").alias("n"))
        ranked = running_sums(counts, ["feature"], "value", ["n"])
        return ranked.select("feature", F.col("value").alias(of), (F.col("n_upto") - (F.col("n") - 1) / 2).alias(name))

    placed = long.join(ranks("value", "rx"), ["feature", "value"]).join(ranks("__y", "ry"), ["feature", "__y"])
    weighted = {"x": "rx", "y": "ry", "xx": "rx * rx", "yy": "ry * ry", "xy": "rx * ry"}
    sums = placed.groupBy("feature").agg(
        F.sum("n").cast("double").alias("n"),
        *[F.sum(F.expr(f"n * {product}")).alias(name) for name, product in weighted.items()],
    )
    return sums.select(
        "feature",
        F.expr("try_divide(n * xy - x * y, sqrt(n * xx - x * x) * sqrt(n * yy - y * y))").alias("correlation"),
    )


def ranked_matrix(
    df: DataFrame,
    target: str = TARGET_COLUMN,
    columns: list[str] | None = None,
    top_n: int | None = None,
    lower_only: bool = True,
) -> DataFrame:
    """Correlation matrix of the target and its strongest features, target first."""
    names = numeric_columns(df, columns)
    ranked = target_correlations(df, target, columns=names, top_n=top_n)
    order = [target] + [r["feature"] for r in ranked.collect()]
    matrix = pearson_matrix(df, order)
    return lower_triangle(matrix, order) if lower_only else matrix


def null_overlaps(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature_a, feature_b, nulls_a, nulls_b, both, n)`` for pairs in column order.

    Each task reduces its rows to one product of null flags (a number per pair, whatever the row count).
    A single column gives no pairs; a frame without rows gives zeros.
    """
    width = len(columns)
    first, second = np.triu_indices(width, 1)
    parts = ["n", "nulls_a", "nulls_b", "both"]

    def count_gaps(batches):
        rows, total = 0, np.zeros((width, width))
        for batch in batches:
            gaps = batch.to_numpy(dtype=float)
            total += gaps.T @ gaps
            rows += len(batch)
        alone = total.diagonal()
        counts = [np.full(len(first), rows), alone[first], alone[second], total[first, second]]
        yield pd.DataFrame({p: [c.astype("int64")] for p, c in zip(parts, counts, strict=True)})

    gaps = df.selectExpr(*[f"CAST({ident(c)} IS NULL AS DOUBLE) AS g{i}" for i, c in enumerate(columns)])
    counted = (
        gaps.mapInPandas(count_gaps, ", ".join(f"{p} array<bigint>" for p in parts))
        .select(F.posexplode(F.arrays_zip(*parts)).alias("pair", "v"))
        .groupBy("pair")
        .agg(*[F.sum(f"v.{p}").alias(p) for p in parts])
    )
    names = df.sparkSession.createDataFrame(
        [(k, columns[i], columns[j]) for k, (i, j) in enumerate(zip(first, second, strict=True))],
        "pair int, feature_a string, feature_b string",
    )
    return names.join(counted, "pair", "left").select(
        "feature_a", "feature_b", *[F.coalesce(p, F.lit(0)).cast("bigint").alias(p) for p in (*parts[1:], "n")]
    )


def null_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature_a, feature_b, correlation)`` of the null flags, from counts alone."""
    n, a, b, both = (F.col(c).cast("double") for c in ("n", "nulls_a", "nulls_b", "both"))
    spread = F.sqrt(a * (n - a)) * F.sqrt(b * (n - b))
    return null_overlaps(df, columns).select(
        "feature_a", "feature_b", F.try_divide(n * both - a * b, spread).alias("correlation")
    )


def overlap_counts(df: DataFrame, columns: list[str], top_n: int | None = None) -> DataFrame:
    """Pairs by number of rows in which both are null, largest first."""
    table = (
        null_overlaps(df, columns)
        .select("feature_a", "feature_b", F.col("both").alias("count"))
        .orderBy(F.desc("count"), "feature_a", "feature_b")
    )
    return table if top_n is None else table.limit(top_n)
