"""Report tables: nulls, frequencies, target rates, buckets, histograms, variances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.columns import col, double
from proclivity.functions.sqltext import as_double, ident
from proclivity.operators.outliers import clip_filter
from proclivity.operators.quantiles import exact_quantiles
from proclivity.operators.summary import column_stats, feature_table, value_counts
from proclivity.schema import TARGET_COLUMN, numeric_columns, require_columns, text_columns

MISSING = "Missing"


def missing_percentages(
    df: DataFrame, columns: list[str] | None = None, top_n: int | None = None
) -> DataFrame:
    """``(feature, missing_percent)``, most missing first."""
    table = feature_table(
        df,
        columns or df.columns,
        {"missing_percent": lambda c: f"avg(CAST({ident(c)} IS NULL AS DOUBLE)) * 100"},
    ).orderBy(F.desc("missing_percent"), "feature")
    return table if top_n is None else table.limit(top_n)


def columns_with_nulls(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that hold a null, one job."""
    stats = column_stats(df, columns, ["nulls"])
    return [c for c in columns if stats[c]["nulls"] > 0]


def group_null_rate(df: DataFrame, group: str, column: str) -> DataFrame:
    """``(group, null_rate)``; a null group value forms no group."""
    return (
        df.where(col(group).isNotNull())
        .groupBy(col(group).alias("category"))
        .agg(F.avg(col(column).isNull().cast("double")).alias("null_rate"))
    )


def recode(column: Column, labels: dict[str, str]) -> Column:
    """Replace the given values by labels, others stay."""
    out = column
    for value, label in labels.items():
        out = F.when(column == value, label).otherwise(out)
    return out


def quantile_buckets(df: DataFrame, column: str, buckets: int = 5) -> tuple[Column, list[float]]:
    """Bucket index of a column cut at its quantiles, and the edges.

    Right-closed with the minimum in the first bucket; repeated edges are merged.
    """
    probs = [i / buckets for i in range(buckets + 1)]
    cuts = exact_quantiles(df, [column], probs)[column]
    edges = sorted({c for c in cuts if c is not None})
    value = col(column)
    index = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        index = F.when(value <= double(edges[i + 1]), i).otherwise(index)
    return F.when(value.isNotNull(), index), edges


def null_rate_by_quantile(
    df: DataFrame, bucket_by: str, column: str, buckets: int = 5
) -> DataFrame:
    """``(bucket, lower, upper, null_rate)`` of ``column`` over quantile buckets of another."""
    index, edges = quantile_buckets(df, bucket_by, buckets)
    lower = F.array(*[double(e) for e in edges])
    return (
        df.select(index.alias("bucket"), col(column).isNull().cast("double").alias("gap"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.avg("gap").alias("null_rate"))
        .select(
            "bucket",
            F.get(lower, F.col("bucket")).alias("lower"),
            F.get(lower, F.col("bucket") + 1).alias("upper"),
            "null_rate",
        )
    )


def category_frequencies(
    df: DataFrame, columns: list[str] | None = None, top_n: int | None = None
) -> DataFrame:
    """``(feature, category, count)`` with nulls as a category, the top n of each feature."""
    names = text_columns(df) if columns is None else [c for c in columns if c in df.columns]
    if not names:
        raise ValueError("no categorical columns to look at")
    counts = value_counts(df, names, MISSING)
    return counts if top_n is None else top_in_feature(counts, "count", top_n)


def top_in_feature(counts: DataFrame, by: str, top_n: int) -> DataFrame:
    """Largest n rows of each feature; Spark prunes to n per task before it shuffles."""
    order = Window.partitionBy("feature").orderBy(F.desc(by), "category")
    return (
        counts.withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= top_n)
        .drop("__rank")
    )


def category_target_rates(
    df: DataFrame, columns: str | list[str], target: str = TARGET_COLUMN
) -> DataFrame:
    """``(feature, category, target_rate)``; nulls form a category."""
    require_columns(df, [target], "target")
    names = [columns] if isinstance(columns, str) else [c for c in columns if c in df.columns]
    if not names:
        raise ValueError("no categorical columns were given")
    long = df.select(
        col(target).cast("double").alias("__y"),
        *[F.coalesce(col(c).cast("string"), F.lit(MISSING)).alias(c) for c in names],
    ).unpivot(["__y"], names, "feature", "category")
    return long.groupBy("feature", "category").agg(F.avg("__y").alias("target_rate"))


def missing_target_rates(
    df: DataFrame,
    target: str = TARGET_COLUMN,
    columns: list[str] | None = None,
    top_n: int = 15,
) -> DataFrame:
    """``(feature, group, target_rate)`` for missing and present rows of the columns with most nulls."""
    require_columns(df, [target], "target")
    names = [c for c in (columns or df.columns) if c in df.columns and c != target]
    if not columns_with_nulls(df, names):
        raise ValueError("no column has missing values")
    y = as_double(target)
    wide = feature_table(
        df,
        names,
        {
            "nulls": lambda c: f"count_if({ident(c)} IS NULL)",
            "missing": lambda c: f"avg(CASE WHEN {ident(c)} IS NULL THEN {y} END)",
            "present": lambda c: f"avg(CASE WHEN {ident(c)} IS NOT NULL THEN {y} END)",
        },
    )
    top = wide.where(F.col("nulls") > 0).orderBy(F.desc("nulls"), "feature").limit(top_n)
    rows = F.array(
        F.struct(F.lit(MISSING).alias("group"), F.col("missing").alias("target_rate")),
        F.struct(F.lit("Not Missing").alias("group"), F.col("present").alias("target_rate")),
    )
    return top.select("feature", F.inline(rows))


def clipped_histogram(
    df: DataFrame,
    columns: list[str] | None = None,
    bins: int = 30,
    low: float = 0.01,
    high: float = 0.99,
) -> DataFrame:
    """``(feature, bin, bin_start, count)``: equal-width bins after clipping at two quantiles."""
    names = numeric_columns(df, columns)
    if not names:
        raise ValueError("no numeric columns to look at")
    kept = clip_filter(df, names, low, high)
    # One row per feature, bounded by the schema.
    ends = kept.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(0)),
        F.lit(bins - 1),
    )
    return (
        kept.join(F.broadcast(ends), "feature")
        .groupBy("feature", index.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.first(F.col("lo")).alias("lo"), F.first(width).alias("w"))
        .select("feature", "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"), "count")
    )


def score_histogram(df: DataFrame, score: str = "score", bins: int = 20) -> DataFrame:
    """``(bin, bin_start, count)`` over the range of the scores, last bin closed, empty bins kept.

    Without any score the bins are empty and cover 0 to 1.
    """
    ends = column_stats(df, [score], ["min", "max"])[score]
    low, high = (0.0, 1.0) if ends["min"] is None else (float(ends["min"]), float(ends["max"]))
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    index = F.least(F.floor((col(score) - double(low)) / double(width)), F.lit(bins - 1))
    counts = (
        df.where(col(score).isNotNull())
        .groupBy(index.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def engineered_summary(
    df: DataFrame, columns: list[str], target: str = TARGET_COLUMN
) -> DataFrame:
    """Null percent, mean, deviation and correlation with the target, strongest first."""
    y = as_double(target)

    def corr(c: str) -> str:
        x = f"CASE WHEN {y} IS NOT NULL THEN {as_double(c)} END"
        z = f"CASE WHEN {ident(c)} IS NOT NULL THEN {y} END"
        return f"try_divide(covar_samp({x}, {z}), stddev_samp({x}) * stddev_samp({z}))"

    return feature_table(
        df,
        columns,
        {
            "missing_pct": lambda c: f"avg(CAST({ident(c)} IS NULL AS DOUBLE)) * 100",
            "train_mean": lambda c: f"avg({ident(c)})",
            "train_std": lambda c: f"stddev_samp({ident(c)})",
            "target_corr": corr,
        },
    ).orderBy(F.abs("target_corr").desc_nulls_last(), "feature")


def variances(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(feature, variance)`` with the sample variance, smallest first."""
    names = numeric_columns(df, columns)
    return feature_table(df, names, {"variance": lambda c: f"var_samp({ident(c)})"}).orderBy(
        "variance", "feature"
    )


def near_constant(variance_table: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Features whose variance is below the threshold."""
    return variance_table.where(F.col("variance") < threshold)


def lowest_variances(variance_table: DataFrame, top_n: int = 20) -> DataFrame:
    return variance_table.orderBy("variance", "feature").limit(top_n)


def class_counts(df: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    return df.groupBy(col(target).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def indicator_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, levels)``: 1 when the null flag of a column is constant, else 2."""
    return feature_table(
        df,
        columns,
        {
            "levels": lambda c: (
                f"max(CAST({ident(c)} IS NULL AS INT)) - min(CAST({ident(c)} IS NULL AS INT)) + 1"
            )
        },
    )


def split_report(df: DataFrame, split: str, target: str = TARGET_COLUMN) -> DataFrame:
    """Rows, feature count and target rate of each split."""
    width = len([c for c in df.columns if c not in (split, target)])
    return df.groupBy(col(split).alias("split")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.lit(width)).alias("columns"),
        F.avg(col(target).cast("double")).alias("target_rate"),
    )
