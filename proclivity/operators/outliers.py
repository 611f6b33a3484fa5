"""Tukey fences, outlier reports and the three ways to tame outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import any_of, col, double
from proclivity.functions.sqltext import as_double, half_even_sql, ident, number, with_expressions
from proclivity.operators.base import FittedStep, Step
from proclivity.operators.quantiles import exact_quantiles
from proclivity.operators.summary import adjusted_skewness, column_stats, feature_table
from proclivity.schema import numeric_columns, require_columns

RESCALE_METHODS = ("scale", "transform", "binning")


def tukey_fences(
    df: DataFrame, columns: list[str], factor: float = 1.5
) -> dict[str, tuple[float, float] | None]:
    """Lower and upper fence per column; ``None`` for a column without values."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    fences = {}
    for c, (q1, q3) in quartiles.items():
        spread = None if q1 is None else q3 - q1
        fences[c] = None if q1 is None else (q1 - factor * spread, q3 + factor * spread)
    return fences


def is_outlier(column: str, fence: tuple[float, float] | None) -> Column:
    """Strictly outside the fence; null is not an outlier."""
    if fence is None:
        return F.lit(False)
    return F.expr(_outlier_sql(column, fence))


def _outlier_sql(column: str, fence: tuple[float, float] | None) -> str:
    if fence is None:
        return "false"
    c, (low, high) = as_double(column), fence
    return f"coalesce({c} < {number(low)} OR {c} > {number(high)}, false)"


def detect_outlier_columns(
    df: DataFrame, factor: float = 1.5, columns: list[str] | None = None, exclude=()
) -> list[str]:
    """Numeric columns with at least one outlier; extremes decide, so no further scan is needed."""
    names = numeric_columns(df, columns, exclude)
    fences = tukey_fences(df, names, factor)
    ends = column_stats(df, names, ["min", "max"])
    return [
        c
        for c in names
        if fences[c] and (ends[c]["min"] < fences[c][0] or ends[c]["max"] > fences[c][1])
    ]


def flag_outliers(df: DataFrame, columns: list[str], factor: float = 1.5) -> DataFrame:
    """Add ``<column>_OUTLIER`` flags and ``ANY_OUTLIER``; the caller filters on them.

    One flag column per attribute stands for the per-column (common, outlier) pairs, the
    combined flag for the split over all of them.
    """
    if not columns:
        raise ValueError("at least one column is needed")
    require_columns(df, columns, error=KeyError)
    return with_outlier_flags(df, tukey_fences(df, columns, factor))


def with_outlier_flags(df: DataFrame, fences: dict) -> DataFrame:
    """Flags for fences fitted before."""
    flags = {c: is_outlier(c, fence) for c, fence in fences.items()}
    return df.withColumns(
        {
            **{f"{c}_OUTLIER": flag for c, flag in flags.items()},
            "ANY_OUTLIER": any_of(list(flags.values())),
        }
    )


def split_by_outliers(
    df: DataFrame, columns: list[str], factor: float = 1.5, per_column: bool = True
):
    """``{column: (common, outlying)}``, or one pair for outliers in any column."""
    flagged = flag_outliers(df, columns, factor)

    def pair(flag: str):
        return (
            flagged.where(~F.col(flag)).select(*[col(c) for c in df.columns]),
            flagged.where(F.col(flag)).select(*[col(c) for c in df.columns]),
        )

    if per_column:
        return {c: pair(f"{c}_OUTLIER") for c in columns}
    return pair("ANY_OUTLIER")


def outlier_sides(df: DataFrame, columns: list[str], factor: float = 1.5) -> DataFrame:
    """``(feature, outlying, rows)``: sizes of the parts of ``split_by_outliers``, ``ANY`` for any of the columns.

    One fit and one pass over the flags; a part without rows has no line.
    """
    flagged = flag_outliers(df, columns, factor)
    flags = [F.col(f"{c}_OUTLIER").alias(c) for c in columns] + [F.col("ANY_OUTLIER").alias("ANY")]
    sides = flagged.select(*flags).unpivot([], [*columns, "ANY"], "feature", "outlying")
    return sides.groupBy("feature", "outlying").agg(F.count(F.lit(1)).alias("rows"))


def outlier_counts(
    df: DataFrame, columns: list[str] | None = None, factor: float = 1.5, exclude=()
) -> DataFrame:
    """``(feature, outlier_count, outlier_percent)``: percent of the non-null values."""
    names = numeric_columns(df, columns, exclude)
    if not names:
        raise ValueError("no numeric columns to look at")
    fences = tukey_fences(df, names, factor)
    counts = feature_table(
        df,
        names,
        {
            "outlier_count": lambda c: f"count_if({_outlier_sql(c, fences[c])})",
            "present": lambda c: f"count({ident(c)})",
        },
    )
    share = F.coalesce(
        F.try_divide(F.col("outlier_count") * F.lit(100.0), F.col("present")), F.lit(0.0)
    )
    return counts.select("feature", "outlier_count", share.alias("outlier_percent")).orderBy(
        F.desc("outlier_count"), "feature"
    )


def boxplot_summary(
    df: DataFrame, columns: list[str] | None = None, factor: float = 1.5
) -> DataFrame:
    """Quartiles, whisker ends and outlier count per feature."""
    names = numeric_columns(df, columns)
    if not names:
        raise ValueError("no numeric columns to look at")
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    fences = {
        c: None if q[0] is None else (q[0] - factor * (q[2] - q[0]), q[2] + factor * (q[2] - q[0]))
        for c, q in quartiles.items()
    }

    def inside(c: str) -> str:
        return f"CASE WHEN NOT {_outlier_sql(c, fences[c])} THEN {as_double(c)} END"

    def quartile(i: int):
        return lambda c: f"max({number(quartiles[c][i])})"

    return feature_table(
        df,
        names,
        {
            "q1": quartile(0),
            "median": quartile(1),
            "q3": quartile(2),
            "lower_whisker": lambda c: f"min({inside(c)})",
            "upper_whisker": lambda c: f"max({inside(c)})",
            "outlier_count": lambda c: f"count_if({_outlier_sql(c, fences[c])})",
        },
    )


def outlier_points(df: DataFrame, columns: list[str], factor: float = 1.5) -> DataFrame:
    """``(feature, value)`` of every outlying value."""
    fences = tukey_fences(df, columns, factor)
    marked = df.select(
        *[F.when(is_outlier(c, fences[c]), col(c).cast("double")).alias(c) for c in columns]
    )
    return marked.unpivot([], columns, "feature", "value").where(F.col("value").isNotNull())


def clip_filter(
    df: DataFrame, columns: list[str], low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """``(feature, value)`` of the values between two quantiles, ends included."""
    cuts = exact_quantiles(df, columns, [low, high])
    kept = df.select(
        *[
            F.when(
                col(c).cast("double").between(double(cuts[c][0]), double(cuts[c][1])),
                col(c).cast("double"),
            ).alias(c)
            for c in columns
        ]
    )
    return kept.unpivot([], columns, "feature", "value").where(F.col("value").isNotNull())


class OutlierRescaler(Step):
    """Rescale columns by robust scaling, log compression or equal-width bins.

    With ``columns=None`` the columns with outliers at fit are taken. ``exclude_indicators``
    leaves 0/1 columns alone; by default they are treated as any numeric column.
    """

    def __init__(
        self,
        columns: list[str] | None = None,
        method: str = "transform",
        bins: int | None = None,
        skew_threshold: float = 0.0,
        factor: float = 1.5,
        exclude=(),
        exclude_indicators: bool = False,
    ):
        super().__init__()
        if method not in RESCALE_METHODS:
            raise ValueError(f"method {method!r} is not one of {RESCALE_METHODS}")
        if method == "binning" and bins is None:
            raise ValueError("binning needs the number of bins")
        if method == "binning" and (not isinstance(bins, int) or bins < 2):
            raise ValueError("bins must be an integer of at least 2")
        self.columns = columns
        self.method = method
        self.bins = bins
        self.skew_threshold = skew_threshold
        self.factor = factor
        self.exclude = exclude
        self.exclude_indicators = exclude_indicators

    def _candidates(self, df: DataFrame) -> list[str]:
        if self.columns is not None:
            require_columns(df, self.columns, error=KeyError)
            return list(self.columns)
        return numeric_columns(df, exclude=self.exclude)

    def _fit(self, df: DataFrame) -> RescalerModel:
        names = self._candidates(df)
        stats = column_stats(df, names, ["min", "max", "mean"])
        if self.columns is None:
            fences = tukey_fences(df, names, self.factor)
            names = [
                c
                for c in names
                if fences[c] and (stats[c]["min"] < fences[c][0] or stats[c]["max"] > fences[c][1])
            ]
        if self.exclude_indicators and names:
            flags = df.agg(
                *[F.max((~col(c).isin(0, 1)).cast("int")).alias(f"f{i}") for i, c in enumerate(names)]
            ).first()
            names = [c for i, c in enumerate(names) if flags[f"f{i}"] != 0]
        if self.method == "scale":
            q = exact_quantiles(df, names, [0.25, 0.5, 0.75])
            fitted = {
                c: {"center": q[c][1], "width": None if q[c][0] is None else (q[c][2] - q[c][0]) or 1.0}
                for c in names
            }
        elif self.method == "transform":
            skews = adjusted_skewness(df, names, {c: stats[c]["mean"] for c in names})
            fitted = {c: self._log_plan(stats[c], skews[c]) for c in names}
        else:
            fitted = {
                c: {"low": stats[c]["min"], "high": stats[c]["max"], "bins": self.bins}
                for c in names
            }
        return RescalerModel({"method": self.method, "fitted": fitted})

    def _log_plan(self, stats: dict, skew: float | None) -> dict:
        low, high = stats["min"], stats["max"]
        if low is None or (skew is not None and abs(skew) < self.skew_threshold):
            return {"kind": "none"}
        if skew is not None and skew > 0:
            return {"kind": "log", "shift": -float(low) if low <= -1 else 0.0, "end": float(low)}
        return {"kind": "reflected", "shift": float(high) if high >= 1 else 0.0, "end": float(high)}


class RescalerModel(FittedStep):
    """Expressions with fitted literals, rounded to four digits."""

    def _transform(self, df: DataFrame) -> DataFrame:
        make = {"scale": _scaled, "transform": _logged, "binning": _binned}[self.state["method"]]
        return with_expressions(
            df, {c: make(as_double(c), p) for c, p in self.state["fitted"].items()}
        )


def _scaled(c: str, p: dict) -> str:
    return half_even_sql(f"({c} - {number(p['center'])}) / {number(p['width'])}")


def _logged(c: str, p: dict) -> str:
    """The fitted logarithm; values past the fitted end count as that end, where it would be undefined."""
    if p["kind"] == "log":
        c = f"log1p(CASE WHEN {c} < {number(p['end'])} THEN {number(p['end'])} ELSE {c} END + {number(p['shift'])})"
    elif p["kind"] == "reflected":
        c = f"-log1p(-CASE WHEN {c} > {number(p['end'])} THEN {number(p['end'])} ELSE {c} END + {number(p['shift'])})"
    return half_even_sql(c)


def _binned(c: str, p: dict) -> str:
    if p["low"] is None:
        return f"CAST({c} AS BIGINT)"
    low, bins = float(p["low"]), p["bins"]
    width = (float(p["high"]) - low) / bins
    if width == 0:
        # All values equal: the range is widened evenly, so they fall in the middle bin.
        inside = f"{(bins - 1) // 2}L"
    else:
        index = f"ceil(({c} - {number(low)}) / {number(width)}) - 1"
        inside = f"least(greatest({index}, 0L), {bins - 1}L)"
    return f"CASE WHEN {c} IS NOT NULL THEN {inside} END"
