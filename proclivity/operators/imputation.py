"""Imputation: per-column strategies, treatment of informative gaps, medians with indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col, double
from proclivity.functions.sqltext import (
    as_double,
    half_even_sql,
    ident,
    number,
    text,
    with_expressions,
)
from proclivity.operators.base import FittedStep, Step
from proclivity.operators.quantiles import exact_quantiles, fits_one_buffer
from proclivity.operators.running import order_statistics
from proclivity.operators.summary import column_stats, modes
from proclivity.schema import NUMERIC_COLUMNS, TEXT_COLUMNS, numeric_columns, require_columns
from proclivity.session import materialize

NUMERIC_STRATEGIES = ("mean", "median", "most_frequent", "constant")
CATEGORICAL_STRATEGIES = ("most_frequent", "constant")
# "knn" sees one column at a time, so a row without a value has no neighbours and gets the mean.
COLUMN_STRATEGIES = ("mean", "median", "most_frequent", "min", "knn", "constant")
MISSING_LABEL = "Missing"

# The strategy of each declared column.
DEFAULT_STRATEGIES: dict[str, str] = {
    **dict.fromkeys(NUMERIC_COLUMNS, "knn"),
    **dict.fromkeys(TEXT_COLUMNS, "most_frequent"),
}


def numeric_imputer(strategy: str = "median", columns: list[str] | None = None):
    """Imputer of numeric columns by mean, median, most frequent value or constant."""
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(
            f"numeric strategy {strategy!r} is not one of {sorted(NUMERIC_STRATEGIES)}"
        )
    return ColumnImputer(strategy, columns, digits=None)


def categorical_imputer(
    strategy: str = "most_frequent",
    columns: list[str] | None = None,
    fill_value: str = MISSING_LABEL,
):
    """Imputer of text columns by most frequent value or constant."""
    if strategy not in CATEGORICAL_STRATEGIES:
        raise ValueError(
            f"categorical strategy {strategy!r} is not one of {sorted(CATEGORICAL_STRATEGIES)}"
        )
    return ColumnImputer(strategy, columns, digits=None, fill_value=fill_value)


class ColumnImputer(Step):
    """Fill nulls by a strategy per column; numeric columns are rounded whole to ``digits``.

    ``strategies`` is a mapping of column to strategy, or one strategy for ``columns``.
    All means and minima come from one job, medians from the quantile search and most frequent
    values from one count per (column, value).
    """

    def __init__(self, strategies, columns=None, digits: int | None = 4, fill_value=MISSING_LABEL):
        super().__init__()
        self.strategies = strategies
        self.columns = columns
        self.digits = digits
        self.fill_value = fill_value

    def _plan(self, df: DataFrame) -> dict[str, str]:
        if isinstance(self.strategies, dict):
            return dict(self.strategies)
        return dict.fromkeys(self.columns or df.columns, self.strategies)

    def _fit(self, df: DataFrame) -> ImputerModel:
        plan = self._plan(df)
        require_columns(df, plan)
        unknown = {c: s for c, s in plan.items() if s not in COLUMN_STRATEGIES}
        if unknown:
            raise ValueError(f"strategies {unknown} are not among {sorted(COLUMN_STRATEGIES)}")
        numeric = set(numeric_columns(df, list(plan)))
        wrong = [
            c for c, s in plan.items() if c not in numeric and s not in CATEGORICAL_STRATEGIES
        ]
        if wrong:
            raise ValueError(f"numeric strategies on text columns: {wrong}")

        def of(*names, is_text=None):
            return [
                c
                for c, s in plan.items()
                if s in names and (is_text is None or (c not in numeric) == is_text)
            ]

        fills: dict[str, object] = {}
        stats = column_stats(df, of("mean", "knn", "min"), ["mean", "min"])
        for c in stats:
            fills[c] = stats[c]["min" if plan[c] == "min" else "mean"]
        fills.update({c: q[0] for c, q in exact_quantiles(df, of("median"), [0.5]).items()})
        as_double = df.select(*[col(c).cast("double").alias(c) for c in of("most_frequent", is_text=False)])
        fills.update(modes(as_double, as_double.columns))
        fills.update(modes(df, of("most_frequent", is_text=True)))
        # A constant is a label; a numeric column keeps its type and takes zero.
        fills.update(dict.fromkeys(of("constant", is_text=True), self.fill_value))
        fills.update(dict.fromkeys(of("constant", is_text=False), 0.0))
        return ImputerModel(
            {
                "fills": {c: fills.get(c) for c in plan},
                "numeric": sorted(numeric),
                "digits": self.digits,
            }
        )


class ImputerModel(FittedStep):
    """Coalesce with literals, then rounding of the whole column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        numeric, digits = set(self.state["numeric"]), self.state["digits"]
        changes = {}
        for c, fill in self.state["fills"].items():
            if c in numeric:
                filled = f"coalesce({as_double(c)}, {number(fill)})"
                changes[c] = filled if digits is None else half_even_sql(filled, digits)
            else:
                changes[c] = f"coalesce({ident(c)}, {text(fill)})"
        return with_expressions(df, changes)


class MnarImputer(Step):
    """Treat the three columns whose gaps carry information: flag first, then fill.

    Wealth takes 0, months since the last promotion response take the median, age takes the
    median of its (owner, urbanicity) stratum, else of its owner group, else of all. A null
    key forms no stratum. Columns that are absent are skipped.
    """

    WEALTH = "WEALTH_RATING"
    MONTHS = "MONTHS_SINCE_LAST_PROM_RESP"
    AGE = "DONOR_AGE"
    STRATA = ("HOME_OWNER", "URBANICITY")

    def _fit(self, df: DataFrame) -> MnarModel:
        present = [c for c in (self.WEALTH, self.MONTHS, self.AGE) if c in df.columns]
        medians = exact_quantiles(df, [c for c in present if c != self.WEALTH], [0.5])
        strata = None
        if self.AGE in present:
            keys = [k for k in self.STRATA if k in df.columns]
            if keys:
                # Written once: a transform must not go over the training rows again.
                strata = materialize(stratified_medians(df, self.AGE, keys), "strata")
        return MnarModel(present, {c: q[0] for c, q in medians.items()}, strata)


class MnarModel(FittedStep):
    """Flags and fills as projections; the age strata come in through left joins."""

    parts = ("strata",)

    def __init__(self, present: list[str], medians: dict, strata: DataFrame | None):
        super().__init__({"present": present, "medians": medians})
        self.strata = strata

    def _transform(self, df: DataFrame) -> DataFrame:
        present, medians = self.state["present"], self.state["medians"]
        out = df.withColumns({f"{c}_MISSING": col(c).isNull().cast("int") for c in present})
        changes = {}
        if MnarImputer.WEALTH in present:
            changes[MnarImputer.WEALTH] = F.coalesce(col(MnarImputer.WEALTH), F.lit(0.0))
        if MnarImputer.MONTHS in present:
            changes[MnarImputer.MONTHS] = F.coalesce(
                col(MnarImputer.MONTHS), double(medians[MnarImputer.MONTHS])
            )
        out = out.withColumns(changes)
        if MnarImputer.AGE in present:
            overall = medians[MnarImputer.AGE]
            if self.strata is None:
                age = col(MnarImputer.AGE)
                return out.withColumn(MnarImputer.AGE, F.coalesce(age, double(overall)))
            out = fill_from_strata(out, MnarImputer.AGE, self.strata, overall)
        return out


def stratified_medians(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """``(keys…, __depth, __median)``: medians by all keys, and by each shorter run of first keys.

    While the column has few distinct values all levels come from one rollup. Otherwise each level
    counts per (keys, value) before it looks for the middle, so a stratum that holds most of the
    rows is spread over tasks. A null key forms no stratum.
    """
    rows = df.where(col(value).isNotNull()).select(*[col(k) for k in keys], col(value))
    depths = range(len(keys), 0, -1)
    if fits_one_buffer(rows, value):
        rolled = rows.rollup(*[col(k) for k in keys]).agg(
            F.percentile(col(value).cast("double"), F.lit(0.5)).alias("__median"),
            (F.lit(len(keys)) - F.bit_count(F.grouping_id())).alias("__depth"),
        )
        whole = [
            (F.col("__depth") == d) & reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys[:d]])
            for d in depths
        ]
        return rolled.where(reduce(lambda a, b: a | b, whole)).select(
            *[col(k) for k in keys], "__depth", "__median"
        )
    levels = []
    for d in depths:
        level = keys[:d]
        medians = order_statistics(rows.na.drop(subset=level), level, value, [0.5], False)
        levels.append(
            medians.select(
                *[col(k) if k in level else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys],
                F.lit(d).alias("__depth"),
                F.col("q0").alias("__median"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), levels)


def fill_from_strata(
    df: DataFrame, value: str, strata: DataFrame, overall: float | None
) -> DataFrame:
    """Left-join the medians of each depth and take the first one that exists.

    The table holds one row per stratum; no hint is given, so Spark broadcasts it while it is
    below the size threshold and shuffles beyond it.
    """
    keys = [c for c in strata.columns if c not in ("__depth", "__median")]
    out = df
    for d in range(len(keys), 0, -1):
        level = strata.where(F.col("__depth") == d).select(
            *[col(k) for k in keys[:d]], F.col("__median").alias(f"__median_{d}")
        )
        out = out.join(level, keys[:d], "left")
    medians = [F.col(f"__median_{d}") for d in range(len(keys), 0, -1)]
    filled = F.coalesce(col(value), *medians, double(overall))
    return out.withColumn(value, filled).select(*[col(c) for c in df.columns])


class IndicatorImputer(Step):
    """Fill by median or most frequent value and flag the columns that had nulls at fit."""

    def __init__(self, columns: list[str], strategy: str = "median"):
        super().__init__()
        if strategy not in ("median", "most_frequent"):
            raise ValueError(f"strategy {strategy!r} is not median or most_frequent")
        self.columns = columns
        self.strategy = strategy

    def _fit(self, df: DataFrame) -> IndicatorModel:
        require_columns(df, self.columns)
        frame = df.selectExpr(*[f"{as_double(c)} AS {ident(c)}" for c in self.columns])
        nulls = column_stats(frame, self.columns, ["nulls"])
        if self.strategy == "median":
            fills = {c: q[0] for c, q in exact_quantiles(frame, self.columns, [0.5]).items()}
        else:
            fills = modes(frame, self.columns)
        return IndicatorModel(
            {
                "fills": {c: fills.get(c) for c in self.columns},
                "flagged": [c for c in self.columns if nulls[c]["nulls"] > 0],
            }
        )


class IndicatorModel(FittedStep):
    """Flags named ``missingindicator_<column>`` for the columns recorded at fit."""

    @property
    def outputs(self) -> list[str]:
        return list(self.state["fills"]) + [f"missingindicator_{c}" for c in self.state["flagged"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        flags = {
            f"missingindicator_{c}": f"CAST({ident(c)} IS NULL AS DOUBLE)"
            for c in self.state["flagged"]
        }
        fills = {
            c: f"coalesce({as_double(c)}, {number(fill)})" for c, fill in self.state["fills"].items()
        }
        return with_expressions(df, {**flags, **fills})
