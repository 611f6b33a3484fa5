"""Numeric scalers: standard, min-max, robust and rounding only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from proclivity.functions.sqltext import as_double, half_even_sql, number, with_expressions
from proclivity.operators.base import FittedStep, Step
from proclivity.operators.quantiles import exact_quantiles
from proclivity.operators.summary import column_stats
from proclivity.schema import numeric_columns

STRATEGIES = ("standard", "minmax", "robust", "passthrough")


def numeric_scaler(strategy: str = "standard", columns: list[str] | None = None, digits=4):
    """Scaler by name; values are rounded half to even afterwards."""
    return NumericScaler(strategy, columns, digits)


class NumericScaler(Step):
    """(x - center) / width with population or exact quantile statistics; zero width counts as 1."""

    def __init__(self, strategy="standard", columns: list[str] | None = None, digits: int | None = 4):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"scaling strategy {strategy!r} is not one of {STRATEGIES}")
        self.strategy = strategy
        self.columns = columns
        self.digits = digits

    def _fit(self, df: DataFrame) -> ScalerModel:
        names = numeric_columns(df) if self.columns is None else list(self.columns)
        if self.strategy == "standard":
            stats = column_stats(df, names, ["mean", "std_pop"])
            fitted = {c: (s["mean"], s["std_pop"]) for c, s in stats.items()}
        elif self.strategy == "minmax":
            stats = column_stats(df, names, ["min", "max"])
            fitted = {
                c: (s["min"], None if s["min"] is None else s["max"] - s["min"])
                for c, s in stats.items()
            }
        elif self.strategy == "robust":
            q = exact_quantiles(df, names, [0.25, 0.5, 0.75])
            fitted = {c: (v[1], None if v[0] is None else v[2] - v[0]) for c, v in q.items()}
        else:
            fitted = {c: (0.0, 1.0) for c in names}
        return ScalerModel(
            {
                "fitted": {
                    c: [None if m is None else float(m), None if w is None else float(w) or 1.0]
                    for c, (m, w) in fitted.items()
                },
                "digits": self.digits,
            }
        )


class ScalerModel(FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        digits = self.state["digits"]
        changes = {}
        for c, (center, width) in self.state["fitted"].items():
            scaled = f"({as_double(c)} - {number(center)}) / {number(width)}"
            changes[c] = scaled if digits is None else half_even_sql(scaled, digits)
        return with_expressions(df, changes)
