"""The whole cleaning chain as one fitted step.

Order: drop columns, validation and whole numbers, informative gaps, imputation, outliers, range
guards, encoding. Fit reads the raw frame five times whatever its width (two passes for the medians of the informative
gaps, two for the age strata, one to write the frame the other steps are fitted on, deleted afterwards); transform
is a projection plus the left joins of the age strata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from proclivity.operators.base import FittedStep, Step
from proclivity.operators.cleaning import (
    beyond_float32_to_null,
    drop_columns,
    force_incoherence_to_null,
    infinities_to_null,
)
from proclivity.operators.encoding import OneHotEncoder, OrdinalEncoder
from proclivity.operators.imputation import DEFAULT_STRATEGIES, ColumnImputer, MnarImputer
from proclivity.operators.outliers import (
    OutlierRescaler,
    detect_outlier_columns,
    tukey_fences,
    with_outlier_flags,
)
from proclivity.schema import ID_COLUMN, TARGET_COLUMN, text_columns
from proclivity.session import written


class CleaningChain(Step):
    """``outlier_method`` is ``rescale``, ``split`` (adds outlier flags) or ``None``;
    ``encode`` is ``onehot``, ``label`` or ``None``. Key and target pass through untouched
    apart from the validation rules."""

    def __init__(
        self,
        outlier_columns: list[str] | None = None,
        outlier_method: str | None = "rescale",
        factor: float = 1.5,
        encode: str | None = None,
        drop: list[str] | None = None,
        exclude_indicators: bool = False,
        exclude=(ID_COLUMN, TARGET_COLUMN),
    ):
        super().__init__()
        if outlier_method not in ("rescale", "split", None):
            raise ValueError(f"outlier method {outlier_method!r} is not rescale, split or None")
        if encode not in ("onehot", "label", None):
            raise ValueError(f"encoding {encode!r} is not onehot, label or None")
        self.outlier_columns = outlier_columns
        self.outlier_method = outlier_method
        self.factor = factor
        self.encode = encode
        self.drop = drop
        self.exclude_indicators = exclude_indicators
        self.exclude = exclude

    def _fit(self, df: DataFrame) -> CleaningModel:
        current = force_incoherence_to_null(drop_columns(df, self.drop))
        gaps = MnarImputer().fit(current)
        # Later fits read this table: neither the rules nor the joins of the age strata are worked out again.
        with written(gaps.transform(current), "chain-fit") as current:
            imputer = self._imputer(current).fit(current)
            steps, current = [gaps, imputer], imputer.transform(current)
            outliers = self._outlier_step(current)
            if outliers is not None:
                steps.append(outliers.fit(current))
            encoder = None
            if self.encode:
                # Text columns are not changed by the outlier step, so the categories can be read here.
                columns = text_columns(current, exclude=self.exclude)
                encoder = (OneHotEncoder if self.encode == "onehot" else OrdinalEncoder)(columns).fit(current)
        return CleaningModel(self.drop, steps, encoder)

    def _outlier_step(self, df: DataFrame) -> Step | None:
        if self.outlier_method == "rescale":
            return OutlierRescaler(
                self.outlier_columns,
                "transform",
                factor=self.factor,
                exclude=self.exclude,
                exclude_indicators=self.exclude_indicators,
            )
        if self.outlier_method == "split":
            columns = self.outlier_columns or detect_outlier_columns(df, self.factor, exclude=self.exclude)
            return _OutlierFlags(columns, self.factor) if columns else None
        return None

    def _imputer(self, df: DataFrame) -> ColumnImputer:
        return ColumnImputer({c: s for c, s in DEFAULT_STRATEGIES.items() if c in df.columns})


class CleaningModel(FittedStep):
    parts = ("steps", "encoder")

    def __init__(self, drop, steps, encoder):
        super().__init__({"drop": drop})
        self.steps = steps
        self.encoder = encoder

    def _transform(self, df: DataFrame) -> DataFrame:
        out = force_incoherence_to_null(drop_columns(df, self.state["drop"]))
        for step in self.steps:
            out = step.transform(out)
        out = beyond_float32_to_null(infinities_to_null(out))
        return self.encoder.transform(out) if self.encoder else out


class _OutlierFlags(Step):
    """Outlier flags with the fences of the fitted frame."""

    def __init__(self, columns: list[str], factor: float):
        super().__init__()
        self.columns = columns
        self.factor = factor

    def _fit(self, df: DataFrame) -> _OutlierFlagsModel:
        return _OutlierFlagsModel({"fences": tukey_fences(df, self.columns, self.factor)})


class _OutlierFlagsModel(FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        return with_outlier_flags(df, self.state["fences"])


def clean_each_split(
    frames: dict[str, DataFrame], chain: CleaningChain, fit_on: str | None = "train"
) -> dict[str, DataFrame]:
    """Fit on one split and transform all; ``fit_on=None`` fits every split on itself."""
    if fit_on is None:
        return {name: chain.fit_transform(df) for name, df in frames.items()}
    model = chain.fit(frames[fit_on])
    return {name: model.transform(df) for name, df in frames.items()}
