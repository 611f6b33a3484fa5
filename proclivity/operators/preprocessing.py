"""Model-ready frames: feature groups, and the fitted preparation per model family."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import as_double, ident, text, with_expressions
from proclivity.operators.base import FittedStep, Step
from proclivity.operators.encoding import OneHotEncoder
from proclivity.operators.imputation import MISSING_LABEL, IndicatorImputer
from proclivity.operators.scaling import NumericScaler
from proclivity.operators.summary import column_stats
from proclivity.schema import ID_COLUMN, TARGET_COLUMN, numeric_columns, require_columns

# Which columns may be dropped for gaps, from which share, and which are codes.
HIGH_MISSING_THRESHOLD = 0.40
HIGH_MISSING_CANDIDATES = ["WEALTH_RATING"]
CODED_NUMERIC_FEATURES = ["INCOME_GROUP", "WEALTH_RATING"]

# The four preparation scenarios.
SCENARIOS = [
    {
        "scenario_name": "Drop WEALTH_RATING | INCOME_GROUP numeric",
        "drop_high_missing_features": True,
        "income_group_as_categorical": False,
    },
    {
        "scenario_name": "Keep WEALTH_RATING | INCOME_GROUP numeric",
        "drop_high_missing_features": False,
        "income_group_as_categorical": False,
    },
    {
        "scenario_name": "Drop WEALTH_RATING | INCOME_GROUP categorical",
        "drop_high_missing_features": True,
        "income_group_as_categorical": True,
    },
    {
        "scenario_name": "Keep WEALTH_RATING | INCOME_GROUP categorical",
        "drop_high_missing_features": False,
        "income_group_as_categorical": True,
    },
]

GROUPS = (
    "continuous_numeric_features",
    "coded_numeric_features",
    "categorical_features",
    "dropped_high_missing_features",
)


def prepare_modeling_frame(df: DataFrame, income_group_as_categorical: bool = False) -> DataFrame:
    """Optionally treat the income group as text; nulls are the only kind of missing value."""
    if income_group_as_categorical and "INCOME_GROUP" in df.columns:
        return df.withColumn("INCOME_GROUP", col("INCOME_GROUP").cast("string"))
    return df


def feature_groups(
    df: DataFrame,
    drop_high_missing: bool = True,
    coded: list[str] | None = None,
    exclude=(ID_COLUMN, TARGET_COLUMN),
) -> dict[str, list[str]]:
    """Continuous, coded, categorical and dropped features; one null-share job at most."""
    features = [c for c in df.columns if c not in exclude]
    numeric = numeric_columns(df, features)
    dropped = []
    if drop_high_missing:
        candidates = [c for c in HIGH_MISSING_CANDIDATES if c in features]
        shares = column_stats(df, candidates, ["null_share"])
        dropped = [
            c for c in candidates if (shares[c]["null_share"] or 0.0) >= HIGH_MISSING_THRESHOLD
        ]
    codes = [
        c
        for c in (CODED_NUMERIC_FEATURES if coded is None else coded)
        if c in numeric and c not in dropped
    ]
    numeric_set = set(numeric)
    return {
        "continuous_numeric_features": [c for c in numeric if c not in codes and c not in dropped],
        "coded_numeric_features": codes,
        "categorical_features": [c for c in features if c not in numeric_set],
        "dropped_high_missing_features": dropped,
    }


def feature_group_summary(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """``(feature_group, n_features, features)`` with a comma list, names sorted."""
    rows = [(g, c) for g in GROUPS for c in groups[g]]
    spark = df.sparkSession
    names = spark.createDataFrame(rows, "feature_group string, feature string")
    all_groups = spark.createDataFrame([(g,) for g in GROUPS], "feature_group string")
    listed = names.groupBy("feature_group").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("feature")).alias("list")
    )
    return all_groups.join(listed, "feature_group", "left").select(
        "feature_group",
        F.coalesce("n", F.lit(0)).alias("n_features"),
        F.coalesce(F.array_join("list", ", "), F.lit("")).alias("features"),
    )


class Preprocessor(Step):
    """Medians or modes with indicators, robust scaling for linear models, one-hot text.

    Output order: continuous, coded, categorical; key and target stay, other columns go.
    """

    def __init__(
        self,
        family: str = "linear",
        drop_high_missing: bool = True,
        exclude=(ID_COLUMN, TARGET_COLUMN),
    ):
        super().__init__()
        self.family = family
        self.drop_high_missing = drop_high_missing
        self.exclude = exclude

    def _fit(self, df: DataFrame) -> PreprocessorModel:
        return self._fit_all(df, [self.family])[self.family]

    def _fit_all(self, df: DataFrame, families: list[str]) -> dict[str, PreprocessorModel]:
        """A model for each family: only the scaler is fitted for one of them alone."""
        groups = feature_groups(df, self.drop_high_missing, exclude=self.exclude)
        steps, outputs = [], []
        current = df
        for names, strategy in (
            (groups["continuous_numeric_features"], "median"),
            (groups["coded_numeric_features"], "most_frequent"),
        ):
            if not names:
                continue
            imputer = IndicatorImputer(names, strategy).fit(current)
            current = imputer.transform(current)
            steps.append(imputer)
            outputs += imputer.outputs
        scalers = []
        if "linear" in families and outputs:
            scalers.append(NumericScaler("robust", list(outputs), digits=None).fit(current))
        encoders = []
        categorical = groups["categorical_features"]
        if categorical:
            filled = _label_missing(df, categorical)
            encoders.append(OneHotEncoder(categorical).fit(filled))
            outputs += encoders[0].outputs
        kept = [c for c in self.exclude if c in df.columns]
        return {
            family: PreprocessorModel([*steps, *(scalers if family == "linear" else []), *encoders], groups, list(outputs), kept)
            for family in families
        }


def fit_families(df: DataFrame, families: list[str], drop_high_missing: bool = True) -> dict[str, PreprocessorModel]:
    """The preparation of each family, as ``Preprocessor(family)`` fits it."""
    return Preprocessor(drop_high_missing=drop_high_missing)._fit_all(df, families)


class PreprocessorModel(FittedStep):
    """The fitted steps in order; ``outputs`` are the feature names for the assembler."""

    parts = ("steps",)

    def __init__(self, steps, groups, outputs, kept):
        super().__init__({"groups": groups, "outputs": outputs, "kept": kept})
        self.steps = steps

    @property
    def outputs(self) -> list[str]:
        return self.state["outputs"]

    @property
    def groups(self) -> dict[str, list[str]]:
        return self.state["groups"]

    def _transform(self, df: DataFrame) -> DataFrame:
        categorical = self.state["groups"]["categorical_features"]
        require_columns(df, categorical)
        out = _label_missing(df, categorical)
        for step in self.steps:
            out = step.transform(out)
        kept = [c for c in self.state["kept"] if c in df.columns]
        return out.selectExpr(*[ident(c) for c in kept + self.outputs])


def _label_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return with_expressions(
        df, {c: f"coalesce(CAST({ident(c)} AS STRING), {text(MISSING_LABEL)})" for c in columns}
    )


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """Dense feature vector next to the remaining columns.

    Columns are renamed by position first, since the assembler reads dots and quotes in names.
    """
    chosen = set(features)
    plain = df.selectExpr(
        *[ident(c) for c in df.columns if c not in chosen],
        *[f"{as_double(c)} AS __x{i}" for i, c in enumerate(features)],
    )
    inputs = [f"__x{i}" for i in range(len(features))]
    assembler = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error")
    return assembler.transform(plain).drop(*inputs)


def align_columns(df: DataFrame, training_columns: list[str]) -> DataFrame:
    """Order and subset as in training; an absent column is an error."""
    require_columns(df, training_columns, error=KeyError)
    return df.select(*[col(c) for c in training_columns])


def keep_named(df: DataFrame, names, always=(ID_COLUMN, TARGET_COLUMN)) -> DataFrame:
    """Keep the columns whose name, without a transformer prefix, is in ``names``."""
    wanted = set(names) | set(always)
    return df.select(
        *[col(c).alias(c.split("__")[-1]) for c in df.columns if c.split("__")[-1] in wanted]
    )
