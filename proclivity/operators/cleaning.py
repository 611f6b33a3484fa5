"""Validation rules, whole-number coercion, storage narrowing and range guards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.functions.columns import FLOAT32_MAX, col, half_even
from proclivity.functions.sqltext import ident, number, with_expressions
from proclivity.operators.summary import feature_table
from proclivity.schema import numeric_columns, require_columns

Rule = Callable[[Column], Column]


def outside(low: float, high: float) -> Rule:
    return lambda c: (c < low) | (c > high)


def below(low: float) -> Rule:
    return lambda c: c < low


def not_among(*values) -> Rule:
    return lambda c: ~c.isin(*values)


# Which values of which column are invalid.
DEFAULT_RULES: dict[str, Rule] = {
    "DONOR_AGE": outside(0, 100),
    "CHILDREN": below(0),
    "TARGET_B": not_among(0, 1),
    "RECENT_RESPONSE_PROP": outside(0, 1),
    "RECENT_CARD_RESPONSE_PROP": outside(0, 1),
    "RECENT_AVG_CARD_GIFT_AMT": below(0),
    "MEDIAN_HOUSEHOLD_INCOME": below(0),
    "PER_CAPITA_INCOME": below(0),
}

# Columns that hold whole numbers.
WHOLE_NUMBER_COLUMNS = [
    "DONOR_AGE",
    "CHILDREN",
    "TARGET_B",
    "RECENT_AVG_CARD_GIFT_AMT",
    "MEDIAN_HOUSEHOLD_INCOME",
    "PER_CAPITA_INCOME",
]


def null_invalid(df: DataFrame, rules: dict[str, Rule] | None = None) -> DataFrame:
    """Null every value its rule calls invalid; absent columns are skipped.

    A rule that is null for a row does not fire, since a null condition takes the other branch.
    """
    rules = DEFAULT_RULES if rules is None else rules
    present = {c: rule for c, rule in rules.items() if c in df.columns}
    return df.withColumns(
        {c: F.when(rule(col(c)), None).otherwise(col(c)) for c, rule in present.items()}
    )


def to_whole_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Round numeric values half to even; numeric text becomes its whole number, other text stays."""
    columns = WHOLE_NUMBER_COLUMNS if columns is None else columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for c in columns:
        if c not in kinds:
            continue
        if isinstance(kinds[c], T.StringType):
            whole = half_even(col(c).try_cast("double"), 0).cast("bigint").cast("string")
            changes[c] = F.coalesce(whole, col(c))
        elif isinstance(kinds[c], T.FractionalType):
            changes[c] = half_even(col(c), 0)
    return df.withColumns(changes)


def force_incoherence_to_null(
    df: DataFrame,
    rules: dict[str, Rule] | None = None,
    whole_numbers: list[str] | None = None,
) -> DataFrame:
    """Validation rules, then whole-number coercion; both are plain projections."""
    return to_whole_numbers(null_invalid(df, rules), whole_numbers)


def invalid_counts(df: DataFrame, rules: dict[str, Rule] | None = None) -> DataFrame:
    """``(feature, invalid_count)`` for the rules whose column exists."""
    rules = DEFAULT_RULES if rules is None else rules
    present = [c for c in rules if c in df.columns]
    return feature_table(
        df, present, {"invalid_count": lambda c: F.count_if(rules[c](col(c)))}
    ).orderBy(F.desc("invalid_count"), "feature")


def drop_columns(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Drop columns, and raise when one is absent."""
    if not columns:
        return df
    require_columns(df, columns, error=KeyError)
    return df.drop(*columns)


def infinities_to_null(df: DataFrame) -> DataFrame:
    """Plus and minus infinity become null in every floating column."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return with_expressions(
        df,
        {
            c: f"CASE WHEN abs({ident(c)}) = CAST('Infinity' AS DOUBLE) THEN NULL ELSE {ident(c)} END"
            for c in floating
        },
    )


def beyond_float32_to_null(df: DataFrame) -> DataFrame:
    """Magnitudes that single precision cannot hold become null."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return with_expressions(
        df,
        {
            c: f"CASE WHEN abs({ident(c)}) <= {number(FLOAT32_MAX)} THEN {ident(c)} END"
            for c in floating
        },
    )


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def reduce_storage(df: DataFrame) -> DataFrame:
    """Whole numbers as 32-bit integers, fractions as single precision, where all values of the column fit.

    A column with a value beyond the narrow type stays as it is; ``storage_overflows`` counts such values. Rounding to
    single precision is not an overflow. One pass over the columns that might not fit, none if there are none.
    """
    overflows = {r["feature"]: r["overflows"] for r in storage_overflows(df).collect()}
    changes = {}
    for f in df.schema.fields:
        if overflows.get(f.name):
            continue
        if isinstance(f.dataType, _WHOLE):
            changes[f.name] = col(f.name).cast("int")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            changes[f.name] = col(f.name).cast("float")
    return df.withColumns(changes)


def storage_overflows(df: DataFrame) -> DataFrame:
    """``(feature, overflows)``: values of the 64-bit columns that the 32-bit types cannot hold, infinities aside."""
    longs = {f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)}
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}

    def beyond(c: str) -> str:
        if c in longs:
            return f"count_if({ident(c)} IS NOT NULL AND try_cast({ident(c)} AS INT) IS NULL)"
        return f"count_if(abs({ident(c)}) > {number(FLOAT32_MAX)} AND abs({ident(c)}) < double('Infinity'))"

    wide = [c for c in df.columns if c in longs or c in doubles]
    if not wide:
        return df.sparkSession.createDataFrame([], "feature string, overflows bigint")
    return feature_table(df, wide, {"overflows": beyond})


def drop_all_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows in which all given columns (all numeric ones by default) are null."""
    return df.na.drop("all", subset=columns or numeric_columns(df))
