"""Column names, declared types and fixed rule tables of the person-level table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ID_COLUMN = "CONTROL_NUMBER"
TARGET_COLUMN = "TARGET_B"

# The declared columns of the person table, text ones and numeric ones.
TEXT_COLUMNS = [
    "DONOR_GENDER",
    "HOME_OWNER",
    "RECENCY_STATUS_96NK",
    "SES",
    "URBANICITY",
]
NUMERIC_COLUMNS = [
    "CARD_PROM_12",
    "CHILDREN",
    "DONOR_AGE",
    "FILE_CARD_GIFT",
    "FREQUENCY_STATUS_97NK",
    "INCOME_GROUP",
    "LAST_GIFT_AMT",
    "LIFETIME_CARD_PROM",
    "LIFETIME_GIFT_AMOUNT",
    "LIFETIME_GIFT_COUNT",
    "LIFETIME_MAX_GIFT_AMT",
    "LIFETIME_MIN_GIFT_AMT",
    "LIFETIME_PROM",
    "MEDIAN_HOME_VALUE",
    "MEDIAN_HOUSEHOLD_INCOME",
    "MONTHS_SINCE_FIRST_GIFT",
    "MONTHS_SINCE_LAST_GIFT",
    "MONTHS_SINCE_LAST_PROM_RESP",
    "NUMBER_PROM_12",
    "PCT_ATTRIBUTE1",
    "PCT_ATTRIBUTE2",
    "PCT_ATTRIBUTE3",
    "PCT_ATTRIBUTE4",
    "PCT_OWNER_OCCUPIED",
    "PEP_STAR",
    "PER_CAPITA_INCOME",
    "RECENT_AVG_CARD_GIFT_AMT",
    "RECENT_AVG_GIFT_AMT",
    "RECENT_CARD_RESPONSE_COUNT",
    "RECENT_CARD_RESPONSE_PROP",
    "RECENT_RESPONSE_COUNT",
    "RECENT_RESPONSE_PROP",
    "RECENT_STAR_STATUS",
    "WEALTH_RATING",
]


def person_schema(with_target: bool = True) -> T.StructType:
    """Declared schema of the person table: key, optional target, then the features by name."""
    fields = [T.StructField(ID_COLUMN, T.LongType())]
    if with_target:
        fields.append(T.StructField(TARGET_COLUMN, T.IntegerType()))
    kinds = dict.fromkeys(TEXT_COLUMNS, T.StringType())
    kinds.update(dict.fromkeys(NUMERIC_COLUMNS, T.DoubleType()))
    fields += [T.StructField(name, kinds[name]) for name in sorted(kinds)]
    return T.StructType(fields)


def numeric_columns(df: DataFrame, columns: list[str] | None = None, exclude=()) -> list[str]:
    """Numeric columns of the frame, or those of the given ones that exist and are numeric."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wanted = df.columns if columns is None else columns
    return [
        c for c in wanted if c in kinds and isinstance(kinds[c], T.NumericType) and c not in exclude
    ]


def text_columns(df: DataFrame, columns: list[str] | None = None, exclude=()) -> list[str]:
    """String columns of the frame, or those of the given ones that exist and are strings."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wanted = df.columns if columns is None else columns
    return [
        c for c in wanted if c in kinds and isinstance(kinds[c], T.StringType) and c not in exclude
    ]


def feature_types(
    df: DataFrame, target: str = TARGET_COLUMN, key: str = ID_COLUMN
) -> dict[str, list[str]]:
    """All, numeric and categorical feature names, without key and target."""
    features = [c for c in df.columns if c not in (target, key)]
    numeric = numeric_columns(df, features)
    return {
        "all_features": features,
        "numeric_features": numeric,
        "categorical_features": [c for c in features if c not in set(numeric)],
    }


def require_columns(df: DataFrame, columns, what: str = "Column", error=ValueError) -> None:
    """Raise before any job starts when a named column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise error(f"{what} not found in the frame: {absent}")
