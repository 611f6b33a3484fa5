"""CSV, Parquet and JSON readers and writers of the person tables and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.functions.columns import col
from proclivity.operators.selection import METHODS
from proclivity.schema import ID_COLUMN, TARGET_COLUMN, person_schema, require_columns

# Default file names.
TRAIN_FILE = "donors_train.csv"
TEST_FILE = "donors_test.csv"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes null, the only missing value used here."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floating})


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header under a declared schema; columns are matched by name, not by position.

    The header is read once to order the schema; a declared column the file lacks becomes null. Columns the
    schema lacks follow the declared ones, as text.
    """
    header = spark.read.option("header", True).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    in_file = T.StructType(
        [declared.get(c, T.StructField(c, T.StringType())) for c in header]
    )
    df = spark.read.schema(in_file).option("header", True).option("enforceSchema", True).csv(path)
    columns = [
        (col(f.name) if f.name in header else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return nan_to_null(df.select(*columns, *[col(c) for c in header if c not in declared]))


def load_train_data(
    spark: SparkSession, data_dir: str, filename: str = TRAIN_FILE, schema=None
) -> DataFrame:
    """The training table with key and target as columns."""
    return _load(spark, f"{data_dir}/{filename}", schema or person_schema())


def load_test_data(
    spark: SparkSession, data_dir: str, filename: str = TEST_FILE, schema=None
) -> DataFrame:
    """The test table, without target."""
    return _load(spark, f"{data_dir}/{filename}", schema or person_schema(with_target=False))


def _load(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
        declared = {f.name for f in schema.fields}
        columns = [
            (col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        return nan_to_null(df.select(*columns, *[col(c) for c in df.columns if c not in declared]))
    return read_csv(spark, path, schema)


def load_labels(df: DataFrame, key: str = ID_COLUMN, target: str = TARGET_COLUMN) -> DataFrame:
    """Key and target only."""
    return df.select(col(key), col(target))


def split_features_target(
    df: DataFrame, target: str = TARGET_COLUMN, drop_id: bool = False, key: str = ID_COLUMN
) -> tuple[DataFrame, DataFrame]:
    """Features and ``(key, target)``; the key keeps the two together, not row order."""
    require_columns(df, [target], "target", KeyError)
    features = df.drop(target)
    if drop_id and key in features.columns:
        features = features.drop(key)
    labels = df.select(*[col(c) for c in (key, target) if c in df.columns])
    return features, labels


def attach_target(features: DataFrame, labels: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """Left join of the labels by key."""
    return features.join(labels, key, "left")


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """``(method, feature)`` rows of a selection file: one object of string arrays."""
    schema = T.StructType([T.StructField(m, T.ArrayType(T.StringType())) for m in METHODS])
    lists = spark.read.schema(schema).option("multiLine", True).json(path)
    named = F.array(
        *[F.struct(F.lit(m).alias("method"), F.col(m).alias("features")) for m in METHODS]
    )
    return lists.select(F.inline(named)).select("method", F.explode("features").alias("feature"))


def selection_lists(selection: DataFrame) -> DataFrame:
    """``(method, features)`` with the sorted distinct names of each method."""
    return selection.groupBy("method").agg(
        F.array_sort(F.collect_set("feature")).alias("features")
    )


def write_selection(selection: DataFrame, path: str) -> None:
    """One JSON object with a sorted list per method; the names are bounded by the schema."""
    one = selection_lists(selection).groupBy().pivot("method", list(METHODS)).agg(F.first("features"))
    one.select(
        *[F.coalesce(F.col(m), F.array().cast("array<string>")).alias(m) for m in METHODS]
    ).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Parquet (default) or CSV with header, one file per partition."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format {kind!r} is not parquet or csv")


def write_split(df: DataFrame, directory: str, split: str, target: str = TARGET_COLUMN, kind="parquet"):
    """Features and labels of one split as two tables."""
    features, labels = split_features_target(df, target)
    write_table(features, f"{directory}/X_{split}_clean", kind)
    write_table(labels, f"{directory}/y_{split}_clean", kind)


def build_submission(
    scored: DataFrame,
    prediction: str = "prediction",
    key: str = ID_COLUMN,
    target: str = TARGET_COLUMN,
) -> DataFrame:
    """Key and predicted label; both come from the same row, so nothing is paired by position."""
    return scored.select(col(key), col(prediction).cast("int").alias(target))


def save_submission(submission: DataFrame, path: str) -> str:
    write_table(submission, path, "csv")
    return path


def append_experiment(
    spark: SparkSession, path: str, model: str, f1: float, parameters: dict
) -> None:
    """Append one experiment to the log table."""
    row = [(model, float(f1), {k: str(v) for k, v in parameters.items()})]
    spark.createDataFrame(row, "model string, f1 double, parameters map<string,string>").withColumn(
        "logged_at", F.current_timestamp()
    ).write.mode("append").parquet(path)
