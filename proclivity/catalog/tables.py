"""Queries: sources, sinks, schema operators and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proclivity.catalog.person_sql import with_persons, with_scores
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import FEATURES, KEYS, NUM, TEXT, r6, unpivoted
from proclivity.catalog.stages_sql import rounded as sql_rounded
from proclivity.catalog.support import rounded, vote_frame
from proclivity.catalog.votes_sql import VOTE_CTES, VOTES
from proclivity.functions.columns import col, decide
from proclivity.operators import cleaning, preprocessing, reshape, selection
from proclivity.plans.persons import build_person_frame, person_frame, score_frame, table
from proclivity.schema import ID_COLUMN, TARGET_COLUMN, feature_types, numeric_columns
from proclivity.session import scratch_dir
from proclivity.sources import files

ALL = ", ".join(KEYS + TEXT) + ", " + sql_rounded(NUM)


def fresh_path(spark, label: str) -> str:
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@register("person_table", with_persons(f"SELECT {ALL} FROM persons"))
def person_table(spark, sf):
    return rounded(build_person_frame(spark, sf).select(*KEYS, *TEXT, *NUM))


@register("csv_scan_train", with_persons(f"SELECT {ALL} FROM persons"))
def csv_scan_train(spark, sf):
    folder = fresh_path(spark, "csv")
    files.write_table(person_frame(spark, sf), f"{folder}/{files.TRAIN_FILE}", "csv")
    return rounded(files.load_train_data(spark, folder).select(*KEYS, *TEXT, *NUM))


@register(
    "csv_scan_test",
    with_persons(f"SELECT CONTROL_NUMBER, {', '.join(TEXT)}, {sql_rounded(NUM)} FROM persons"),
)
def csv_scan_test(spark, sf):
    folder = fresh_path(spark, "csv")
    unlabelled = person_frame(spark, sf).drop(TARGET_COLUMN)
    files.write_table(unlabelled, f"{folder}/{files.TEST_FILE}", "csv")
    return rounded(files.load_test_data(spark, folder).select(ID_COLUMN, *TEXT, *NUM))


@register("parquet_scan_nan_to_null", with_persons(f"SELECT CONTROL_NUMBER, {r6('DONOR_AGE')} AS DONOR_AGE FROM persons"))
def parquet_scan_nan_to_null(spark, sf):
    folder = fresh_path(spark, "nan")
    age = F.coalesce(F.col("DONOR_AGE"), F.lit(float("nan")))
    files.write_table(person_frame(spark, sf).withColumn("DONOR_AGE", age), f"{folder}/people.parquet")
    back = files.load_train_data(spark, folder, "people.parquet")
    return rounded(back.select(ID_COLUMN, "DONOR_AGE"))


@register("label_scan", with_persons("SELECT CONTROL_NUMBER, TARGET_B FROM persons"))
def label_scan(spark, sf):
    return files.load_labels(person_frame(spark, sf))


@register("selection_file_round_trip", with_persons(f"SELECT method, feature FROM ({VOTES})", *VOTE_CTES))
def selection_file_round_trip(spark, sf):
    path = fresh_path(spark, "selection")
    files.write_selection(vote_frame(spark, sf), path)
    return files.read_selection(spark, path)


@register(
    "selection_lists",
    with_persons(
        f"SELECT method, string_agg(feature, ',' ORDER BY feature) AS features FROM ({VOTES}) GROUP BY 1",
        *VOTE_CTES,
    ),
)
def selection_lists(spark, sf):
    return files.selection_lists(vote_frame(spark, sf)).select(
        "method", F.array_join("features", ",").alias("features")
    )


@register(
    "clean_split_files",
    with_persons(f"SELECT {ALL} FROM persons"),
)
def clean_split_files(spark, sf):
    folder = fresh_path(spark, "split")
    files.write_split(person_frame(spark, sf), folder, "train")
    features = spark.read.parquet(f"{folder}/X_train_clean")
    labels = spark.read.parquet(f"{folder}/y_train_clean")
    return rounded(files.attach_target(features, labels).select(*KEYS, *TEXT, *NUM))


_SUBMISSION = with_scores(
    "SELECT CONTROL_NUMBER, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS TARGET_B FROM scores"
)


@register("submission_table", _SUBMISSION)
def submission_table(spark, sf):
    scored = score_frame(spark, sf).withColumn("prediction", decide(F.col("score"), 0.5))
    return files.build_submission(scored)


@register("submission_file_round_trip", _SUBMISSION)
def submission_file_round_trip(spark, sf):
    path = files.save_submission(submission_table(spark, sf), fresh_path(spark, "submission"))
    return spark.read.schema("CONTROL_NUMBER long, TARGET_B int").option("header", True).csv(path)


@register(
    "experiment_log",
    with_scores(
        f"SELECT 'threshold' AS model, {r6('avg(CASE WHEN (score >= t) = (TARGET_B = 1) THEN 1.0 ELSE 0.0 END)')} AS f1, "
        "CAST(t AS VARCHAR) AS threshold FROM scores CROSS JOIN (VALUES (0.25), (0.75)) AS v(t) GROUP BY t"
    ),
)
def experiment_log(spark, sf):
    path = fresh_path(spark, "log")
    for t in (0.25, 0.75):
        hit = (decide(F.col("score"), t) == F.col(TARGET_COLUMN)).cast("double")
        value = score_frame(spark, sf).agg(F.avg(hit).alias("v")).first()["v"]
        files.append_experiment(spark, path, "threshold", value, {"threshold": t})
    log = spark.read.parquet(path)
    return rounded(log.select("model", "f1", F.col("parameters")["threshold"].alias("threshold")))


# Schema operators ----------------------------------------------------------------------------


@register(
    "features_without_target",
    with_persons(f"SELECT {', '.join(TEXT)}, {sql_rounded(NUM)} FROM persons"),
)
def features_without_target(spark, sf):
    features, _ = files.split_features_target(person_frame(spark, sf), drop_id=True)
    return rounded(features.select(*TEXT, *NUM))


_IS_NUMERIC = "feature IN (" + ", ".join(f"'{c}'" for c in NUM) + ")"


@register(
    "feature_types",
    with_persons(
        f"SELECT feature, CASE WHEN {_IS_NUMERIC} THEN 'numeric_features' ELSE 'categorical_features' END AS kind, \"values\" FROM ("
        + unpivoted("persons", FEATURES, lambda c: f'count({c}) AS "values"')
        + ")"
    ),
)
def feature_types_table(spark, sf):
    df = person_frame(spark, sf)
    kinds = feature_types(df)
    rows = [(k, c) for k in ("numeric_features", "categorical_features") for c in kinds[k]]
    shares = cleaning.feature_table(
        df, kinds["all_features"], {"values": lambda c: F.count(col(c))}
    )
    return spark.createDataFrame(rows, "kind string, feature string").join(shares, "feature")


@register(
    "numeric_column_subset",
    with_persons(f"SELECT CONTROL_NUMBER, {sql_rounded(['DONOR_AGE', 'CHILDREN'])} FROM persons"),
)
def numeric_column_subset(spark, sf):
    df = person_frame(spark, sf)
    kept = numeric_columns(df, ["DONOR_AGE", "SES", "CHILDREN", "NO_SUCH_COLUMN"])
    return rounded(df.select(ID_COLUMN, *kept))


@register(
    "high_missing_share",
    with_persons(
        f"SELECT 'WEALTH_RATING' AS feature, {r6('avg(CASE WHEN WEALTH_RATING IS NULL THEN 1.0 ELSE 0.0 END)')} "
        "AS null_share, avg(CASE WHEN WEALTH_RATING IS NULL THEN 1.0 ELSE 0.0 END) >= 0.4 AS dropped FROM persons"
    ),
)
def high_missing_share(spark, sf):
    df = person_frame(spark, sf)
    dropped = preprocessing.feature_groups(df)["dropped_high_missing_features"]
    shares = cleaning.feature_table(
        df, ["WEALTH_RATING"], {"null_share": lambda c: F.avg(col(c).isNull().cast("double"))}
    )
    return rounded(shares.withColumn("dropped", F.col("feature").isin(*dropped, "")))


@register(
    "income_group_as_text",
    with_persons("SELECT CONTROL_NUMBER, CAST(INCOME_GROUP AS VARCHAR) AS INCOME_GROUP FROM persons"),
)
def income_group_as_text(spark, sf):
    df = preprocessing.prepare_modeling_frame(person_frame(spark, sf), True)
    return df.select(ID_COLUMN, "INCOME_GROUP")


@register(
    "dropped_columns",
    with_persons(
        f"SELECT CONTROL_NUMBER, TARGET_B, {', '.join(TEXT)}, "
        f"{sql_rounded([c for c in NUM if c not in ('WEALTH_RATING', 'PEP_STAR')])} FROM persons"
    ),
)
def dropped_columns(spark, sf):
    return rounded(cleaning.drop_columns(person_frame(spark, sf), ["WEALTH_RATING", "PEP_STAR"]))


@register(
    "reduced_storage",
    f"SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, "
    f"{r6('CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE)')} AS price, "
    f"{r6('CAST(CAST(l_discount AS FLOAT) AS DOUBLE)')} AS discount FROM lineitem",
)
def reduced_storage(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"
    )
    small = cleaning.reduce_storage(lines)
    return rounded(
        small.select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").cast("double").alias("price"),
            F.col("l_discount").cast("double").alias("discount"),
        )
    )


@register(
    "storage_overflows",
    "SELECT 'big' AS feature, count(*) FILTER (o_orderkey * 1000000 > 2147483647) AS overflows FROM orders "
    "UNION ALL SELECT 'o_orderkey', count(*) FILTER (o_orderkey > 2147483647) FROM orders "
    "UNION ALL SELECT 'huge', count(*) FILTER (o_totalprice > 100000) FROM orders",
)
def storage_overflows(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") * 1_000_000).alias("big"),
        F.when(F.col("o_totalprice") > 100_000, F.lit(1e39)).otherwise(F.lit(1.5)).alias("huge"),
    )
    return cleaning.storage_overflows(orders)


@register(
    "aligned_columns",
    with_persons(f"SELECT {sql_rounded(['PEP_STAR', 'CHILDREN', 'DONOR_AGE'])}, CONTROL_NUMBER FROM persons"),
)
def aligned_columns(spark, sf):
    order = ["PEP_STAR", "CHILDREN", "DONOR_AGE", ID_COLUMN]
    return rounded(preprocessing.align_columns(person_frame(spark, sf), order))


@register(
    "columns_kept_by_name",
    with_persons(f"SELECT CONTROL_NUMBER, TARGET_B, {sql_rounded(['DONOR_AGE', 'PEP_STAR'])} FROM persons"),
)
def columns_kept_by_name(spark, sf):
    df = person_frame(spark, sf).withColumnRenamed("DONOR_AGE", "continuous_numeric__DONOR_AGE")
    return rounded(preprocessing.keep_named(df, ["DONOR_AGE", "PEP_STAR", "NO_SUCH_COLUMN"]))


_LISTED = ", ".join(f"'{c}'" for c in FEATURES)
_CODED = ", ".join(f"'{c}'" for c in preprocessing.CODED_NUMERIC_FEATURES)
_GAP_TESTS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature FROM persons HAVING avg(CAST({c} IS NULL AS DOUBLE)) >= {preprocessing.HIGH_MISSING_THRESHOLD}"
    for c in preprocessing.HIGH_MISSING_CANDIDATES
)


@register(
    "feature_group_summary",
    with_persons(
        "SELECT feature_group, count(feature) AS n_features, coalesce(string_agg(feature, ', ' ORDER BY feature), '') AS features "
        "FROM (SELECT unnest([" + ", ".join(f"'{g}'" for g in preprocessing.GROUPS) + "]) AS feature_group) "
        "LEFT JOIN placed USING (feature_group) GROUP BY 1",
        f"gone AS ({_GAP_TESTS})",
        "placed AS (SELECT feature, CASE WHEN feature IN (FROM gone) THEN 'dropped_high_missing_features' "
        f"WHEN feature IN ({_CODED}) THEN 'coded_numeric_features' WHEN {_IS_NUMERIC} THEN 'continuous_numeric_features' "
        f"ELSE 'categorical_features' END AS feature_group FROM (SELECT unnest([{_LISTED}]) AS feature))",
    ),
)
def feature_group_summary(spark, sf):
    df = person_frame(spark, sf)
    return preprocessing.feature_group_summary(df, preprocessing.feature_groups(df))


@register(
    "literal_and_gap_columns",
    with_persons(
        "SELECT CONTROL_NUMBER, 'raw' AS scenario, "
        f"{r6('RECENT_RESPONSE_PROP - RECENT_CARD_RESPONSE_PROP')} AS gap FROM persons"
    ),
)
def literal_and_gap_columns(spark, sf):
    df = person_frame(spark, sf)
    return rounded(
        df.select(
            ID_COLUMN,
            F.lit("raw").alias("scenario"),
            (F.col("RECENT_RESPONSE_PROP") - F.col("RECENT_CARD_RESPONSE_PROP")).alias("gap"),
        )
    )


# Joins ---------------------------------------------------------------------------------------


@register(
    "features_joined_with_target",
    with_persons(f"SELECT CONTROL_NUMBER, {r6('DONOR_AGE')} AS DONOR_AGE, TARGET_B FROM persons"),
)
def features_joined_with_target(spark, sf):
    df = person_frame(spark, sf)
    return rounded(
        files.attach_target(df.select(ID_COLUMN, "DONOR_AGE"), files.load_labels(df))
    )


@register(
    "positional_attach_by_key",
    with_scores(
        f"SELECT CONTROL_NUMBER, {r6('score')} AS score, TARGET_B FROM scores"
    ),
)
def positional_attach_by_key(spark, sf):
    scored = score_frame(spark, sf)
    return rounded(
        files.attach_target(scored.select(ID_COLUMN, "score"), scored.select(ID_COLUMN, TARGET_COLUMN))
    )


@register(
    "features_kept_by_vote",
    with_persons(
        f"SELECT DISTINCT feature FROM prof WHERE feature IN (SELECT feature FROM ({VOTES}) WHERE method = 'consensus')",
        *VOTE_CTES,
    ),
)
def features_kept_by_vote(spark, sf):
    votes = vote_frame(spark, sf)
    every = selection.names(spark, NUM)
    return selection.keep_features(every, votes.where(F.col("method") == "consensus"))


@register(
    "features_dropped_by_vote",
    with_persons(
        f"SELECT DISTINCT feature FROM prof WHERE feature NOT IN (SELECT feature FROM ({VOTES}) WHERE method = 'consensus')",
        *VOTE_CTES,
    ),
)
def features_dropped_by_vote(spark, sf):
    votes = vote_frame(spark, sf)
    every = selection.names(spark, NUM)
    return selection.drop_features(every, votes.where(F.col("method") == "consensus"))


@register(
    "tidy_metrics",
    with_scores(
        "SELECT unnest(['persons', 'target_rate', 'mean_score']) AS metric, "
        f"unnest([{r6('CAST(count(*) AS DOUBLE)')}, {r6('avg(TARGET_B)')}, {r6('avg(score)')}]) AS value FROM scores"
    ),
)
def tidy_metrics(spark, sf):
    row = score_frame(spark, sf).agg(
        F.count(F.lit(1)).alias("persons"),
        F.avg(TARGET_COLUMN).alias("target_rate"),
        F.avg("score").alias("mean_score"),
    )
    return rounded(reshape.metric_table(row))
