"""Edge semantics on a few rows, error contracts and properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from proclivity.functions.columns import half_even, safe_divide
from proclivity.operators import (
    cleaning,
    correlation,
    encoding,
    evaluation,
    imputation,
    missingness,
    outliers,
    preprocessing,
    profiling,
    scaling,
    selection,
    splitting,
    summary,
)
from proclivity.operators.features import add_engineered_features
from proclivity.plans.cleaning_chain import CleaningChain
from proclivity.plans.persons import person_frame
from proclivity.schema import ID_COLUMN, NUMERIC_COLUMNS, TARGET_COLUMN, TEXT_COLUMNS
from proclivity.sources import files


def column(df, name):
    return [r[name] for r in df.collect()]


def doubles(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_adjusted_skew(spark):
    got = summary.adjusted_skewness(doubles(spark, 2.0, 4.0, 9.0, 0.00125), ["x"])
    assert math.isclose(got["x"], 1.0028, abs_tol=1e-4)
    assert summary.adjusted_skewness(doubles(spark, 5.1, 5.1, 5.1), ["x"]) == {"x": 0.0}
    assert summary.adjusted_skewness(doubles(spark, 1.0, 2.0, None), ["x"]) == {"x": None}


@pytest.mark.parametrize("strategy", ["standard", "minmax", "robust"])
def test_constant_column_scales_to_zero(spark, strategy):
    out = scaling.numeric_scaler(strategy).fit_transform(doubles(spark, 5.0, 5.0, 5.0))
    assert column(out, "x") == [0.0, 0.0, 0.0]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "a double, b double")
    got = {(r[0], r[1]): r["correlation"] for r in correlation.pearson_matrix(df).collect()}
    assert got["a", "b"] is None and got["a", "a"] is None
    assert math.isclose(got["b", "b"], 1.0)


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    out = imputation.ColumnImputer({"x": "most_frequent"}).fit_transform(df)
    assert column(out, "x")[-1] == "a"


def test_half_even(spark):
    df = doubles(spark, 2.5, 3.5, 0.00125, 170601.07625)
    assert column(df.select(half_even(F.col("x"), 0).alias("x")), "x")[:2] == [2.0, 4.0]
    got = column(df.select(half_even(F.col("x")).alias("x")), "x")
    assert got == [float(np.round(v, 4)) for v in (2.5, 3.5, 0.00125, 170601.07625)]


def test_zero_denominator(spark):
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 2.0)], "a double, b double")
    assert column(df.select(safe_divide(F.col("a"), F.col("b")).alias("q")), "q") == [None, 1.5]


def test_rare_flag_is_log_transformed_unless_excluded(spark):
    df = spark.range(100).select((F.col("id") < 3).cast("double").alias("x"))
    out = outliers.OutlierRescaler().fit_transform(df)
    assert sorted(set(column(out, "x"))) == [0.0, 0.6931]
    out = outliers.OutlierRescaler(exclude_indicators=True).fit_transform(df)
    assert sorted(set(column(out, "x"))) == [0.0, 1.0]


def test_constant_column_binning(spark):
    for bins, want in ((4, 1), (5, 2)):
        rescaler = outliers.OutlierRescaler(["x"], "binning", bins=bins)
        assert column(rescaler.fit_transform(doubles(spark, 3.0, 3.0, None)), "x") == [want, want, None]


def test_all_null_column(spark):
    df = doubles(spark, None, None)
    assert outliers.detect_outlier_columns(df) == []
    assert outliers.outlier_counts(df).first()["outlier_percent"] == 0.0
    assert column(imputation.ColumnImputer({"x": "mean"}).fit_transform(df), "x") == [None, None]


def test_unseen_category(spark):
    seen = spark.createDataFrame([("A",), ("B",)], "x string")
    new = spark.createDataFrame([("C",)], "x string")
    assert encoding.OneHotEncoder().fit(seen).transform(new).first().asDict() == {"x_A": 0.0, "x_B": 0.0}
    assert encoding.OrdinalEncoder().fit(seen).transform(new).first()["x"] == -1.0
    with pytest.raises(Exception, match="unknown category"):
        encoding.OneHotEncoder(handle_unknown="error").fit(seen).transform(new).collect()


def test_category_limit(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError):
        encoding.fitted_categories(df, ["x"], limit=10)


def test_odd_category_names(spark):
    df = spark.createDataFrame([("it's",), ("a.b",), ("back\\slash",), ("tick`",)], "x string")
    out = encoding.OneHotEncoder().fit_transform(df)
    assert out.columns == ["x_a.b", "x_back\\slash", "x_it's", "x_tick`"]
    assert [sum(r) for r in out.collect()] == [1.0] * 4
    assert preprocessing.assemble(out, out.columns).count() == 4


def test_strata_fallback(spark):
    rows = [("H", "C", 10.0), ("H", "C", 20.0), ("H", "R", 40.0), ("H", None, None), (None, "C", None), ("U", "R", None)]
    df = spark.createDataFrame(rows, "HOME_OWNER string, URBANICITY string, DONOR_AGE double")
    out = imputation.MnarImputer().fit_transform(df).collect()
    got = {(r["HOME_OWNER"], r["URBANICITY"], r["DONOR_AGE_MISSING"]): r["DONOR_AGE"] for r in out}
    assert got["H", None, 1] == 20.0 and got[None, "C", 1] == 20.0 and got["U", "R", 1] == 20.0
    assert len(out) == 6


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), "score double, TARGET_B int")


def test_auc_with_ties(spark):
    df = scored(spark, (0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.3, 1))
    assert math.isclose(evaluation.roc_auc(df).first()[0], 0.75)
    monotone = df.withColumn("score", F.exp("score"))
    assert math.isclose(evaluation.roc_auc(monotone).first()[0], 0.75)


def test_one_class(spark):
    row = evaluation.probability_metrics(scored(spark, (0.1, 0), (0.9, 0))).first()
    assert row["f1"] == 0.0 and row["roc_auc"] is None


def test_threshold_search_on_nothing(spark):
    row = evaluation.best_f1_threshold(scored(spark).limit(0)).first()
    assert row["threshold"] == 0.5


def test_vector_scores(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0.2, 0.8), 1), (Vectors.dense(0.9, 0.1), 0)], ["p", "TARGET_B"])
    assert evaluation.roc_auc(df, "p").first()[0] == 1.0
    with pytest.raises(ValueError):
        evaluation.positive_score(df.withColumn("t", F.lit("x")), "t")


def test_votes(spark):
    rows = [("filter", "a"), ("filter", "b"), ("wrapper", "b"), ("wrapper", "c"), ("embedded", "c")]
    votes = spark.createDataFrame(rows, "method string, feature string")
    assert sorted(column(selection.consensus(votes), "feature")) == ["b", "c"]


@pytest.mark.parametrize(
    ("f", "within", "p"),
    # Squares of tabulated two-sided 5 % and 1 % points of t, and the normal limit.
    [(2.2281389**2, 10, 0.05), (3.1692727**2, 10, 0.01), (1.9599640**2, 1e9, 0.05), (2.0422725**2, 30, 0.05)],
)
def test_f_tail(f, within, p):
    assert math.isclose(selection.f_tail_one(f, within), p, rel_tol=1e-5)


def test_filter_family_finds_signal(spark):
    df = spark.range(2000).select(
        (F.col("id") % 2).cast("int").alias(TARGET_COLUMN),
        ((F.col("id") % 2) + (F.col("id") * 37 % 11) / 20).alias("signal"),
        (F.col("id") * 7919 % 1009).cast("double").alias("noise"),
        F.lit(1.0).alias("flat"),
    )
    names = ["signal", "noise", "flat"]
    got = selection.filter_family(
        profiling.variances(df, names),
        correlation.spearman_with_target(df, names),
        selection.anova_test(df, names),
    )
    assert column(got, "feature") == ["signal"]


def test_mnar_analysis_finds_planted_gap(spark):
    x = (F.col("id") * 7919 % 1009).cast("double")
    df = spark.range(3000).select(
        x.alias("a"),
        (F.col("id") * 31 % 101).cast("double").alias("b"),
        F.when(x > 600, None).otherwise(F.col("id").cast("double")).alias("hidden"),
    )
    row = missingness.analyse_mnar(df, max_iter=50).first()
    assert row["variable"] == "hidden" and row["verdict"] == "MNAR"
    assert row["top_predictors"].startswith("a")
    assert missingness.analyse_mnar(df.select("a", "b")).count() == 0


# Error contracts -----------------------------------------------------------------------------


def test_errors_before_any_job(spark):
    df = doubles(spark, 1.0)
    with pytest.raises(ValueError):
        imputation.ColumnImputer({"y": "mean"}).fit(df)
    with pytest.raises(ValueError):
        imputation.ColumnImputer({"x": "nope"}).fit(df)
    with pytest.raises(ValueError):
        imputation.numeric_imputer("nope")
    with pytest.raises(ValueError):
        imputation.categorical_imputer("mean")
    with pytest.raises(ValueError):
        scaling.numeric_scaler("nope")
    with pytest.raises(ValueError):
        encoding.categorical_encoder("nope")
    with pytest.raises(NotImplementedError):
        encoding.categorical_encoder("target")
    with pytest.raises(ValueError):
        outliers.OutlierRescaler(method="nope")
    with pytest.raises(ValueError):
        outliers.OutlierRescaler(method="binning")
    with pytest.raises(ValueError):
        outliers.OutlierRescaler(method="binning", bins=1)
    with pytest.raises(ValueError):
        outliers.flag_outliers(df, [])
    with pytest.raises(KeyError):
        outliers.flag_outliers(df, ["y"])
    with pytest.raises(KeyError):
        cleaning.drop_columns(df, ["y"])
    with pytest.raises(KeyError):
        files.split_features_target(df)
    with pytest.raises(KeyError):
        preprocessing.align_columns(df, ["y"])
    with pytest.raises(KeyError):
        evaluation.best_threshold(df, metric="nope")
    with pytest.raises(ValueError):
        profiling.category_target_rates(df, "x")
    with pytest.raises(ValueError):
        profiling.category_frequencies(df)
    with pytest.raises(ValueError):
        correlation.target_correlations(df, "x", "kendall")


# Properties ----------------------------------------------------------------------------------


def test_no_nulls_after_imputation_and_flags_match(spark, sf):
    df = person_frame(spark, sf)
    valid = cleaning.force_incoherence_to_null(df)
    mnar = imputation.MnarImputer().fit_transform(valid)
    full = imputation.ColumnImputer(imputation.DEFAULT_STRATEGIES).fit_transform(mnar)
    assert profiling.columns_with_nulls(full, NUMERIC_COLUMNS + TEXT_COLUMNS) == []
    flags = valid.select(ID_COLUMN, F.col("DONOR_AGE").isNull().cast("int").alias("gap"))
    wrong = mnar.join(flags, ID_COLUMN).where(F.col("gap") != F.col("DONOR_AGE_MISSING"))
    assert wrong.count() == 0


def test_one_hot_rows_sum_to_one(spark, sf):
    df = person_frame(spark, sf).select("SES")
    out = encoding.OneHotEncoder().fit_transform(df)
    assert {sum(r) for r in out.collect()} == {1.0}


def test_chain_is_the_same_twice(spark, sf):
    df = person_frame(spark, sf)
    model = CleaningChain(encode="onehot").fit(df)
    a, b = model.transform(df), CleaningChain(encode="onehot").fit_transform(df)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0


def test_state_round_trip(spark, sf, tmp_path):
    df = person_frame(spark, sf).select("DONOR_AGE", "CHILDREN")
    model = imputation.ColumnImputer({"DONOR_AGE": "mean", "CHILDREN": "median"}).fit(df)
    model.save_state(spark, str(tmp_path / "s"))
    back = imputation.ImputerModel.load_state(spark, str(tmp_path / "s"))
    assert back.transform(df).exceptAll(model.transform(df)).count() == 0


def test_pipeline_composition(spark, sf):
    from pyspark.ml import Pipeline

    df = person_frame(spark, sf).select(ID_COLUMN, "DONOR_AGE", "SES")
    stages = [imputation.ColumnImputer({"DONOR_AGE": "median"}), scaling.numeric_scaler("robust", ["DONOR_AGE"]), encoding.OneHotEncoder()]
    out = Pipeline(stages=stages).fit(df).transform(df)
    assert "SES_1" in out.columns and out.where(F.col("DONOR_AGE").isNull()).count() == 0


@pytest.mark.parametrize("prefix", [1, 4])
def test_split_is_exact_and_complete(spark, prefix):
    df = spark.range(5000).select(
        F.col("id").alias(ID_COLUMN), (F.col("id") % 10 == 0).cast("int").alias(TARGET_COLUMN)
    )
    old, splitting.PREFIX_DIGITS = splitting.PREFIX_DIGITS, prefix
    try:
        out = splitting.stratified_split(df, 0.7)
    finally:
        splitting.PREFIX_DIGITS = old
    got = {(r[TARGET_COLUMN], r["split"]): r["count"] for r in out.groupBy(TARGET_COLUMN, "split").count().collect()}
    assert got == {(0, "train"): 3150, (0, "val"): 1350, (1, "train"): 350, (1, "val"): 150}
    assert out.count() == 5000


def test_folds_balance_small_classes(spark):
    df = spark.range(23).select(
        F.col("id").alias(ID_COLUMN), (F.col("id") < 3).cast("int").alias(TARGET_COLUMN)
    )
    out = splitting.stratified_folds(df).collect()
    big = [r["fold"] for r in out if r[TARGET_COLUMN] == 0]
    small = [r["fold"] for r in out if r[TARGET_COLUMN] == 1]
    assert [big.count(i) for i in range(5)] == [4] * 5
    assert len(set(small)) == 3


def test_partial_inputs_give_partial_features(spark):
    df = spark.createDataFrame([(10.0, 4.0)], "LIFETIME_GIFT_AMOUNT double, LIFETIME_GIFT_COUNT double")
    assert add_engineered_features(df).first().asDict()["AVG_GIFT_PER_DONATION"] == 2.5
    assert add_engineered_features(df).columns[2:] == ["AVG_GIFT_PER_DONATION"]


def test_group_detection_before_and_after_fill(spark):
    df = spark.createDataFrame([(None,), (None,), (3.0,)], "WEALTH_RATING double")
    assert preprocessing.feature_groups(df)["dropped_high_missing_features"] == ["WEALTH_RATING"]
    filled = imputation.MnarImputer().fit_transform(df)
    assert preprocessing.feature_groups(filled)["coded_numeric_features"] == ["WEALTH_RATING"]


def test_csv_columns_by_name(spark, tmp_path):
    path = tmp_path / "donors_train.csv"
    path.write_text("CONTROL_NUMBER,SES,TARGET_B,DONOR_AGE\n1,?,0,\n2,3,1,NaN\n3,4,1,41.5\n")
    df = files.load_train_data(spark, str(tmp_path)).orderBy(ID_COLUMN)
    got = [(r["SES"], r["TARGET_B"], r["DONOR_AGE"], r["CHILDREN"]) for r in df.collect()]
    assert got == [("?", 0, None, None), ("3", 1, None, None), ("4", 1, 41.5, None)]
