"""Queries: validation, coercion, guards, outliers, imputation, the whole chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.catalog.person_sql import with_persons
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import (
    CLEAN_STAGES,
    FLAGS,
    IMPUTED,
    KEYS,
    MNAR,
    NUM,
    OUTLIER_COLUMNS,
    SHAPES,
    TEXT,
    VALID,
    each,
    mode_of,
    onehot_list,
    r6,
    rounded as sql_rounded,
    staged,
    unpivoted,
)
from proclivity.catalog.support import rounded
from proclivity.functions.columns import col
from proclivity.operators import cleaning, imputation, outliers
from proclivity.operators.features import add_engineered_features
from proclivity.operators.quantiles import exact_quantiles
from proclivity.plans.cleaning_chain import CleaningChain
from proclivity.plans.persons import person_frame, table
from proclivity.schema import ID_COLUMN, TARGET_COLUMN

RULED = [c for c in cleaning.DEFAULT_RULES if c != TARGET_COLUMN]


def valid_frame(spark, sf) -> DataFrame:
    return cleaning.force_incoherence_to_null(person_frame(spark, sf))


def imputed_frame(spark, sf) -> DataFrame:
    valid = valid_frame(spark, sf)
    mnar = imputation.MnarImputer().fit_transform(valid)
    return imputation.ColumnImputer(imputation.DEFAULT_STRATEGIES).fit_transform(mnar)


@register(
    "response_by_urbanicity",
    with_persons(
        f"""SELECT coalesce(URBANICITY, 'Missing') AS category, count(*) AS persons,
  {r6('avg(TARGET_B)')} AS target_rate,
  {r6('avg(LIFETIME_GIFT_AMOUNT / nullif(LIFETIME_GIFT_COUNT, 0))')} AS avg_gift,
  {r6('avg(RECENT_CARD_RESPONSE_COUNT / nullif(RECENT_RESPONSE_COUNT, 0))')} AS card_share,
  count(*) FILTER (DONOR_AGE IS NULL) AS ages_missing
FROM valid GROUP BY 1""",
        VALID,
    ),
)
def response_by_urbanicity(spark, sf):
    df = add_engineered_features(valid_frame(spark, sf))
    return rounded(
        df.groupBy(F.coalesce("URBANICITY", F.lit("Missing")).alias("category")).agg(
            F.count(F.lit(1)).alias("persons"),
            F.avg(col(TARGET_COLUMN)).alias("target_rate"),
            F.avg("AVG_GIFT_PER_DONATION").alias("avg_gift"),
            F.avg("CARD_RESPONSE_SHARE").alias("card_share"),
            F.count_if(col("DONOR_AGE").isNull()).alias("ages_missing"),
        )
    )


@register(
    "validation_rules",
    with_persons(
        "SELECT CONTROL_NUMBER, TARGET_B, " + sql_rounded(RULED) + " FROM (SELECT * REPLACE ("
        "CASE WHEN DONOR_AGE < 0 OR DONOR_AGE > 100 THEN NULL ELSE DONOR_AGE END AS DONOR_AGE,"
        "CASE WHEN CHILDREN < 0 THEN NULL ELSE CHILDREN END AS CHILDREN,"
        "CASE WHEN RECENT_RESPONSE_PROP NOT BETWEEN 0 AND 1 THEN NULL ELSE RECENT_RESPONSE_PROP END AS RECENT_RESPONSE_PROP,"
        "CASE WHEN RECENT_CARD_RESPONSE_PROP NOT BETWEEN 0 AND 1 THEN NULL ELSE RECENT_CARD_RESPONSE_PROP END AS RECENT_CARD_RESPONSE_PROP,"
        + each(
            ["RECENT_AVG_CARD_GIFT_AMT", "MEDIAN_HOUSEHOLD_INCOME", "PER_CAPITA_INCOME"],
            lambda c: f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}",
        )
        + ") FROM persons)"
    ),
)
def validation_rules(spark, sf):
    df = cleaning.null_invalid(person_frame(spark, sf))
    return rounded(df.select(ID_COLUMN, TARGET_COLUMN, *RULED))


@register(
    "custom_validation_rules",
    "SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view') THEN NULL ELSE event_type END "
    f"AS event_type, {r6('CASE WHEN value > 50 THEN NULL ELSE value END')} AS value FROM events",
)
def custom_validation_rules(spark, sf):
    rules = {
        "event_type": cleaning.not_among("click", "view"),
        "value": lambda c: c > 50,
        "no_such_column": cleaning.below(0),
    }
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(cleaning.null_invalid(events, rules))


@register(
    "validated_whole_numbers",
    staged("SELECT CONTROL_NUMBER, TARGET_B, " + sql_rounded(RULED) + " FROM valid", VALID),
)
def validated_whole_numbers(spark, sf):
    return rounded(valid_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN, *RULED))


@register(
    "whole_numbers_from_text",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE "
    "CAST(CAST(round_even(o_totalprice, 0) AS BIGINT) AS VARCHAR) END AS code FROM orders",
)
def whole_numbers_from_text(spark, sf):
    code = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", code.alias("code"))
    return cleaning.to_whole_numbers(orders, ["code"])


@register(
    "infinities_to_null",
    f"SELECT event_id, {r6('CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END')} AS value FROM events",
)
def infinities_to_null(spark, sf):
    e = F.col("event_id")
    value = (
        F.when(e % 7 == 0, F.lit(float("inf")))
        .when(e % 11 == 0, F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    events = table(spark, sf, "events").select("event_id", value.alias("value"))
    return rounded(cleaning.infinities_to_null(events))


@register(
    "float32_range_guard",
    f"SELECT event_id, {r6('CASE WHEN event_id % 5 = 0 AND value <> 0 THEN NULL ELSE value END')} AS value FROM events",
)
def float32_range_guard(spark, sf):
    value = F.when(F.col("event_id") % 5 == 0, F.col("value") * 1e300).otherwise(F.col("value"))
    events = table(spark, sf, "events").select("event_id", value.alias("value"))
    return rounded(cleaning.beyond_float32_to_null(events))


@register(
    "outlier_columns",
    staged(
        "SELECT feature FROM ("
        + unpivoted(
            "shapes",
            OUTLIER_COLUMNS,
            lambda c: f"(lo_{c} < q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]) OR hi_{c} > q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1])) AS hit",
        )
        + ") WHERE hit",
        VALID,
        MNAR,
        IMPUTED,
        SHAPES,
    ),
)
def outlier_columns(spark, sf):
    found = outliers.detect_outlier_columns(
        imputed_frame(spark, sf), exclude=(ID_COLUMN, TARGET_COLUMN)
    )
    return spark.createDataFrame([(c,) for c in found], "feature string")


SCALED = ["LIFETIME_GIFT_AMOUNT", "RECENT_STAR_STATUS", "MEDIAN_HOUSEHOLD_INCOME", "RECENT_AVG_GIFT_AMT"]


@register(
    "outliers_robust_scaled",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(
            SCALED,
            lambda c: r6(
                f"round_even(({c} - q_{c}[2]) / CASE WHEN q_{c}[3] = q_{c}[1] THEN 1 ELSE q_{c}[3] - q_{c}[1] END, 4)"
            )
            + f" AS {c}",
        )
        + " FROM persons CROSS JOIN (SELECT "
        + each(SCALED, lambda c: f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}")
        + " FROM persons)"
    ),
)
def outliers_robust_scaled(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *SCALED)
    return rounded(outliers.OutlierRescaler(SCALED, "scale").fit_transform(df))


def _logged_sql(c: str, extra: str = "") -> str:
    return (
        f"CASE WHEN s_{c} > 0 THEN round_even(ln(1 + {c} + CASE WHEN lo_{c} <= -1 THEN -lo_{c} ELSE 0 END), 4) "
        f"ELSE round_even(-ln(1 - {c} + CASE WHEN hi_{c} >= 1 THEN hi_{c} ELSE 0 END), 4) END"
    )


LOGGED = [
    "LIFETIME_GIFT_AMOUNT",
    "MEDIAN_HOUSEHOLD_INCOME",
    "FREQUENCY_STATUS_97NK",
    "MONTHS_SINCE_FIRST_GIFT",
    "LIFETIME_MAX_GIFT_AMT",
]


@register(
    "outliers_log_transformed",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(LOGGED, lambda c: f"{r6(_logged_sql(c))} AS {c}")
        + " FROM persons CROSS JOIN (SELECT "
        + each(LOGGED, lambda c: f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, skewness({c}) AS s_{c}")
        + " FROM persons)"
    ),
)
def outliers_log_transformed(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *LOGGED)
    return rounded(outliers.OutlierRescaler(LOGGED, "transform").fit_transform(df))


@register(
    "outliers_log_transformed_if_skewed",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(
            LOGGED,
            lambda c: r6(f"CASE WHEN abs(s_{c}) < 1.0 THEN round_even({c}, 4) ELSE {_logged_sql(c)} END")
            + f" AS {c}",
        )
        + " FROM persons CROSS JOIN (SELECT "
        + each(LOGGED, lambda c: f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, skewness({c}) AS s_{c}")
        + " FROM persons)"
    ),
)
def outliers_log_transformed_if_skewed(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *LOGGED)
    return rounded(
        outliers.OutlierRescaler(LOGGED, "transform", skew_threshold=1.0).fit_transform(df)
    )


@register(
    "outliers_binned",
    "SELECT event_id, CAST(least(9, greatest(0, ceil((value - lo) / ((hi - lo) / 10)) - 1)) AS BIGINT) "
    "AS value FROM events CROSS JOIN (SELECT min(value) AS lo, max(value) AS hi FROM events)",
)
def outliers_binned(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return outliers.OutlierRescaler(["value"], "binning", bins=10).fit_transform(events)


FLAGGED = ["LIFETIME_GIFT_AMOUNT", "MONTHS_SINCE_LAST_GIFT", "RECENT_STAR_STATUS"]


def _outside(c: str) -> str:
    return (
        f"coalesce({c} < q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]) "
        f"OR {c} > q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1]), false)"
    )


def _quartiles(columns, source="persons") -> str:
    return (
        "(SELECT "
        + each(columns, lambda c: f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}")
        + f" FROM {source})"
    )


@register(
    "outlier_flags",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(FLAGGED, lambda c: f"{_outside(c)} AS {c}_OUTLIER")
        + ", ("
        + each(FLAGGED, _outside, " OR ")
        + ") AS ANY_OUTLIER FROM persons CROSS JOIN "
        + _quartiles(FLAGGED)
    ),
)
def outlier_flags(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *FLAGGED)
    return outliers.flag_outliers(df, FLAGGED).drop(*FLAGGED)


@register(
    "outlier_split_pairs",
    with_persons(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {_outside(c)} AS outlying, count(*) AS persons FROM persons "
            f"CROSS JOIN {_quartiles([c])} GROUP BY 1, 2"
            for c in FLAGGED
        )
        + f" UNION ALL SELECT 'ANY', {each(FLAGGED, _outside, ' OR ')}, count(*) FROM persons "
        f"CROSS JOIN {_quartiles(FLAGGED)} GROUP BY 1, 2"
    ),
)
def outlier_split_pairs(spark, sf):
    return outliers.outlier_sides(person_frame(spark, sf), FLAGGED).withColumnRenamed("rows", "persons")


@register(
    "rows_with_any_predictor",
    with_persons(
        "SELECT CONTROL_NUMBER FROM persons WHERE WEALTH_RATING IS NOT NULL OR DONOR_AGE IS NOT NULL "
        "OR INCOME_GROUP IS NOT NULL"
    ),
)
def rows_with_any_predictor(spark, sf):
    columns = ["WEALTH_RATING", "DONOR_AGE", "INCOME_GROUP"]
    return cleaning.drop_all_null_rows(person_frame(spark, sf), columns).select(ID_COLUMN)


@register(
    "quantile_clip_filter",
    f"SELECT 'value' AS feature, {r6('value')} AS value FROM events, "
    "(SELECT quantile_cont(value, [0.01, 0.99]) AS c FROM events) WHERE value BETWEEN c[1] AND c[2] "
    f"UNION ALL SELECT 'user_id', {r6('CAST(user_id AS DOUBLE)')} FROM events, "
    "(SELECT quantile_cont(user_id, [0.01, 0.99]) AS c FROM events) WHERE user_id BETWEEN c[1] AND c[2]",
)
def quantile_clip_filter(spark, sf):
    return rounded(outliers.clip_filter(table(spark, sf, "events"), ["value", "user_id"]))


# Imputation ----------------------------------------------------------------------------------


def _strategy_query(name: str, strategies: dict[str, str], sql_fill) -> None:
    columns = list(strategies)

    def run(spark, sf):
        df = person_frame(spark, sf).select(ID_COLUMN, *columns)
        return rounded(imputation.ColumnImputer(strategies).fit_transform(df))

    def piece(c: str) -> str:
        fill = sql_fill(c)
        if c in TEXT:
            return f"coalesce({c}, {fill}) AS {c}"
        return f"{r6(f'round_even(coalesce({c}, {fill}), 4)')} AS {c}"

    register(name, with_persons("SELECT CONTROL_NUMBER, " + each(columns, piece) + " FROM persons"))(run)


_GAPPED = ["CHILDREN", "DONOR_AGE", "INCOME_GROUP", "RECENT_AVG_CARD_GIFT_AMT", "RECENT_AVG_GIFT_AMT"]
_strategy_query(
    "impute_mean", dict.fromkeys(_GAPPED, "mean"), lambda c: f"(SELECT avg({c}) FROM persons)"
)
_strategy_query(
    "impute_median",
    dict.fromkeys(_GAPPED, "median"),
    lambda c: f"(SELECT quantile_cont({c}, 0.5) FROM persons)",
)
_strategy_query(
    "impute_most_frequent",
    dict.fromkeys(["DONOR_GENDER", "URBANICITY", "CHILDREN", "INCOME_GROUP"], "most_frequent"),
    lambda c: mode_of(c, "persons"),
)
_strategy_query(
    "impute_constant", dict.fromkeys(["DONOR_GENDER", "URBANICITY"], "constant"), lambda c: "'Missing'"
)
_strategy_query(
    "impute_minimum", dict.fromkeys(_GAPPED, "min"), lambda c: f"(SELECT min({c}) FROM persons)"
)
_strategy_query(
    "impute_neighbours", dict.fromkeys(_GAPPED, "knn"), lambda c: f"(SELECT avg({c}) FROM persons)"
)


@register(
    "mnar_flags_and_fills",
    staged(
        f"SELECT CONTROL_NUMBER, {sql_rounded(['WEALTH_RATING', 'MONTHS_SINCE_LAST_PROM_RESP', 'DONOR_AGE'])}, "
        + ", ".join(FLAGS)
        + " FROM mnar",
        VALID,
        MNAR,
    ),
)
def mnar_flags_and_fills(spark, sf):
    out = imputation.MnarImputer().fit_transform(valid_frame(spark, sf))
    return rounded(
        out.select(ID_COLUMN, "WEALTH_RATING", "MONTHS_SINCE_LAST_PROM_RESP", "DONOR_AGE", *FLAGS)
    )


@register(
    "strata_lookup",
    """WITH d AS (SELECT event_id, event_type, user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events),
a AS (SELECT event_type AS t, user_id AS u, quantile_cont(v, 0.5) AS m FROM d WHERE v IS NOT NULL GROUP BY 1, 2),
b AS (SELECT event_type AS t1, quantile_cont(v, 0.5) AS m1 FROM d WHERE v IS NOT NULL GROUP BY 1)
SELECT event_id, """
    + r6("coalesce(v, m, m1, (SELECT quantile_cont(v, 0.5) FROM d))")
    + " AS value FROM d LEFT JOIN a ON event_type = t AND user_id = u LEFT JOIN b ON event_type = t1",
)
def strata_lookup(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("value")).alias("value"),
    )
    strata = imputation.stratified_medians(df, "value", ["event_type", "user_id"])
    overall = exact_quantiles(df, ["value"], [0.5])["value"][0]
    out = imputation.fill_from_strata(df, "value", strata, overall)
    return rounded(out.select("event_id", "value"))


def _indicator_sql(columns, fill) -> str:
    return with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(columns, lambda c: f"{r6(f'coalesce({c}, {fill(c)})')} AS {c}")
        + ", "
        + each(
            columns,
            lambda c: f"CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS missingindicator_{c}",
        )
        + ", "
        + r6("PEP_STAR")
        + " AS PEP_STAR FROM persons"
    )


@register(
    "median_with_indicator",
    _indicator_sql(_GAPPED, lambda c: f"(SELECT quantile_cont({c}, 0.5) FROM persons)"),
)
def median_with_indicator(spark, sf):
    columns = [*_GAPPED, "PEP_STAR"]
    df = person_frame(spark, sf).select(ID_COLUMN, *columns)
    return rounded(imputation.IndicatorImputer(columns, "median").fit_transform(df))


_CODED = ["INCOME_GROUP", "WEALTH_RATING"]


@register("mode_with_indicator", _indicator_sql(_CODED, lambda c: mode_of(c, "persons")))
def mode_with_indicator(spark, sf):
    columns = [*_CODED, "PEP_STAR"]
    df = person_frame(spark, sf).select(ID_COLUMN, *columns)
    return rounded(imputation.IndicatorImputer(columns, "most_frequent").fit_transform(df))


@register(
    "model_imputers",
    with_persons(
        f"SELECT CONTROL_NUMBER, {r6('coalesce(DONOR_AGE, (SELECT quantile_cont(DONOR_AGE, 0.5) FROM persons))')} "
        "AS DONOR_AGE, coalesce(URBANICITY, 'Missing') AS URBANICITY FROM persons"
    ),
)
def model_imputers(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, "DONOR_AGE", "URBANICITY")
    out = imputation.numeric_imputer("median", ["DONOR_AGE"]).fit_transform(df)
    return rounded(imputation.categorical_imputer("constant", ["URBANICITY"]).fit_transform(out))


@register(
    "median_filled_predictors",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(
            NUM,
            lambda c: f"{r6(f'coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM persons))')} AS {c}",
        )
        + " FROM persons"
    ),
)
def median_filled_predictors(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *NUM)
    return rounded(imputation.numeric_imputer("median", NUM).fit_transform(df))


# The chain -----------------------------------------------------------------------------------


@register(
    "imputed_table",
    staged(
        "SELECT CONTROL_NUMBER, TARGET_B, " + ", ".join(TEXT + FLAGS) + ", " + sql_rounded(NUM) + " FROM imputed",
        VALID,
        MNAR,
        IMPUTED,
    ),
)
def imputed_table(spark, sf):
    return rounded(imputed_frame(spark, sf).select(*KEYS, *TEXT, *FLAGS, *NUM))


# Indicator columns are only changed when the outlier step takes them.
_FLAG_ROUND = each(FLAGS, lambda c: f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}")


def _flags_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: col(c).cast("double") for c in FLAGS})


@register(
    "cleaning_chain",
    staged(
        "SELECT CONTROL_NUMBER, TARGET_B, " + ", ".join(TEXT) + ", " + _FLAG_ROUND + ", " + sql_rounded(NUM) + " FROM tamed",
        *CLEAN_STAGES,
    ),
)
def cleaning_chain(spark, sf):
    return rounded(_flags_as_double(CleaningChain().fit_transform(person_frame(spark, sf))))


@register(
    "cleaning_chain_onehot",
    staged(
        "SELECT CONTROL_NUMBER, TARGET_B, " + onehot_list() + ", " + _FLAG_ROUND + ", " + sql_rounded(NUM) + " FROM tamed",
        *CLEAN_STAGES,
    ),
)
def cleaning_chain_onehot(spark, sf):
    chain = CleaningChain(encode="onehot")
    return rounded(_flags_as_double(chain.fit_transform(person_frame(spark, sf))))


@register(
    "cleaning_chain_label",
    staged(
        "SELECT CONTROL_NUMBER, TARGET_B, "
        + each(
            TEXT,
            lambda c: f"(SELECT CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT {c} AS v FROM tamed) WHERE v < t.{c}) AS {c}",
        )
        + ", " + _FLAG_ROUND + ", " + sql_rounded(NUM) + " FROM tamed AS t",
        *CLEAN_STAGES,
    ),
)
def cleaning_chain_label(spark, sf):
    chain = CleaningChain(encode="label")
    return rounded(_flags_as_double(chain.fit_transform(person_frame(spark, sf))))


@register(
    "cleaning_chain_split_flags",
    staged(
        "SELECT CONTROL_NUMBER, ("
        + each([c for c in OUTLIER_COLUMNS if not c.startswith("WEALTH_RATING")], _outside, " OR ")
        + ") AS ANY_OUTLIER FROM imputed CROSS JOIN "
        + _quartiles([c for c in OUTLIER_COLUMNS if not c.startswith("WEALTH_RATING")], "imputed"),
        VALID,
        MNAR,
        IMPUTED,
    ),
)
def cleaning_chain_split_flags(spark, sf):
    chain = CleaningChain(outlier_method="split", drop=["WEALTH_RATING"])
    return chain.fit_transform(person_frame(spark, sf)).select(ID_COLUMN, "ANY_OUTLIER")
