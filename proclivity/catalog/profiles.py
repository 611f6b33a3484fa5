"""Queries: report tables over nulls, categories, outliers, correlations and variances."""

from __future__ import annotations

from pyspark.sql import functions as F

from proclivity.catalog.cleaning import valid_frame
from proclivity.catalog.person_sql import with_persons, with_scores
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import FEATURES, NUM, TEXT, VALID, each, r6, staged, unpivoted
from proclivity.catalog.support import rounded
from proclivity.operators import cleaning, correlation, imputation, missingness, outliers, profiling, rank_correlation
from proclivity.operators.features import ENGINEERED_COLUMNS, add_engineered_features
from proclivity.operators.reshape import melt, top_by
from proclivity.operators.running import order_statistics
from proclivity.plans.persons import person_frame, score_frame, table
from proclivity.schema import ID_COLUMN, TARGET_COLUMN

NULL_SHARE = (
    "SELECT feature, " + r6("share") + " AS missing_percent FROM ("
    + unpivoted("persons", FEATURES, lambda c: f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS share")
    + ")"
)


@register("missing_percentages", with_persons(NULL_SHARE))
def missing_percentages(spark, sf):
    return rounded(profiling.missing_percentages(person_frame(spark, sf), FEATURES))


@register(
    "missing_percentages_top",
    with_persons(NULL_SHARE + " ORDER BY missing_percent DESC, feature LIMIT 5"),
)
def missing_percentages_top(spark, sf):
    return rounded(profiling.missing_percentages(person_frame(spark, sf), FEATURES, top_n=5))


@register(
    "group_medians",
    f"""SELECT event_type, user_id, {r6('quantile_cont(value, 0.5)')} AS median_value
FROM events GROUP BY 1, 2""",
)
def group_medians(spark, sf):
    strata = imputation.stratified_medians(
        table(spark, sf, "events"), "value", ["event_type", "user_id"]
    )
    return rounded(
        strata.where(F.col("__depth") == 2).select(
            "event_type", "user_id", F.col("__median").alias("median_value")
        )
    )


@register(
    "group_quantiles_ranged",
    f"""SELECT l_returnflag, {r6('quantile_cont(l_extendedprice, 0.25)')} AS q1,
  {r6('quantile_cont(l_extendedprice, 0.5)')} AS median, {r6('quantile_cont(l_extendedprice, 0.75)')} AS q3
FROM lineitem GROUP BY 1""",
)
def group_quantiles_ranged(spark, sf):
    lines = table(spark, sf, "lineitem")
    got = order_statistics(lines, ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75])
    return rounded(
        got.select(
            "l_returnflag", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
        )
    )


@register(
    "group_null_rates",
    with_persons(
        f"""SELECT 'DONOR_AGE' AS variable, CASE HOME_OWNER WHEN 'H' THEN 'Homeowner' WHEN 'U' THEN 'Renter'
    ELSE HOME_OWNER END AS category, {r6('avg(CASE WHEN DONOR_AGE IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_rate
FROM persons WHERE HOME_OWNER IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'MONTHS_SINCE_LAST_PROM_RESP', RECENCY_STATUS_96NK,
  {r6('avg(CASE WHEN MONTHS_SINCE_LAST_PROM_RESP IS NULL THEN 1.0 ELSE 0.0 END)')}
FROM persons WHERE RECENCY_STATUS_96NK IS NOT NULL GROUP BY 2"""
    ),
)
def group_null_rates(spark, sf):
    tables = missingness.explain_mnar(person_frame(spark, sf))
    both = None
    for variable in ("DONOR_AGE", "MONTHS_SINCE_LAST_PROM_RESP"):
        part = tables[variable].select(F.lit(variable).alias("variable"), "category", "null_rate")
        both = part if both is None else both.unionByName(part)
    return rounded(both)


@register(
    "null_rate_by_quintile",
    with_persons(
        f"""SELECT bucket, {r6('e[bucket + 1]')} AS lower, {r6('e[bucket + 2]')} AS upper,
  {r6('avg(gap)')} AS null_rate
FROM (
  SELECT CASE WHEN x <= e[2] THEN 0 WHEN x <= e[3] THEN 1 WHEN x <= e[4] THEN 2 WHEN x <= e[5] THEN 3
         ELSE 4 END AS bucket, e, CASE WHEN w IS NULL THEN 1.0 ELSE 0.0 END AS gap
  FROM (SELECT LIFETIME_GIFT_AMOUNT AS x, WEALTH_RATING AS w FROM persons WHERE LIFETIME_GIFT_AMOUNT IS NOT NULL)
  CROSS JOIN (SELECT quantile_cont(LIFETIME_GIFT_AMOUNT, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM persons)
) GROUP BY bucket, e"""
    ),
)
def null_rate_by_quintile(spark, sf):
    return rounded(missingness.explain_mnar(person_frame(spark, sf))["WEALTH_RATING"])


_COUNTS = (
    "SELECT feature, category, count(*) AS count FROM ("
    + unpivoted("persons", TEXT, lambda c: f"coalesce({c}, 'Missing') AS category")
    + ") GROUP BY 1, 2"
)


@register("category_frequencies", with_persons(_COUNTS))
def category_frequencies(spark, sf):
    return profiling.category_frequencies(person_frame(spark, sf), TEXT)


@register(
    "category_frequencies_top",
    with_persons(
        "SELECT feature, category, count FROM (SELECT *, row_number() OVER (PARTITION BY feature "
        f"ORDER BY count DESC, category) AS r FROM ({_COUNTS})) WHERE r <= 3"
    ),
)
def category_frequencies_top(spark, sf):
    return profiling.category_frequencies(person_frame(spark, sf), TEXT, top_n=3)


@register(
    "category_target_rates",
    with_persons(
        f"SELECT feature, category, {r6('avg(y)')} AS target_rate FROM ("
        + unpivoted("persons", TEXT, lambda c: f"coalesce({c}, 'Missing') AS category, TARGET_B AS y")
        + ") GROUP BY 1, 2"
    ),
)
def category_target_rates(spark, sf):
    return rounded(profiling.category_target_rates(person_frame(spark, sf), TEXT))


@register(
    "missing_target_rates",
    with_persons(
        "SELECT feature, unnest(['Missing', 'Not Missing']) AS \"group\", unnest([m, p]) AS target_rate FROM ("
        f"SELECT feature, {r6('m')} AS m, {r6('p')} AS p FROM ("
        + unpivoted(
            "persons",
            FEATURES,
            lambda c: f"count(*) FILTER ({c} IS NULL) AS nulls, avg(TARGET_B) FILTER ({c} IS NULL) AS m, "
            f"avg(TARGET_B) FILTER ({c} IS NOT NULL) AS p",
        )
        + ") WHERE nulls > 0 ORDER BY nulls DESC, feature LIMIT 15)"
    ),
)
def missing_target_rates(spark, sf):
    return rounded(
        profiling.missing_target_rates(person_frame(spark, sf), columns=FEATURES, top_n=15)
    )


@register(
    "invalid_counts",
    with_persons(
        """SELECT feature, invalid_count FROM (
SELECT 'DONOR_AGE' AS feature, count(*) FILTER (DONOR_AGE < 0 OR DONOR_AGE > 100) AS invalid_count FROM persons
UNION ALL SELECT 'CHILDREN', count(*) FILTER (CHILDREN < 0) FROM persons
UNION ALL SELECT 'TARGET_B', count(*) FILTER (TARGET_B NOT IN (0, 1)) FROM persons
UNION ALL SELECT 'RECENT_RESPONSE_PROP', count(*) FILTER (RECENT_RESPONSE_PROP < 0 OR RECENT_RESPONSE_PROP > 1) FROM persons
UNION ALL SELECT 'RECENT_CARD_RESPONSE_PROP', count(*) FILTER (RECENT_CARD_RESPONSE_PROP < 0 OR RECENT_CARD_RESPONSE_PROP > 1) FROM persons
UNION ALL SELECT 'RECENT_AVG_CARD_GIFT_AMT', count(*) FILTER (RECENT_AVG_CARD_GIFT_AMT < 0) FROM persons
UNION ALL SELECT 'MEDIAN_HOUSEHOLD_INCOME', count(*) FILTER (MEDIAN_HOUSEHOLD_INCOME < 0) FROM persons
UNION ALL SELECT 'PER_CAPITA_INCOME', count(*) FILTER (PER_CAPITA_INCOME < 0) FROM persons)"""
    ),
)
def invalid_counts(spark, sf):
    rules = {**cleaning.DEFAULT_RULES, "NO_SUCH_COLUMN": cleaning.below(0)}
    return cleaning.invalid_counts(person_frame(spark, sf), rules)


def _fenced(c: str) -> str:
    return f"{c} < q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]) OR {c} > q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1])"


_QUARTILES = "quarts AS (SELECT " + each(NUM, lambda c: f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}") + " FROM persons)"


@register(
    "outlier_counts",
    with_persons(
        f"SELECT feature, n AS outlier_count, {r6('coalesce(100.0 * n / nullif(present, 0), 0)')} AS outlier_percent FROM ("
        + unpivoted(
            "persons CROSS JOIN quarts",
            NUM,
            lambda c: f"count(*) FILTER ({_fenced(c)}) AS n, count({c}) AS present",
        )
        + ")",
        _QUARTILES,
    ),
)
def outlier_counts(spark, sf):
    return rounded(outliers.outlier_counts(person_frame(spark, sf), NUM))


@register(
    "outlier_percentages_without_indicators",
    with_persons(
        f"SELECT feature, {r6('coalesce(100.0 * n / nullif(present, 0), 0)')} AS outlier_percent FROM ("
        + unpivoted(
            "persons CROSS JOIN quarts",
            [c for c in NUM if c not in ("PEP_STAR", "RECENT_STAR_STATUS")],
            lambda c: f"count(*) FILTER ({_fenced(c)}) AS n, count({c}) AS present",
        )
        + ")",
        _QUARTILES,
    ),
)
def outlier_percentages_without_indicators(spark, sf):
    table_ = outliers.outlier_counts(
        person_frame(spark, sf), NUM, exclude=("PEP_STAR", "RECENT_STAR_STATUS")
    )
    return rounded(table_.select("feature", "outlier_percent"))


@register(
    "outlier_counts_events",
    "SELECT 'value' AS feature, count(*) FILTER (value < q[1] - 1.5 * (q[2] - q[1]) OR value > q[2] + 1.5 * (q[2] - q[1])) "
    f"AS outlier_count, {r6('100.0 * count(*) FILTER (value < q[1] - 1.5 * (q[2] - q[1]) OR value > q[2] + 1.5 * (q[2] - q[1])) / count(value)')} "
    "AS outlier_percent FROM events CROSS JOIN (SELECT quantile_cont(value, [0.25, 0.75]) AS q FROM events)",
)
def outlier_counts_events(spark, sf):
    return rounded(outliers.outlier_counts(table(spark, sf, "events"), ["value"]))


_BOXED = ["l_quantity", "l_extendedprice", "l_discount"]


@register(
    "boxplot_summary",
    f"SELECT feature, {r6('q[1]')} AS q1, {r6('q[2]')} AS median, {r6('q[3]')} AS q3, "
    f"{r6('lw')} AS lower_whisker, {r6('uw')} AS upper_whisker, outlier_count FROM ("
    + unpivoted(
        f"lineitem CROSS JOIN (SELECT {each(_BOXED, lambda c: f'quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}')} FROM lineitem)",
        _BOXED,
        lambda c: f"any_value(q_{c}) AS q, "
        f"min({c}) FILTER ({c} >= q_{c}[1] - 1.5 * (q_{c}[3] - q_{c}[1]) AND {c} <= q_{c}[3] + 1.5 * (q_{c}[3] - q_{c}[1])) AS lw, "
        f"max({c}) FILTER ({c} >= q_{c}[1] - 1.5 * (q_{c}[3] - q_{c}[1]) AND {c} <= q_{c}[3] + 1.5 * (q_{c}[3] - q_{c}[1])) AS uw, "
        f"count(*) FILTER ({c} < q_{c}[1] - 1.5 * (q_{c}[3] - q_{c}[1]) OR {c} > q_{c}[3] + 1.5 * (q_{c}[3] - q_{c}[1])) AS outlier_count",
    )
    + ")",
)
def boxplot_summary(spark, sf):
    return rounded(outliers.boxplot_summary(table(spark, sf, "lineitem"), _BOXED))


@register(
    "outlier_points",
    f"SELECT 'value' AS feature, {r6('value')} AS value FROM events CROSS JOIN "
    "(SELECT quantile_cont(value, [0.25, 0.75]) AS q FROM events) "
    "WHERE value < q[1] - 1.5 * (q[2] - q[1]) OR value > q[2] + 1.5 * (q[2] - q[1])",
)
def outlier_points(spark, sf):
    return rounded(outliers.outlier_points(table(spark, sf, "events"), ["value"]))


@register(
    "clipped_histogram",
    f"""WITH c AS (SELECT quantile_cont(value, [0.01, 0.99]) AS c FROM events),
k AS (SELECT value FROM events CROSS JOIN c WHERE value BETWEEN c[1] AND c[2]),
e AS (SELECT min(value) AS lo, max(value) AS hi FROM k)
SELECT 'value' AS feature, bin, {r6('lo + bin * ((hi - lo) / 30)')} AS bin_start, count(*) AS count
FROM (SELECT CAST(least(29, floor((value - lo) / ((hi - lo) / 30))) AS INTEGER) AS bin, lo, hi FROM k CROSS JOIN e)
GROUP BY bin, lo, hi""",
)
def clipped_histogram(spark, sf):
    return rounded(profiling.clipped_histogram(table(spark, sf, "events"), ["value"], bins=30))


@register(
    "score_histogram",
    with_scores(
        f"""SELECT CAST(b AS INTEGER) AS bin, {r6('lo + b * ((hi - lo) / 20)')} AS bin_start, count(score) AS count
FROM range(20) AS r(b) CROSS JOIN (SELECT min(score) AS lo, max(score) AS hi FROM scores)
LEFT JOIN scores ON least(19, floor((score - lo) / ((hi - lo) / 20))) = b GROUP BY b, lo, hi"""
    ),
)
def score_histogram(spark, sf):
    return rounded(profiling.score_histogram(score_frame(spark, sf), "score", 20))


ENGINEERED = (
    "\nengineered AS (SELECT *, LIFETIME_GIFT_AMOUNT / nullif(LIFETIME_GIFT_COUNT, 0) AS AVG_GIFT_PER_DONATION, "
    "LIFETIME_GIFT_AMOUNT / nullif(LIFETIME_PROM, 0) AS GIFT_AMOUNT_PER_PROMOTION, "
    "LIFETIME_GIFT_COUNT / nullif(LIFETIME_PROM, 0) AS GIFT_COUNT_PER_PROMOTION, "
    "RECENT_RESPONSE_COUNT / nullif(LIFETIME_PROM, 0) AS PROMOTION_RESPONSE_RATE, "
    "MONTHS_SINCE_FIRST_GIFT - MONTHS_SINCE_LAST_GIFT AS MONTHS_BETWEEN_FIRST_AND_LAST_GIFT, "
    "LIFETIME_GIFT_COUNT / nullif(MONTHS_SINCE_FIRST_GIFT, 0) AS GIFT_COUNT_PER_MONTH_ACTIVE, "
    "LIFETIME_PROM / nullif(MONTHS_SINCE_FIRST_GIFT, 0) AS PROMOTIONS_PER_MONTH_ACTIVE, "
    "RECENT_RESPONSE_COUNT / 4 AS RESPONSES_PER_YEAR, "
    "RECENT_RESPONSE_PROP - RECENT_CARD_RESPONSE_PROP AS RECENT_RESPONSE_RATIO_GAP, "
    "RECENT_RESPONSE_COUNT - RECENT_CARD_RESPONSE_COUNT AS RECENT_RESPONSE_COUNT_GAP, "
    "RECENT_CARD_RESPONSE_COUNT / nullif(RECENT_RESPONSE_COUNT, 0) AS CARD_RESPONSE_SHARE, "
    "RECENT_CARD_RESPONSE_COUNT / nullif(LIFETIME_CARD_PROM, 0) AS CARD_RESPONSE_RATE FROM valid)"
)


@register(
    "engineered_features",
    staged(
        "SELECT CONTROL_NUMBER, " + each(ENGINEERED_COLUMNS, lambda c: f"{r6(c)} AS {c}") + " FROM engineered",
        VALID,
        ENGINEERED,
    ),
)
def engineered_features(spark, sf):
    df = add_engineered_features(valid_frame(spark, sf))
    return rounded(df.select(ID_COLUMN, *ENGINEERED_COLUMNS))


@register(
    "engineered_summary",
    staged(
        f"SELECT feature, {r6('a')} AS missing_pct, {r6('b')} AS train_mean, {r6('c')} AS train_std, "
        f"{r6('d')} AS target_corr FROM ("
        + unpivoted(
            "engineered",
            ENGINEERED_COLUMNS,
            lambda c: f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS a, avg({c}) AS b, "
            f"stddev_samp({c}) AS c, corr({c}, TARGET_B) AS d",
        )
        + ")",
        VALID,
        ENGINEERED,
    ),
)
def engineered_summary(spark, sf):
    df = add_engineered_features(valid_frame(spark, sf))
    return rounded(profiling.engineered_summary(df, ENGINEERED_COLUMNS))


# Large variances agree to twelve digits; the fraction of a number beyond a million is not compared.
_VARIANCES = "SELECT feature, CASE WHEN v > 1000000 THEN round(v, 0) ELSE " + r6("v") + " END AS variance FROM (" + unpivoted("persons", NUM, lambda c: f"var_samp({c}) AS v") + ")"


@register("column_variances", with_persons(_VARIANCES))
def column_variances(spark, sf):
    v = F.col("variance")
    return profiling.variances(person_frame(spark, sf), NUM).select(
        "feature", F.when(v > 1_000_000, F.round(v, 0)).otherwise(F.round(v, 6)).alias("variance")
    )


@register(
    "near_constant_columns",
    with_persons(f"SELECT * FROM ({_VARIANCES}) WHERE variance < 0.1"),
)
def near_constant_columns(spark, sf):
    table_ = profiling.variances(person_frame(spark, sf), NUM)
    return rounded(profiling.near_constant(table_, 0.1))


@register(
    "lowest_variances",
    with_persons(f"SELECT * FROM ({_VARIANCES}) ORDER BY variance, feature LIMIT 10"),
)
def lowest_variances(spark, sf):
    return rounded(profiling.lowest_variances(profiling.variances(person_frame(spark, sf), NUM), 10))


_PAIRED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "pearson_matrix_lineitem",
    "SELECT feature_a, feature_b, n, " + r6("c") + " AS correlation FROM ("
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) AS n, corr({a}, {b}) AS c FROM lineitem"
        for a in _PAIRED
        for b in _PAIRED
    )
    + ")",
)
def pearson_matrix_lineitem(spark, sf):
    return rounded(correlation.pearson_matrix(table(spark, sf, "lineitem"), _PAIRED))


_GAPPY = ["DONOR_AGE", "WEALTH_RATING", "INCOME_GROUP", "RECENT_AVG_CARD_GIFT_AMT", "PEP_STAR", "CHILDREN"]


def _pair_sql(a: str, b: str) -> str:
    x = f"CASE WHEN {b} IS NOT NULL THEN {a} END"
    z = f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return (
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
        f"covar_samp({x}, {z}) / nullif(stddev_samp({x}) * stddev_samp({z}), 0) AS c FROM persons"
    )


@register(
    "pearson_matrix_pairwise",
    with_persons(
        "SELECT feature_a, feature_b, n, " + r6("c") + " AS correlation FROM ("
        + "\nUNION ALL\n".join(_pair_sql(a, b) for a in _GAPPY for b in _GAPPY)
        + ")"
    ),
)
def pearson_matrix_pairwise(spark, sf):
    return rounded(correlation.pearson_matrix(person_frame(spark, sf), _GAPPY))


_CORRS = (
    "corrs AS (SELECT * FROM ("
    + unpivoted("persons", [c for c in NUM], lambda c: f"corr({c}, TARGET_B) AS c")
    + ") WHERE c IS NOT NULL AND NOT isnan(c))"
)


@register(
    "target_correlations_top",
    with_persons(
        f"SELECT feature, {r6('c')} AS correlation FROM corrs ORDER BY abs(c) DESC, feature LIMIT 15", _CORRS
    ),
)
def target_correlations_top(spark, sf):
    return rounded(
        correlation.target_correlations(person_frame(spark, sf), columns=NUM, top_n=15)
    )


def _spearman_cte() -> str:
    parts = [
        f"SELECT '{c}' AS feature, TARGET_B AS y, rank() OVER (ORDER BY {c}) + "
        f"(count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rk FROM persons WHERE {c} IS NOT NULL"
        for c in NUM
    ]
    return "ranked AS (" + " UNION ALL ".join(parts) + ")"


@register(
    "spearman_with_target",
    with_persons(
        f"SELECT feature, {r6('corr(rk, y)')} AS correlation FROM ranked GROUP BY feature", _spearman_cte()
    ),
)
def spearman_with_target(spark, sf):
    return rounded(correlation.spearman_with_target(person_frame(spark, sf), NUM))


_RANKED = ["l_quantity", "l_extendedprice", "l_discount"]


@register(
    "spearman_matrix",
    "WITH ranks AS (SELECT "
    + each(_RANKED, lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}")
    + " FROM lineitem) SELECT feature_a, feature_b, "
    + r6("c")
    + " AS correlation FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS c FROM ranks"
        for a in _RANKED
        for b in _RANKED
    )
    + ")",
)
def spearman_matrix(spark, sf):
    found = rank_correlation.spearman_matrix(table(spark, sf, "lineitem"), _RANKED)
    return rounded(found.select("feature_a", "feature_b", "correlation"))


@register(
    "spearman_matrix_pairwise",
    with_persons(
        "SELECT feature_a, feature_b, n, CASE WHEN least(da, db) > 1 THEN " + r6("c") + " END AS correlation FROM ("
        "SELECT feature_a, feature_b, count(*) AS n, count(DISTINCT a) AS da, count(DISTINCT b) AS db, corr(a, b) AS c FROM ("
        "SELECT feature_a, feature_b, "
        "rank() OVER (PARTITION BY feature_a, feature_b ORDER BY va) + (count(*) OVER (PARTITION BY feature_a, feature_b, va) - 1) / 2.0 AS a, "
        "rank() OVER (PARTITION BY feature_a, feature_b ORDER BY vb) + (count(*) OVER (PARTITION BY feature_a, feature_b, vb) - 1) / 2.0 AS b "
        "FROM (SELECT x.feature AS feature_a, y.feature AS feature_b, x.v AS va, y.v AS vb FROM longed AS x JOIN longed AS y USING (CONTROL_NUMBER))"
        ") GROUP BY ALL)",
        "longed AS ("
        + " UNION ALL ".join(f"SELECT CONTROL_NUMBER, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM persons WHERE {c} IS NOT NULL" for c in NUM)
        + ")",
    ),
)
def spearman_matrix_pairwise(spark, sf):
    return rounded(rank_correlation.spearman_matrix(person_frame(spark, sf), NUM))


@register(
    "correlation_heatmap_table",
    with_persons(
        "SELECT feature_a, feature_b, n, correlation FROM ("
        "SELECT a.feature AS feature_a, b.feature AS feature_b, a.i AS ia, b.i AS ib, "
        "count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) AS n, "
        f"{r6('corr(a.v, b.v)')} AS correlation "
        "FROM longed AS a JOIN longed AS b ON a.CONTROL_NUMBER = b.CONTROL_NUMBER AND a.i >= b.i GROUP BY ALL)",
        _CORRS,
        "chosen AS (SELECT 'TARGET_B' AS feature, 0 AS i UNION ALL SELECT feature, row_number() OVER "
        "(ORDER BY abs(c) DESC, feature) FROM corrs QUALIFY row_number() OVER (ORDER BY abs(c) DESC, feature) <= 6)",
        "wide AS (SELECT CONTROL_NUMBER, CAST(TARGET_B AS DOUBLE) AS TARGET_B, " + ", ".join(NUM) + " FROM persons)",
        "longed AS (SELECT CONTROL_NUMBER, feature, i, v FROM (SELECT * FROM wide UNPIVOT INCLUDE NULLS (v FOR feature IN (TARGET_B, "
        + ", ".join(NUM)
        + "))) JOIN chosen USING (feature))",
    ),
)
def correlation_heatmap_table(spark, sf):
    return rounded(
        correlation.ranked_matrix(
            person_frame(spark, sf), columns=[*NUM, TARGET_COLUMN], top_n=6
        )
    )


# Null flags of every feature, and their pairs in column order.
_GAP_CTES = (
    "marks AS (SELECT CONTROL_NUMBER, " + each(FEATURES, lambda c: f"CAST({c} IS NULL AS INT) AS {c}") + " FROM persons)",
    "gaps AS (SELECT CONTROL_NUMBER, feature, g FROM (UNPIVOT marks ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE g))",
    "pairs AS (SELECT a.feature AS feature_a, b.feature AS feature_b, a.g AS ga, b.g AS gb "
    "FROM gaps AS a JOIN gaps AS b ON a.CONTROL_NUMBER = b.CONTROL_NUMBER AND a.feature < b.feature)",
)
_OVERLAPS = "SELECT feature_a, feature_b, count(*) FILTER (ga + gb = 2) AS count FROM pairs GROUP BY ALL"


@register(
    "null_flag_correlations",
    with_persons(
        f"SELECT feature_a, feature_b, {r6('covar_samp(ga, gb) / nullif(stddev_samp(ga) * stddev_samp(gb), 0)')} AS correlation "
        "FROM pairs GROUP BY ALL",
        *_GAP_CTES,
    ),
)
def null_flag_correlations(spark, sf):
    patterns = missingness.missingness_patterns(person_frame(spark, sf), FEATURES)
    return rounded(patterns["correlations"])


@register("null_overlap_counts", with_persons(_OVERLAPS, *_GAP_CTES))
def null_overlap_counts(spark, sf):
    return missingness.missingness_patterns(person_frame(spark, sf), FEATURES)["overlaps"]


@register(
    "null_overlap_top",
    with_persons(f"SELECT * FROM ({_OVERLAPS}) ORDER BY count DESC, feature_a, feature_b LIMIT 10", *_GAP_CTES),
)
def null_overlap_top(spark, sf):
    return correlation.overlap_counts(person_frame(spark, sf), FEATURES, top_n=10)


@register(
    "null_overlap_heatmap",
    with_persons(
        "SELECT a.feature AS feature_a, b.feature AS feature_b, "
        + r6("covar_samp(a.g, b.g) / nullif(stddev_samp(a.g) * stddev_samp(b.g), 0)")
        + " AS correlation FROM flags AS a JOIN flags AS b ON a.CONTROL_NUMBER = b.CONTROL_NUMBER AND a.i < b.i GROUP BY ALL",
        "gaps AS (" + unpivoted("persons", FEATURES, lambda c: f"count(*) FILTER ({c} IS NULL) AS n") + ")",
        "top AS (SELECT feature, row_number() OVER (ORDER BY n DESC, feature) AS i FROM gaps "
        "QUALIFY row_number() OVER (ORDER BY n DESC, feature) <= 5)",
        "marks AS (SELECT CONTROL_NUMBER, " + each(FEATURES, lambda c: f"CAST({c} IS NULL AS INT) AS {c}") + " FROM persons)",
        "flags AS (SELECT CONTROL_NUMBER, feature, i, g FROM (UNPIVOT marks ON " + ", ".join(FEATURES)
        + " INTO NAME feature VALUE g) JOIN top USING (feature))",
    ),
)
def null_overlap_heatmap(spark, sf):
    return rounded(
        missingness.overlap_heatmap(person_frame(spark, sf).select(*FEATURES), top_n=5)
    )


@register(
    "class_counts",
    with_persons("SELECT TARGET_B AS label, count(*) AS count FROM persons GROUP BY 1"),
)
def class_counts(spark, sf):
    return profiling.class_counts(person_frame(spark, sf))


@register(
    "indicator_levels",
    with_persons(
        unpivoted("persons", FEATURES, lambda c: f"CAST(count(DISTINCT {c} IS NULL) AS INTEGER) AS levels")
    ),
)
def indicator_levels(spark, sf):
    return profiling.indicator_levels(person_frame(spark, sf), FEATURES)


@register(
    "melted_columns",
    with_persons(
        unpivoted("persons", ["DONOR_AGE", "CHILDREN", "PEP_STAR"], lambda c: f"CONTROL_NUMBER, {r6(c)} AS value")
    ),
)
def melted_columns(spark, sf):
    return rounded(melt(person_frame(spark, sf), ["DONOR_AGE", "CHILDREN", "PEP_STAR"], [ID_COLUMN]))


@register(
    "strongest_correlations",
    with_persons(
        f"SELECT feature, {r6('c')} AS correlation FROM corrs ORDER BY abs(c) DESC, feature LIMIT 5", _CORRS
    ),
)
def strongest_correlations(spark, sf):
    table_ = correlation.target_correlations(person_frame(spark, sf), columns=NUM)
    return rounded(top_by(table_, [F.abs("correlation").desc(), F.col("feature")], 5))


@register(
    "mnar_verdicts",
    f"""SELECT event_id, {r6('CASE WHEN value IS NULL THEN NULL ELSE least(value / 50, 1) END')} AS auc,
CASE WHEN least(value / 50, 1) >= 0.7 THEN 'MNAR' WHEN least(value / 50, 1) >= 0.6 THEN 'Likely MAR'
ELSE 'MCAR / weak' END AS verdict FROM events""",
)
def mnar_verdicts(spark, sf):
    auc = F.least(F.col("value") / 50, F.lit(1.0))
    return rounded(
        table(spark, sf, "events").select(
            "event_id", auc.alias("auc"), missingness.verdict(auc).alias("verdict")
        )
    )


@register("mnar_analysis")
def mnar_analysis(spark, sf):
    return missingness.analyse_mnar(person_frame(spark, sf))
