"""Queries: encoders, scalers, the preprocessor, splits, folds and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from proclivity.catalog.person_sql import with_persons
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import CATEGORIES, NUM, RANKED, TEXT, each, mode_of, onehot_list, r6
from proclivity.catalog.support import rounded
from proclivity.functions.columns import col, half_even, last_name_part, safe_divide
from proclivity.operators import encoding, preprocessing, profiling, scaling, splitting
from proclivity.plans.persons import person_frame, table
from proclivity.schema import ID_COLUMN, TARGET_COLUMN


@register(
    "safe_division",
    f"SELECT l_orderkey, l_linenumber, {r6('l_extendedprice / nullif(l_discount, 0)')} AS ratio FROM lineitem",
)
def safe_division(spark, sf):
    ratio = safe_divide(F.col("l_extendedprice"), F.col("l_discount"))
    return rounded(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio"))
    )


@register(
    "half_even_rounding",
    "SELECT event_id, round_even(value / 8, 4) + CAST(0 AS DOUBLE) AS eighth, "
    "round_even(value, 0) + CAST(0 AS DOUBLE) AS whole FROM events",
)
def half_even_rounding(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        (half_even(v / 8) + F.lit(0.0)).alias("eighth"),
        (half_even(v, 0) + F.lit(0.0)).alias("whole"),
    )


@register(
    "name_parts",
    "SELECT DISTINCT p_brand || '__' || p_type AS name, p_type AS last_part FROM part",
)
def name_parts(spark, sf):
    name = F.concat_ws("__", "p_brand", "p_type")
    return (
        table(spark, sf, "part")
        .select(name.alias("name"), last_name_part(name).alias("last_part"))
        .distinct()
    )


# Encoders ------------------------------------------------------------------------------------

_NULLABLE = ["DONOR_GENDER", "URBANICITY"]


@register(
    "one_hot_encoding",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + onehot_list(_NULLABLE)
        + ", "
        + each(
            _NULLABLE,
            lambda c: f"CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {c}_nan",
        )
        + " FROM persons"
    ),
)
def one_hot_encoding(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *_NULLABLE)
    return encoding.OneHotEncoder().fit_transform(df)


@register(
    "one_hot_unseen_category",
    "SELECT o_orderkey, "
    + each(
        ["1-URGENT", "2-HIGH"],
        lambda v: f"CASE WHEN o_orderpriority = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS \"o_orderpriority_{v}\"",
    )
    + " FROM orders",
)
def one_hot_unseen_category(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    seen = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return encoding.categorical_encoder("onehot").fit(seen).transform(orders)


@register(
    "label_encoding",
    with_persons(
        "SELECT CONTROL_NUMBER, "
        + each(
            TEXT,
            lambda c: f"CASE WHEN {c} IS NOT NULL THEN (SELECT CAST(count(*) AS DOUBLE) FROM "
            f"(SELECT DISTINCT {c} AS v FROM persons) WHERE v < t.{c}) END AS {c}",
        )
        + " FROM persons AS t"
    ),
)
def label_encoding(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, *TEXT)
    return encoding.OrdinalEncoder().fit_transform(df)


@register(
    "label_unseen_category",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(0 AS DOUBLE) WHEN 'O' THEN CAST(1 AS DOUBLE) "
    "ELSE CAST(-1 AS DOUBLE) END AS o_orderstatus FROM orders",
)
def label_unseen_category(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    seen = orders.where(F.col("o_orderstatus") != "P")
    return encoding.categorical_encoder("ordinal").fit(seen).transform(orders)


@register("passthrough_encoding", with_persons("SELECT CONTROL_NUMBER, SES FROM persons"))
def passthrough_encoding(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, "SES")
    return encoding.categorical_encoder("passthrough").fit_transform(df)


# Scalers -------------------------------------------------------------------------------------

_SCALED = ["DONOR_AGE", "LIFETIME_GIFT_AMOUNT", "RECENT_STAR_STATUS", "MEDIAN_HOME_VALUE", "PEP_STAR"]


def _scaler_query(name: str, strategy: str, center, width) -> None:
    def run(spark, sf):
        df = person_frame(spark, sf).select(ID_COLUMN, *_SCALED)
        return rounded(scaling.numeric_scaler(strategy, _SCALED).fit_transform(df))

    def piece(c: str) -> str:
        w = f"(CASE WHEN {width(c)} = 0 THEN 1 ELSE {width(c)} END)"
        return f"{r6(f'round_even(({c} - {center(c)}) / {w}, 4)')} AS {c}"

    sql = with_persons(
        "SELECT CONTROL_NUMBER, " + each(_SCALED, piece) + " FROM persons CROSS JOIN (SELECT "
        + each(
            _SCALED,
            lambda c: f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS l_{c}, max({c}) AS h_{c}, "
            f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}",
        )
        + " FROM persons)"
    )
    register(name, sql)(run)


_scaler_query("standard_scaling", "standard", lambda c: f"a_{c}", lambda c: f"s_{c}")
_scaler_query("minmax_scaling", "minmax", lambda c: f"l_{c}", lambda c: f"(h_{c} - l_{c})")
_scaler_query("robust_scaling", "robust", lambda c: f"q_{c}[2]", lambda c: f"(q_{c}[3] - q_{c}[1])")
_scaler_query("rounding_only", "passthrough", lambda c: "0", lambda c: "1")


# Preprocessor --------------------------------------------------------------------------------

_CONTINUOUS = [c for c in NUM if c not in ("INCOME_GROUP", "WEALTH_RATING")]
_CODES = ["INCOME_GROUP"]
# Columns of the person table that hold nulls at every scale.
_FLAGGED = ["CHILDREN", "DONOR_AGE", "INCOME_GROUP", "RECENT_AVG_CARD_GIFT_AMT"]


def _prep_sql(linear: bool) -> str:
    names = _CONTINUOUS + _CODES
    filled = "filled AS (SELECT CONTROL_NUMBER, " + each(
        _CONTINUOUS,
        lambda c: f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM persons)) AS {c}",
    )
    filled += ", " + each(_CODES, lambda c: f"coalesce({c}, {mode_of(c, 'persons')}) AS {c}")
    filled += ", " + each(
        _FLAGGED,
        lambda c: f"CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS missingindicator_{c}",
    )
    filled += ", " + each(
        [(c, v) for c in TEXT for v in CATEGORIES[c]],
        lambda cv: f"CASE WHEN {cv[0]} = '{cv[1]}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS \"{cv[0]}_{cv[1]}\"",
    )
    filled += " FROM persons)"
    numeric = names + [f"missingindicator_{c}" for c in _FLAGGED]
    stats = "stats AS (SELECT " + each(
        numeric, lambda c: f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}"
    ) + " FROM filled)"

    def piece(c: str) -> str:
        if not linear:
            return f"{r6(c)} AS {c}"
        width = f"CASE WHEN q_{c}[3] = q_{c}[1] THEN 1 ELSE q_{c}[3] - q_{c}[1] END"
        return f"{r6(f'({c} - q_{c}[2]) / ({width})')} AS {c}"

    hot = each([(c, v) for c in TEXT for v in CATEGORIES[c]], lambda cv: f'"{cv[0]}_{cv[1]}"')
    return with_persons(
        "SELECT CONTROL_NUMBER, " + each(numeric, piece) + ", " + hot + " FROM filled CROSS JOIN stats",
        filled,
        stats,
    )


def _prepared(spark, sf, family: str):
    df = person_frame(spark, sf)
    out = preprocessing.Preprocessor(family).fit_transform(df)
    # Columns whose nulls come and go with the scale are left out of the comparison.
    names = [c for c in _CONTINUOUS + _CODES]
    flags = [f"missingindicator_{c}" for c in _FLAGGED]
    hot = [f"{c}_{v}" for c in TEXT for v in CATEGORIES[c]]
    return rounded(out.select(ID_COLUMN, *[col(c) for c in names + flags + hot]))


@register("preprocessor_linear", _prep_sql(True))
def preprocessor_linear(spark, sf):
    return _prepared(spark, sf, "linear")


@register("preprocessor_tree", _prep_sql(False))
def preprocessor_tree(spark, sf):
    return _prepared(spark, sf, "tree")


# Splits --------------------------------------------------------------------------------------

@register(
    "stratified_split",
    with_persons(
        "SELECT CONTROL_NUMBER, TARGET_B, CASE WHEN r <= round(0.7 * n) THEN 'train' ELSE 'val' END AS split FROM ranked",
        RANKED.format(seed=5),
    ),
)
def stratified_split(spark, sf):
    return splitting.stratified_split(person_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN))


@register(
    "stratified_split_orders",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN r <= round(0.8 * n) THEN 'train' ELSE 'val' END AS split FROM ("
    "SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':7')) AS r, "
    "count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)",
)
def stratified_split_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return splitting.stratified_split(orders, 0.8, "o_orderstatus", "o_orderkey", seed=7)


@register(
    "approximate_split",
    with_persons(
        "SELECT CONTROL_NUMBER, CASE WHEN CAST('0x' || substr(md5(CAST(CONTROL_NUMBER AS VARCHAR) || ':5'), 1, 8) AS BIGINT) "
        "/ 4294967296.0 < 0.7 THEN 'train' ELSE 'val' END AS split FROM persons"
    ),
)
def approximate_split(spark, sf):
    return splitting.approximate_split(person_frame(spark, sf).select(ID_COLUMN))


@register(
    "stratified_folds",
    with_persons(
        "SELECT CONTROL_NUMBER, TARGET_B, CAST((SELECT count(*) FROM range(1, 5) AS c(i) "
        "WHERE r > floor(n * i / 5)) AS INTEGER) AS fold FROM ranked",
        RANKED.format(seed=1),
    ),
)
def stratified_folds(spark, sf):
    return splitting.stratified_folds(person_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN))


@register(
    "split_report",
    with_persons(
        f"SELECT split, count(*) AS rows, 39 AS columns, {r6('avg(TARGET_B)')} AS target_rate FROM ("
        "SELECT *, CASE WHEN r <= round(0.7 * n) THEN 'train' ELSE 'val' END AS split FROM ranked) GROUP BY 1",
        RANKED.format(seed=5),
    ),
)
def split_report(spark, sf):
    df = splitting.stratified_split(person_frame(spark, sf)).drop(ID_COLUMN)
    return rounded(profiling.split_report(df, "split"))


@register(
    "positive_class_weight",
    with_persons(
        "SELECT CONTROL_NUMBER, TARGET_B, "
        + r6("CASE WHEN TARGET_B = 1 THEN (SELECT count(*) FILTER (TARGET_B = 0) / count(*) FILTER (TARGET_B = 1) FROM persons) ELSE 1 END")
        + " AS weight FROM persons"
    ),
)
def positive_class_weight(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN)
    return rounded(splitting.positive_weight(df))


@register(
    "balanced_class_weight",
    with_persons(
        "SELECT CONTROL_NUMBER, TARGET_B, "
        + r6("count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY TARGET_B))")
        + " AS weight FROM persons"
    ),
)
def balanced_class_weight(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN)
    return rounded(splitting.balanced_weight(df))
