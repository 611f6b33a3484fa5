"""Queries: filters, votes, consensus, decision matrix, cumulative variance."""

from __future__ import annotations

from pyspark.sql import functions as F

from proclivity.catalog.person_sql import with_persons
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import NUM, r6, unpivoted
from proclivity.catalog.support import (
    family_frame,
    profile_frame,
    rounded,
    signal_frame,
    vote_frame,
)
from proclivity.catalog.votes_sql import CONSENSUS, VOTE_CTES, VOTES
from proclivity.functions.columns import neg_log10
from proclivity.operators import evaluation, profiling, reshape, selection
from proclivity.operators.correlation import spearman_with_target
from proclivity.plans.persons import person_frame, table

_F = (
    "fscores AS (SELECT feature, n0 + n1 - 2 AS df_within, "
    "(n0 * (m0 - gm) * (m0 - gm) + n1 * (m1 - gm) * (m1 - gm)) / nullif((n0 * v0 + n1 * v1) / (n0 + n1 - 2), 0) AS f_score FROM ("
    "SELECT *, (n0 * m0 + n1 * m1) / (n0 + n1) AS gm FROM ("
    + unpivoted(
        "persons",
        NUM,
        lambda c: ", ".join(
            f"count({c}) FILTER (TARGET_B = {k}) AS n{k}, avg({c}) FILTER (TARGET_B = {k}) AS m{k}, "
            f"var_pop({c}) FILTER (TARGET_B = {k}) AS v{k}"
            for k in (0, 1)
        ),
    )
    + ")))"
)


@register(
    "anova_f",
    with_persons(
        f"SELECT feature, {r6('f_score')} AS f_score, CAST(1 AS BIGINT) AS df_between, df_within FROM fscores", _F
    ),
)
def anova_f(spark, sf):
    return rounded(selection.anova_f(person_frame(spark, sf), NUM))


@register("anova_test_top")
def anova_test_top(spark, sf):
    return selection.top_anova(selection.anova_test(person_frame(spark, sf), NUM), 20)


@register(
    "log_p_values",
    f"SELECT event_id, {r6('-log10(greatest(exp(-value * 20), 1e-300))')} AS neg_log_p FROM events",
)
def log_p_values(spark, sf):
    p = F.exp(-F.col("value") * 20)
    return rounded(table(spark, sf, "events").select("event_id", neg_log10(p).alias("neg_log_p")))


@register("filter_family")
def filter_family(spark, sf):
    df = person_frame(spark, sf)
    return selection.filter_family(
        profiling.variances(df, NUM), spearman_with_target(df, NUM), selection.anova_test(df, NUM)
    )


@register("signal_votes", with_persons("SELECT method, feature FROM signals", *VOTE_CTES))
def signal_votes(spark, sf):
    return signal_frame(spark, sf)


@register("family_votes", with_persons("SELECT method, feature FROM families", *VOTE_CTES))
def family_votes(spark, sf):
    return family_frame(spark, sf)


@register(
    "embedded_union",
    with_persons("SELECT feature FROM families WHERE method = 'embedded'", *VOTE_CTES),
)
def embedded_union(spark, sf):
    signals = signal_frame(spark, sf)
    return selection.embedded_family(
        signals.where(F.col("method") == "Lasso"), signals.where(F.col("method") == "Random Forest")
    )


@register(
    "intersected_names",
    with_persons(
        "SELECT feature FROM signals WHERE method = 'RFE' INTERSECT SELECT feature FROM signals WHERE method = 'Lasso'",
        *VOTE_CTES,
    ),
)
def intersected_names(spark, sf):
    signals = signal_frame(spark, sf)
    return selection.intersect_names(
        signals.where(F.col("method") == "RFE"), signals.where(F.col("method") == "Lasso")
    )


@register(
    "family_vote_counts",
    with_persons(
        "SELECT feature, count(DISTINCT method) AS votes FROM families GROUP BY 1", *VOTE_CTES
    ),
)
def family_vote_counts(spark, sf):
    return selection.vote_counts(family_frame(spark, sf))


@register("consensus_features", with_persons(CONSENSUS, *VOTE_CTES))
def consensus_features(spark, sf):
    return selection.consensus(family_frame(spark, sf))


@register("selection_table", with_persons(f"SELECT method, feature FROM ({VOTES})", *VOTE_CTES))
def selection_table(spark, sf):
    return vote_frame(spark, sf)


_MATRIX = (
    "SELECT feature, "
    + ", ".join(
        f"CASE WHEN bool_or(method = '{s}') THEN 'Keep' ELSE 'Discard' END AS \"{s}\"" for s in selection.SIGNALS
    )
    + ", CAST(count(method) AS INTEGER) AS \"Keep Votes\", "
    f"CASE WHEN feature IN ({CONSENSUS}) THEN 'Keep' ELSE 'Discard' END AS \"Final Decision\" "
    "FROM prof LEFT JOIN signals USING (feature) GROUP BY feature"
)


@register("decision_matrix", with_persons(_MATRIX, *VOTE_CTES))
def decision_matrix(spark, sf):
    return selection.decision_matrix(
        selection.names(spark, NUM),
        signal_frame(spark, sf),
        selection.consensus(family_frame(spark, sf)),
    )


@register(
    "decision_matrix_top",
    with_persons(
        f'SELECT * FROM ({_MATRIX}) ORDER BY "Final Decision" DESC, "Keep Votes" DESC, feature LIMIT 10', *VOTE_CTES
    ),
)
def decision_matrix_top(spark, sf):
    return decision_matrix(spark, sf).limit(10)


@register(
    "cumulative_variance",
    f"""WITH parts AS (SELECT user_id AS component, sum(value) / (SELECT sum(value) FROM events) AS share FROM events GROUP BY 1),
cum AS (SELECT component, sum(share) OVER (ORDER BY component) AS cumulative_variance FROM parts)
SELECT component, {r6('cumulative_variance')} AS cumulative_variance,
  (SELECT coalesce(min(component) FILTER (cumulative_variance >= 0.955), max(component)) FROM cum) AS components_needed FROM cum""",
)
def cumulative_variance(spark, sf):
    events = table(spark, sf, "events")
    total = events.agg(F.sum("value")).first()[0]
    parts = events.groupBy(F.col("user_id").alias("component")).agg(
        (F.sum("value") / F.lit(total)).alias("share")
    )
    return rounded(evaluation.first_reaching(parts, "component", "share", 0.955))


@register(
    "largest_coefficients",
    with_persons(
        f"SELECT feature, {r6('corr')} AS coefficient, {r6('abs(corr)')} AS abs_coefficient FROM prof "
        "WHERE corr <> 0 ORDER BY abs(corr) DESC, feature LIMIT 20",
        *VOTE_CTES,
    ),
)
def largest_coefficients(spark, sf):
    table_ = profile_frame(spark, sf).select("feature", F.col("corr").alias("coefficient"))
    return rounded(reshape.largest_coefficients(table_, top_n=20))
