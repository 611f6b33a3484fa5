"""A data-driven vote table for the selection operators: which family names which feature.

The signals are simple statistics of the person table, so that both engines derive the same votes.
"""

from __future__ import annotations

from proclivity.catalog.stages_sql import NUM, unpivoted

# Signal name: condition on the profile columns; the names of the decision matrix.
SIGNAL_RULES = {
    "Variance": "var >= 10",
    "Spearman": "abs(corr) >= 0.1",
    "ANOVA": "nulls = 0 AND mean > 5",
    "RFE": "top < 100",
    "Lasso": "mean < 40",
    "Random Forest": "top > 50 AND nulls < 50",
}

_PROF = (
    "prof AS MATERIALIZED ("
    + unpivoted(
        "persons",
        NUM,
        lambda c: f"count(*) FILTER ({c} IS NULL) AS nulls, avg({c}) AS mean, max({c}) AS top, "
        f"var_samp({c}) AS var, corr({c}, TARGET_B) AS corr",
    )
    + ")"
)
_SIGNALS = (
    "signals AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS method, feature FROM prof WHERE {rule}" for name, rule in SIGNAL_RULES.items()
    )
    + ")"
)
_FAMILIES = """families AS (
  (SELECT 'filter' AS method, feature FROM (
     (SELECT feature FROM signals WHERE method = 'Spearman' UNION SELECT feature FROM signals WHERE method = 'ANOVA')
     EXCEPT SELECT feature FROM prof WHERE NOT (var >= 10)))
  UNION ALL SELECT 'wrapper', feature FROM signals WHERE method = 'RFE'
  UNION ALL (SELECT 'embedded', feature FROM
     (SELECT feature FROM signals WHERE method = 'Lasso' UNION SELECT feature FROM signals WHERE method = 'Random Forest'))
)"""
VOTE_CTES = (_PROF, _SIGNALS, _FAMILIES)
CONSENSUS = "SELECT feature FROM families GROUP BY 1 HAVING count(DISTINCT method) >= 2"
VOTES = (
    "SELECT method, feature FROM families "
    "UNION ALL SELECT 'embedded_lasso', feature FROM signals WHERE method = 'Lasso' "
    "UNION ALL SELECT 'embedded_tree', feature FROM signals WHERE method = 'Random Forest' "
    f"UNION ALL SELECT 'consensus', feature FROM ({CONSENSUS})"
)
