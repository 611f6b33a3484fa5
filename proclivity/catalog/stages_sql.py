"""SQL texts of the cleaning stages and helpers to write per-column SQL."""

from __future__ import annotations

from proclivity.catalog.person_sql import with_persons
from proclivity.schema import ID_COLUMN, NUMERIC_COLUMNS, TARGET_COLUMN, TEXT_COLUMNS

NUM = NUMERIC_COLUMNS
TEXT = TEXT_COLUMNS
FEATURES = sorted(NUM + TEXT)
FLAGS = ["WEALTH_RATING_MISSING", "MONTHS_SINCE_LAST_PROM_RESP_MISSING", "DONOR_AGE_MISSING"]
KEYS = [ID_COLUMN, TARGET_COLUMN]
# Categories present in the person table.
CATEGORIES = {
    "DONOR_GENDER": ["F", "M"],
    "HOME_OWNER": ["H", "U"],
    "RECENCY_STATUS_96NK": ["F", "O", "P"],
    "SES": ["1", "2", "3", "4", "?"],
    "URBANICITY": ["?", "A", "B", "F", "H", "M"],
}


def r6(expression: str) -> str:
    """Six-digit rounding without a negative zero."""
    return f"round({expression}, 6) + CAST(0 AS DOUBLE)"


def q(name: str) -> str:
    return f'"{name}"'


def each(columns, make, sep: str = ",\n  ") -> str:
    return sep.join(make(c) for c in columns)


def rounded(columns) -> str:
    return each(columns, lambda c: f"{r6(q(c))} AS {q(c)}")


def unpivoted(source: str, columns, measure, sep: str = "\nUNION ALL\n") -> str:
    """One SELECT per column; ``measure`` maps a column to the select list after the name."""
    return sep.join(f"SELECT '{c}' AS feature, {measure(c)} FROM {source}" for c in columns)


# Persons by class, in the hash order of the stratified split.
RANKED = (
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY TARGET_B ORDER BY "
    "md5(CAST(CONTROL_NUMBER AS VARCHAR) || ':{seed}')) AS r, count(*) OVER (PARTITION BY TARGET_B) AS n FROM persons)"
)


VALID = """
valid AS (
  SELECT * REPLACE (
    CASE WHEN DONOR_AGE < 0 OR DONOR_AGE > 100 THEN NULL ELSE round_even(DONOR_AGE, 0) END
      AS DONOR_AGE,
    CASE WHEN CHILDREN < 0 THEN NULL ELSE round_even(CHILDREN, 0) END AS CHILDREN,
    CASE WHEN RECENT_RESPONSE_PROP < 0 OR RECENT_RESPONSE_PROP > 1 THEN NULL
         ELSE RECENT_RESPONSE_PROP END AS RECENT_RESPONSE_PROP,
    CASE WHEN RECENT_CARD_RESPONSE_PROP < 0 OR RECENT_CARD_RESPONSE_PROP > 1 THEN NULL
         ELSE RECENT_CARD_RESPONSE_PROP END AS RECENT_CARD_RESPONSE_PROP,
    CASE WHEN RECENT_AVG_CARD_GIFT_AMT < 0 THEN NULL ELSE round_even(RECENT_AVG_CARD_GIFT_AMT, 0)
         END AS RECENT_AVG_CARD_GIFT_AMT,
    CASE WHEN MEDIAN_HOUSEHOLD_INCOME < 0 THEN NULL ELSE round_even(MEDIAN_HOUSEHOLD_INCOME, 0)
         END AS MEDIAN_HOUSEHOLD_INCOME,
    CASE WHEN PER_CAPITA_INCOME < 0 THEN NULL ELSE round_even(PER_CAPITA_INCOME, 0) END
      AS PER_CAPITA_INCOME
  ) FROM persons
)"""

def mnar_stage(fit: str = "valid") -> str:
    """Informative gaps, with medians over the rows of ``fit``."""
    return _MNAR.format(fit=fit)


_MNAR = """
age_hu AS (SELECT HOME_OWNER AS h2, URBANICITY AS u2, quantile_cont(DONOR_AGE, 0.5) AS m_hu
  FROM {fit} WHERE HOME_OWNER IS NOT NULL AND URBANICITY IS NOT NULL GROUP BY 1, 2),
age_h AS (SELECT HOME_OWNER AS h1, quantile_cont(DONOR_AGE, 0.5) AS m_h
  FROM {fit} WHERE HOME_OWNER IS NOT NULL GROUP BY 1),
mnar AS (
  SELECT * EXCLUDE (h1, h2, u2, m_h, m_hu) REPLACE (
      coalesce(WEALTH_RATING, 0) AS WEALTH_RATING,
      coalesce(MONTHS_SINCE_LAST_PROM_RESP,
        (SELECT quantile_cont(MONTHS_SINCE_LAST_PROM_RESP, 0.5) FROM {fit}))
        AS MONTHS_SINCE_LAST_PROM_RESP,
      coalesce(DONOR_AGE, m_hu, m_h, (SELECT quantile_cont(DONOR_AGE, 0.5) FROM {fit}))
        AS DONOR_AGE),
    CASE WHEN WEALTH_RATING IS NULL THEN 1 ELSE 0 END AS WEALTH_RATING_MISSING,
    CASE WHEN MONTHS_SINCE_LAST_PROM_RESP IS NULL THEN 1 ELSE 0 END
      AS MONTHS_SINCE_LAST_PROM_RESP_MISSING,
    CASE WHEN DONOR_AGE IS NULL THEN 1 ELSE 0 END AS DONOR_AGE_MISSING
  FROM valid LEFT JOIN age_hu ON HOME_OWNER = h2 AND URBANICITY = u2
             LEFT JOIN age_h ON HOME_OWNER = h1
)"""


def mode_of(column: str, source: str) -> str:
    return (
        f"(SELECT v FROM (SELECT {column} AS v, count(*) AS n FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)"
    )


def imputed_stage(fit: str = "mnar") -> str:
    """Means and most frequent values over the rows of ``fit``."""
    return (
        "\nmeans AS (SELECT "
        + each(NUM, lambda c: f"avg({c}) AS a_{c}")
        + f" FROM {fit}),\nimputed AS (\n  SELECT mnar.* REPLACE (\n  "
        + each(NUM, lambda c: f"round_even(coalesce({c}, a_{c}), 4) AS {c}")
        + ",\n  "
        + each(TEXT, lambda c: f"coalesce({c}, {mode_of(c, fit)}) AS {c}")
        + "\n  ) FROM mnar CROSS JOIN means\n)"
    )


MNAR, IMPUTED = mnar_stage(), imputed_stage()

OUTLIER_COLUMNS = NUM + FLAGS


def _log(c: str) -> str:
    out = f"(lo_{c} < q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]) OR hi_{c} > q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1]))"
    right = f"round_even(ln(1 + greatest({c}, lo_{c}) + CASE WHEN lo_{c} <= -1 THEN -lo_{c} ELSE 0 END), 4)"
    left = f"round_even(-ln(1 - least({c}, hi_{c}) + CASE WHEN hi_{c} >= 1 THEN hi_{c} ELSE 0 END), 4)"
    return f"CASE WHEN NOT {out} THEN CAST({c} AS DOUBLE) WHEN s_{c} > 0 THEN {right} ELSE {left} END"


def shapes_stage(fit: str = "imputed") -> str:
    """Quartiles, ends and skewness over the rows of ``fit``."""
    return (
        "\nshapes AS (SELECT "
        + each(
            OUTLIER_COLUMNS,
            lambda c: f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}, skewness({c}) AS s_{c}",
        )
        + f" FROM {fit})"
    )


SHAPES = shapes_stage()
TAMED = (
    "\ntamed AS (SELECT imputed.* REPLACE (\n  "
    + each(OUTLIER_COLUMNS, lambda c: f"{_log(c)} AS {c}")
    + "\n  ) FROM imputed CROSS JOIN shapes)"
)


def onehot_list(columns=None) -> str:
    return each(
        [(c, v) for c in (columns or TEXT) for v in CATEGORIES[c]],
        lambda cv: f"CASE WHEN {cv[0]} = '{cv[1]}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS \"{cv[0]}_{cv[1]}\"",
    )


def staged(body: str, *stages: str) -> str:
    return with_persons(body, *stages)


CLEAN_STAGES = (VALID, MNAR, IMPUTED, SHAPES, TAMED)


def clean_stages_fitted(condition: str) -> tuple[str, ...]:
    """The cleaning stages of all rows, fitted on those that meet a condition."""
    of = lambda stage: f"(SELECT * FROM {stage} WHERE {condition})"
    return VALID, mnar_stage(of("valid")), imputed_stage(of("mnar")), shapes_stage(of("imputed")), TAMED
