"""Exact quantiles of many columns by scans alone, with bounded aggregation buffers.

``percentile`` keeps one counter per distinct value, which is fine for whole months or ages and
hopeless for a money column of 10^12 rows. Columns with few rows or few distinct values use it
directly. For the others a mergeable sketch brackets each wanted rank, one scan counts what lies
below and inside the bracket, and only the bracket is looked at exactly; a bracket that still
holds too much is bracketed again. No shuffle of rows takes place and no group is collected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import as_double, ident, number

EXACT_VALUES = 100_000
ACCURACY = 10_000
MARGIN = 1.25


def fits_one_buffer(df: DataFrame, value: str, exact_values: int = EXACT_VALUES) -> bool:
    """Whether one exact aggregation buffer can hold the values: few rows or few distinct ones."""
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(col(value)).alias("d")).first()
    return min(seen["n"], MARGIN * seen["d"]) <= exact_values


@dataclass
class _Search:
    column: str
    rank: int
    low: float
    high: float
    below: int = 0
    inside: int = 0
    distinct: int = 0
    answer: float | None = None
    # The answer is never outside these; a miss of the bracket moves one of them.
    least: float = -math.inf
    most: float = math.inf
    missed: bool = False

    def band(self) -> str:
        c = as_double(self.column)
        return f"CASE WHEN {c} BETWEEN {number(self.low)} AND {number(self.high)} THEN {c} END"


def _numbers(values) -> str:
    return "array(" + ", ".join(number(float(v)) for v in values) + ")"


def _edges(position: float) -> list[float]:
    slack = 2.0 / ACCURACY
    return [max(0.0, position - slack), min(1.0, position + slack)]


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    exact_values: int = EXACT_VALUES,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the non-null values of every column.

    A column without values gives nulls. One pass finds the columns with few values or few distinct
    ones, another takes their quantiles; two more for each bracketing round of the columns with more than
    ``exact_values`` of them.
    """
    if not columns:
        return {}
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    first = df.selectExpr(
        *[f"count({ident(c)}) AS n{i}" for i, c in enumerate(columns)],
        *[f"approx_count_distinct({ident(c)}) AS d{i}" for i, c in enumerate(columns)],
    ).first()
    rows = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    # The distinct estimate may be some percent low, hence the margin.
    light = [
        c for i, c in enumerate(columns) if rows[c] and min(rows[c], MARGIN * first[f"d{i}"]) <= exact_values
    ]
    heavy = [c for c in columns if rows[c] and c not in light]
    if light:
        wanted = _numbers(probs)
        got = df.selectExpr(
            *[f"percentile({as_double(c)}, {wanted}) AS q{i}" for i, c in enumerate(light)]
        ).first()
        # A column without values has no quantiles and keeps its nulls.
        out.update({c: list(got[f"q{i}"]) for i, c in enumerate(light) if got[f"q{i}"]})
    if heavy:
        stats = _select(df, heavy, probs, rows, exact_values)
        for c in heavy:
            for i, p in enumerate(probs):
                position = (rows[c] - 1) * p
                low, high = stats[c, math.floor(position)], stats[c, math.ceil(position)]
                out[c][i] = low + (high - low) * (position - math.floor(position))
    return out


def _select(df, columns, probs, rows, exact_values) -> dict[tuple[str, int], float]:
    """Order statistics by repeated bracketing."""
    ranks = {
        c: sorted({f((rows[c] - 1) * p) for p in probs for f in (math.floor, math.ceil)})
        for c in columns
    }
    edges = {c: [e for r in ranks[c] for e in _edges((r + 0.5) / rows[c])] for c in columns}
    got = df.selectExpr(
        *[
            f"percentile_approx({as_double(c)}, {_numbers(edges[c])}, {ACCURACY}) AS e{i}"
            for i, c in enumerate(columns)
        ],
        *[f"min({as_double(c)}) AS lo{i}" for i, c in enumerate(columns)],
        *[f"max({as_double(c)}) AS hi{i}" for i, c in enumerate(columns)],
    ).first()
    limits = {c: (got[f"lo{i}"], got[f"hi{i}"]) for i, c in enumerate(columns)}
    searches = [
        _Search(c, r, got[f"e{i}"][2 * j], got[f"e{i}"][2 * j + 1], least=limits[c][0], most=limits[c][1])
        for i, c in enumerate(columns)
        for j, r in enumerate(ranks[c])
    ]
    while open_ := [s for s in searches if s.answer is None]:
        _count(df, open_)
        for s in open_:
            # A miss shuts out what was counted; from then on the rest is halved, so the search ends.
            if s.below > s.rank:
                s.most = math.nextafter(s.low, -math.inf)
                s.low, s.high, s.inside, s.missed = s.least, s.most, 0, True
            elif s.below + s.inside <= s.rank:
                s.least = math.nextafter(s.high, math.inf)
                s.low, s.high, s.inside, s.missed = s.least, s.most, 0, True
            elif s.low == s.high:
                s.answer = s.low
        counted = [s for s in open_ if s.answer is None and s.inside]
        small = [s for s in counted if min(s.inside, MARGIN * s.distinct) <= exact_values]
        _finish(df, small)
        _narrow(df, [s for s in counted if s.answer is None])
    return {(s.column, s.rank): s.answer for s in searches}


def _count(df, searches) -> None:
    got = df.selectExpr(
        *[
            f"count_if({as_double(s.column)} < {number(s.low)}) AS b{i}"
            for i, s in enumerate(searches)
        ],
        *[f"count({s.band()}) AS m{i}" for i, s in enumerate(searches)],
        *[f"approx_count_distinct({s.band()}) AS d{i}" for i, s in enumerate(searches)],
    ).first()
    for i, s in enumerate(searches):
        s.below, s.inside, s.distinct = got[f"b{i}"], got[f"m{i}"], got[f"d{i}"]


def _finish(df, searches) -> None:
    if not searches:
        return
    shares = [(s.rank - s.below) / max(1, s.inside - 1) for s in searches]
    got = df.selectExpr(
        *[
            f"percentile({s.band()}, {number(q)}) AS x{i}"
            for i, (s, q) in enumerate(zip(searches, shares, strict=True))
        ]
    ).first()
    for i, s in enumerate(searches):
        s.answer = got[f"x{i}"]


def _narrow(df, searches) -> None:
    for s in searches:
        if s.missed:
            s.least, s.most = s.low, s.high
            s.high = s.low / 2 + s.high / 2
    searches = [s for s in searches if not s.missed]
    if not searches:
        return
    got = df.selectExpr(
        *[
            f"percentile_approx({s.band()}, "
            f"{_numbers(_edges((s.rank - s.below + 0.5) / s.inside))}, {ACCURACY}) AS e{i}"
            for i, s in enumerate(searches)
        ]
    ).first()
    for i, s in enumerate(searches):
        s.low, s.high = got[f"e{i}"]
