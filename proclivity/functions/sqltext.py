"""SQL text of wide expressions.

A statement over hundreds of columns is handed to Spark as text in one call, which is read much
faster than the same tree built from Python one column operation at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame


def ident(name: str) -> str:
    """Quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def number(value: float | None) -> str:
    """Double literal."""
    if value is None or math.isnan(value):
        return "CAST(NULL AS DOUBLE)"
    if math.isinf(value):
        return f"CAST('{'-' if value < 0 else ''}Infinity' AS DOUBLE)"
    return f"({float(value)!r}D)"


def text(value: str | None) -> str:
    """String literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def half_even_sql(expression: str, digits: int = 4) -> str:
    """Round half to even by scaling to the nearest whole number and back."""
    if digits == 0:
        return f"rint({expression})"
    return f"rint(({expression}) * {number(10.0**digits)}) / {number(10.0**digits)}"


def as_double(name: str) -> str:
    return f"CAST({ident(name)} AS DOUBLE)"


def with_expressions(df: DataFrame, changes: dict[str, str], drop=()) -> DataFrame:
    """Replace or append columns by SQL text, in one projection."""
    if not changes and not drop:
        return df
    kept = [c for c in df.columns if c not in drop]
    present = set(kept)
    return df.selectExpr(
        *[f"{changes[c]} AS {ident(c)}" if c in changes else ident(c) for c in kept],
        *[f"{e} AS {ident(c)}" for c, e in changes.items() if c not in present],
    )
