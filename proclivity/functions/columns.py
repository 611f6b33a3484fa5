"""Small column helpers: quoting, rounding, division and null normalisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the largest finite single-precision number.
FLOAT32_MAX = 3.4028234663852886e38


def col(name: str) -> Column:
    """Column by its exact name, safe for names that hold dots or question marks."""
    return F.col("`" + name.replace("`", "``") + "`")


def double(value: float | None) -> Column:
    """Double literal; ``None`` becomes a null double."""
    return F.lit(None if value is None else float(value)).cast("double")


def half_even(column: Column, digits: int = 4) -> Column:
    """Round half to even as numeric arrays are rounded: scale, nearest whole number, scale back.

    The decimal rounding of SQL looks at the printed digits instead and may differ in the last one.
    """
    if digits == 0:
        return F.rint(column)
    scale = F.lit(10.0**digits)
    return F.rint(column * scale) / scale


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient in which a zero denominator gives null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def any_of(flags: list[Column]) -> Column:
    """True where any flag is true; null flags count as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags])


def last_name_part(column: Column) -> Column:
    """Text after the last double underscore, the bare feature name."""
    return F.element_at(F.split(column, "__"), -1)


def decide(score: Column, threshold) -> Column:
    """1 where the score reaches the threshold, else 0; a null score stays null."""
    return (score >= threshold).cast("int")


def neg_log10(p: Column) -> Column:
    """-log10 of a probability floored at 1e-300, so that it stays finite."""
    return -F.log10(F.greatest(p, F.lit(1e-300)))
