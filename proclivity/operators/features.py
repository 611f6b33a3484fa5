"""Ratio and gap features of the person table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from proclivity.functions.columns import col, safe_divide


@dataclass(frozen=True)
class Derived:
    """A derived column: its expression and the columns that must be there."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., Column]
    also_needs: tuple[str, ...] = ()


def _minus(a: Column, b: Column) -> Column:
    return a - b


def _quarter(a: Column) -> Column:
    return a / 4


# Names and inputs of the derived columns.
DERIVED = [
    Derived("AVG_GIFT_PER_DONATION", ("LIFETIME_GIFT_AMOUNT", "LIFETIME_GIFT_COUNT"), safe_divide),
    Derived("GIFT_AMOUNT_PER_PROMOTION", ("LIFETIME_GIFT_AMOUNT", "LIFETIME_PROM"), safe_divide),
    Derived("GIFT_COUNT_PER_PROMOTION", ("LIFETIME_GIFT_COUNT", "LIFETIME_PROM"), safe_divide),
    Derived("PROMOTION_RESPONSE_RATE", ("RECENT_RESPONSE_COUNT", "LIFETIME_PROM"), safe_divide),
    Derived(
        "MONTHS_BETWEEN_FIRST_AND_LAST_GIFT",
        ("MONTHS_SINCE_FIRST_GIFT", "MONTHS_SINCE_LAST_GIFT"),
        _minus,
    ),
    Derived(
        "GIFT_COUNT_PER_MONTH_ACTIVE",
        ("LIFETIME_GIFT_COUNT", "MONTHS_SINCE_FIRST_GIFT"),
        safe_divide,
    ),
    Derived(
        "PROMOTIONS_PER_MONTH_ACTIVE", ("LIFETIME_PROM", "MONTHS_SINCE_FIRST_GIFT"), safe_divide
    ),
    Derived(
        "RESPONSES_PER_YEAR",
        ("RECENT_RESPONSE_COUNT",),
        _quarter,
        ("RECENT_RESPONSE_PROP", "RECENT_CARD_RESPONSE_PROP"),
    ),
    Derived(
        "RECENT_RESPONSE_RATIO_GAP",
        ("RECENT_RESPONSE_PROP", "RECENT_CARD_RESPONSE_PROP"),
        _minus,
    ),
    Derived(
        "RECENT_RESPONSE_COUNT_GAP",
        ("RECENT_RESPONSE_COUNT", "RECENT_CARD_RESPONSE_COUNT"),
        _minus,
    ),
    Derived(
        "CARD_RESPONSE_SHARE",
        ("RECENT_CARD_RESPONSE_COUNT", "RECENT_RESPONSE_COUNT"),
        safe_divide,
    ),
    Derived(
        "CARD_RESPONSE_RATE", ("RECENT_CARD_RESPONSE_COUNT", "LIFETIME_CARD_PROM"), safe_divide
    ),
]
ENGINEERED_COLUMNS = [d.name for d in DERIVED]


def add_engineered_features(df: DataFrame) -> DataFrame:
    """Add every derived column whose inputs exist, in one projection."""
    have = set(df.columns)
    return df.withColumns(
        {
            d.name: d.make(*[col(i) for i in d.inputs])
            for d in DERIVED
            if have.issuperset(d.inputs + d.also_needs)
        }
    )
