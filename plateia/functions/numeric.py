"""Counts, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateia import defaults


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round to the even neighbour, scale back: the rounding of numeric arrays."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio_or_zero(part: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(part, total), F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    """Percent with two digits; NULL when the total is zero."""
    return round_half_even(F.try_divide(part, total) * 100)


def total(value: Column) -> Column:
    """Sum that is 0, not NULL, over nothing."""
    return F.coalesce(F.sum(value), F.lit(0))


def sentiment_counts(sentiment: Column) -> list[Column]:
    """One conditional count per sentiment, named sentimento_<name>."""
    return [
        F.count_if(sentiment == name).alias(f"sentimento_{name.lower()}")
        for name in defaults.SENTIMENTS
    ]
