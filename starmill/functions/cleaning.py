"""Cleaning expressions for raw columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(*parts: str) -> Column:
    """Parts joined by a blank; missing parts are skipped."""
    return F.trim(F.concat_ws(" ", *parts))


def digits_only(name: str) -> Column:
    return F.regexp_replace(name, "[^0-9]", "")


def lower_trim(name: str) -> Column:
    return F.lower(F.trim(name))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(name))


def margin_percent(price: Column, cost: Column) -> Column:
    """Margin in percent of the price; 0 unless the price is positive."""
    return F.when(price > 0, (price - cost) / price * 100).otherwise(F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, 0 where the denominator is 0 or missing."""
    den = denominator.cast("double")
    return F.when(den.isNull() | (den == 0), F.lit(0.0)).otherwise(numerator.cast("double") / den)
