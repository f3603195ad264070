"""Measures over fact rows, usable in any ``agg``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.cleaning import safe_ratio


def total(name: str) -> Column:
    return F.sum(name)


def mean(name: str) -> Column:
    """Average as a double of exact decimal sums, so that it does not depend on row order."""
    return F.sum(name).cast("double") / F.count(name)


def total_sales() -> Column:
    return total("net_amount")


def transactions() -> Column:
    return F.count("sale_key")


def average_sale() -> Column:
    return mean("net_amount")


def unique_customers() -> Column:
    return F.count_distinct("customer_key")


def total_discount() -> Column:
    return total("discount_amount")


def discount_rate() -> Column:
    return safe_ratio(F.sum("discount_amount"), F.sum("gross_amount"))
