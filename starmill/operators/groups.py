"""Groups of many rows within a month, by one shuffle of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A month's groups are dealt to so many places.
SLOTS = 16


def near_by_month(rows: DataFrame, month: list[str], others: list[str]) -> DataFrame:
    """``rows`` dealt by month and ``_slot``, a share of the month's groups of ``others``."""
    slot = F.pmod(F.xxhash64(*others), F.lit(SLOTS)) if others else F.lit(0)
    return rows.withColumn("_slot", slot.cast("int")).repartition(*month, "_slot")


def group_by_month(near: DataFrame, month: list[str], others: list[str], *aggregates: Column) -> DataFrame:
    """Groups of rows that lie ``near_by_month`` by the same columns.

    For groups of few rows each, which sums on the map side would only make wider.  The groups need no other shuffle,
    nor does a write by month.
    """
    return near.groupBy(*month, "_slot", *others).agg(*aggregates).drop("_slot")
