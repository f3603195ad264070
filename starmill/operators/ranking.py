"""Ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Value ranges that a ranking is cut into.
RANGES = 256


def _range_of(df: DataFrame, value: str, ranges: int) -> Column:
    """Number of the value range of a row; ranges are about equal in size, and a null is in the lowest."""
    steps = [i / ranges for i in range(1, ranges)]
    limits = df.agg(F.percentile_approx(value, steps, 10_000).alias("limits")).first()["limits"] or []
    if not limits:
        return F.lit(0)
    bounds = F.array(*[F.lit(v) for v in sorted(set(limits))])
    return F.size(F.filter(bounds, lambda b: b < F.col(value)))


def rank_cuts(df: DataFrame, value: str, shares: dict[str, tuple[int, int]], ranges: int = RANGES) -> dict:
    """For each share ``(a, b)``: the lowest value whose percent rank from the top is at most a/b.

    The percent rank of a value is (rows above it) / (all rows - 1).  Equal
    values are folded into one row with a count, values are split into ranges
    of about equal size, and the rows above a range are the sum of the (at most
    256) counts of the higher ranges.  Only then is there a window, one task per
    range.  The result is exact: the approximate range limits affect balance only.
    One row comes back to the driver.
    """
    values = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    values = values.withColumn("_range", _range_of(df, value, ranges))
    higher = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    # One row per range: at most ``ranges``.
    totals = values.groupBy("_range").agg(F.sum("_n").alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(higher), F.lit(0)).alias("_before"),
        F.sum("_rows").over(every).alias("_total"))
    inside = Window.partitionBy("_range").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    placed = values.join(F.broadcast(totals), "_range").withColumn(
        "_above", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    cuts = [F.min(F.when(F.col("_above") * b <= (F.col("_total") - 1) * a, F.col(value))).alias(name)
            for name, (a, b) in shares.items()]
    return placed.agg(*cuts).first().asDict()


def running_total(df: DataFrame, value: str, tie: str, ranges: int = RANGES) -> DataFrame:
    """Adds ``running_total`` (largest ``value`` first, then by ``tie``) and ``grand_total``.

    Rows are cut into value ranges; only the ranges' sums, one row each, are added up centrally.
    Equal values lie in one range.
    """
    range_no = _range_of(df, value, ranges)
    rows = df.withColumn("_range", range_no)
    higher = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    # One row per range: at most ``ranges``.
    sums = rows.groupBy("_range").agg(F.sum(value).alias("_sum")).select(
        "_range", F.coalesce(F.sum("_sum").over(higher), F.lit(0)).alias("_before"), F.sum("_sum").over(every).alias("grand_total"))
    inside = Window.partitionBy("_range").orderBy(F.desc_nulls_last(value), tie).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(sums), "_range").withColumn(
        "running_total", F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_range", "_before")


def top_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """The ``n`` highest rows and every row equal to the last of them (whose value is fetched first)."""
    last = df.where(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(n).agg(F.min(value)).first()[0]
    return df.where(F.col(value) >= F.lit(last))
