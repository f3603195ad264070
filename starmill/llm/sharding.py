"""Contiguous shards of near-equal byte size, from global prefix sums (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ordered_prefix

ROW_BYTES = 16


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed amount for the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def byte_shards(df: DataFrame, order: list[Column], size: Column, shards: int) -> DataFrame:
    """Adds ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    The rows keep the given order.  With T bytes in all, a row whose middle byte is number M goes to
    shard floor(M * shards / T): the cuts are those next to the equal targets, so a shard misses its
    target by the size of the largest row at most.  A shard may be empty if a row is larger than a target.  Sizes must
    be positive.  Ties in the order are broken by the position in the scan; equal rows may lie on
    both sides of a cut.  Null keys sort as the order says.  An empty table gives an empty result.
    Columns named like the new ones are replaced; drop wide columns before, as the rows are shuffled once.
    """
    df = df.drop("shard", "slot").withColumn("size", size)
    placed = ordered_prefix(df, order, {"_start": F.col("size")}, "shards")
    total = placed.agg(F.sum("size").alias("total")).first()["total"] or 1
    # Decimal: the product may exceed a long.
    middle = F.col("_start").cast("decimal(30,0)") * 2 + F.col("size")
    at = F.floor(middle * shards / F.lit(2 * total))
    placed = placed.withColumn("shard", at.cast("int"))
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # a row for each shard
    return (placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("_row") - F.col("_first"))
            .drop("_start", "_row", "_first"))
