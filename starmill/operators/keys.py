"""Surrogate keys that stay the same from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the id's digest that name its bucket: 16 ** 3 = 4,096 buckets.
BUCKET_DIGITS = 3


def allocate_keys(ids: DataFrame, natural: str, surrogate: str, existing: DataFrame | None = None,
                  bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """Keys for the ids that ``existing`` (an id -> key map) does not hold yet.

    Keys are dense: the highest existing key plus the id's rank in the order
    (bucket, id), where the bucket is a prefix of the id's digest.  Buckets are
    even whatever the ids look like, each is ranked in its own task, and the
    start of a bucket comes from the (at most 4,096) bucket counts.  Nothing
    depends on how rows happen to be laid out, so a re-run gives the same keys.
    """
    # Folded up first: a repeated id must not crowd its bucket.
    new = ids.select(F.col(natural).cast("string").alias(natural)).where(F.col(natural).isNotNull()).distinct()
    first = 0
    if existing is not None:
        first = existing.agg(F.max(surrogate)).first()[0] or 0
        new = new.join(existing.select(natural), natural, "left_anti")
    new = new.withColumn("_bucket", F.substring(F.md5(F.col(natural).cast("binary")), 1, bucket_digits))
    # One row per bucket: bounded by 16 ** bucket_digits, so one task may rank them.
    so_far = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = new.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    return (
        new.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_bucket")
        .select(natural, (F.lit(first) + F.col("_start") + F.col("_rank")).cast("long").alias(surrogate))
    )


def number_rows(scan: DataFrame, name: str, first: int = 0) -> DataFrame:
    """Number the rows of a file scan, from ``first`` on (unique, not consecutive).

    Call it straight on a read of files, before any shuffle: then a re-run task
    reads the same split in the same order and repeats its numbers.
    """
    return scan.select((F.lit(first) + F.monotonically_increasing_id()).alias(name), *scan.columns)
