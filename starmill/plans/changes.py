"""Change data: merge a change feed into a table, keep a dimension's history, and look members up as of a day.

A table that takes change feeds is stored in buckets of its key, one folder each.  A merge reads and rewrites only the
buckets that the feed touches.  They are finished beside the table and then moved in; whoever opens the table next
completes a merge that died while moving, and drops one that died before.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators import folders
from starmill.operators.dimensions import keep_latest

LAYOUT, MERGED = "_layout", "_merged"
BIN_DAYS = 128


def merge_changes(stored: DataFrame, changes: DataFrame, key: str, version: str, deleted: str) -> DataFrame:
    """``stored`` after a change feed: the latest change per key replaces, adds or (``deleted``) removes the row.

    A change without a flag is no deletion.  One full outer join on the latest change; a marker on the
    change's side says from which side a row's values come, so that nulls are values too.
    A stored row without a key stays; a change without a key is left out, as it is nobody's.
    """
    latest = keep_latest(changes.where(F.col(key).isNotNull()), key, [version])
    side = F.struct(F.coalesce(F.col(deleted), F.lit(False)).alias("_gone"), *latest.columns)
    latest = latest.select(F.col(key).alias("_key"), side.alias("_change"))
    both = stored.join(latest, F.col(key) == F.col("_key"), "full")
    changed = F.col("_change").isNotNull()
    return both.where(~changed | ~F.col("_change._gone")).select(
        *[F.when(changed, F.col(f"_change.{c}")).otherwise(F.col(c)).alias(c) for c in stored.columns])


def customer_history(versions: DataFrame, key: str, day: str, tracked: list[str]) -> DataFrame:
    """Type-2 history: one row per period in which the ``tracked`` columns did not change.

    Of several versions on one day the last in column order counts, which also
    bounds a key's versions by the number of days.  The open period ends at null.
    """
    versions = versions.select(key, day, *tracked).where(F.col(key).isNotNull() & F.col(day).isNotNull())
    order = [F.col(c).desc_nulls_last() for c in tracked]
    one_a_day = versions.withColumn("_row", F.row_number().over(Window.partitionBy(key, day).orderBy(*order)))
    one_a_day = one_a_day.where("_row = 1").drop("_row")
    in_time = Window.partitionBy(key).orderBy(day)
    state = F.struct(*tracked)
    previous = F.lag(state).over(in_time)
    first = F.row_number().over(in_time) == 1
    changed = (one_a_day.withColumn("_changed", first | ~state.eqNullSafe(previous)).where("_changed").drop("_changed"))
    until = F.lead(day).over(in_time)
    return changed.select(key, *tracked, F.col(day).alias("valid_from"), until.alias("valid_to"),
                          until.isNull().alias("is_current"))


def _bucket(key: str, buckets: int, columns: list[str]) -> Column:
    """The bucket of a row; rows without a key spread by their values."""
    return F.pmod(F.when(F.col(key).isNull(), F.xxhash64(*columns)).otherwise(F.xxhash64(key)), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, path: str) -> None:
    df.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)


def create_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store a table in ``buckets`` folders by the hash of ``key``; it replaces what is there."""
    spark = df.sparkSession
    _write_buckets(df.withColumn("_bucket", _bucket(key, buckets, df.columns)), folders.beside(path))
    folders.write_note(spark, folders.beside(path), LAYOUT, json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()}))
    folders.switch(spark, path)


def _finish_merge(spark: SparkSession, path: str) -> None:
    """Move the buckets of a finished merge in; each step may be repeated."""
    draft = f"{path}__merge"
    note = folders.read_note(spark, draft, MERGED)
    if note is None:
        folders.remove(spark, draft)
        return
    merged = json.loads(note)
    for name in merged["full"]:
        if folders.exists(spark, f"{draft}/{name}"):  # else it has been moved
            folders.remove(spark, f"{path}/{name}")
            folders.rename(spark, f"{draft}/{name}", f"{path}/{name}")
    for name in merged["empty"]:
        folders.remove(spark, f"{path}/{name}")
    folders.remove(spark, draft)


def _open_buckets(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    path = folders.settle(spark, path)
    _finish_merge(spark, path)
    layout = json.loads(folders.read_note(spark, path, LAYOUT))
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(path), layout


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return _open_buckets(spark, path)[0].drop("_bucket")


def merge_into_buckets(spark: SparkSession, path: str, changes: DataFrame, version: str, deleted: str) -> list[int]:
    """Merge a change feed (see ``merge_changes``) into a table in buckets; gives back the buckets that were rewritten.

    The feed is read twice: for the touched buckets (at most as many numbers as there are buckets), and for the
    changes.  A feed that is merged again changes nothing.  One merge of a table runs at a time.
    """
    path = path.rstrip("/")
    table, layout = _open_buckets(spark, path)
    key, buckets = layout["key"], layout["buckets"]
    of_key = _bucket(key, buckets, [key])
    touched = sorted(r[0] for r in changes.where(F.col(key).isNotNull()).select(of_key).distinct().collect())
    if not touched:
        return []
    columns = [c for c in table.columns if c != "_bucket"]
    merged = merge_changes(table.where(F.col("_bucket").isin(touched)).drop("_bucket"), changes, key, version, deleted)
    draft = f"{path}__merge"
    _write_buckets(merged.withColumn("_bucket", _bucket(key, buckets, columns)), draft)
    names = [f"_bucket={b}" for b in touched]
    found = set(folders.children(spark, draft))
    folders.write_note(spark, draft, MERGED, json.dumps(
        {"full": [n for n in names if n in found], "empty": [n for n in names if n not in found]}))
    _finish_merge(spark, path)
    return touched


def insert_versions(history: DataFrame, late: DataFrame, key: str, day: str, tracked: list[str]) -> DataFrame:
    """A history (see ``customer_history``) with versions that come late, of any day.

    A late version splits the period it falls into and holds up to the next change that the history has; on the day of
    a change it takes that change's place.  Neighbours that become equal are joined.  Only the keys of late versions are
    built anew.
    """
    late = late.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day, *tracked)
    touched = history.join(late.select(key).distinct(), key, "left_semi")
    kept = touched.select(key, F.col("valid_from").alias(day), *tracked).join(late.select(key, day).distinct(), [key, day], "left_anti")
    rest = history.join(late.select(key).distinct(), key, "left_anti")
    return rest.unionByName(customer_history(kept.unionByName(late), key, day, tracked))


def as_of(facts: DataFrame, day: str, history: DataFrame, key: str, days: DataFrame | None = None) -> DataFrame:
    """``facts`` with the other columns of the ``history`` period that holds ``day``; null where there is none.

    Days are cut into bins of BIN_DAYS.  A period comes once for each bin it meets, of those that facts have (their number
    is bounded by the calendar), so that rows meet by key and bin and never all periods of a key; adaptive
    execution splits the bins of a hot key.  ``days`` is a cheaper source of the facts' days (``day``) than ``facts``, such as
    the table below a join; it may hold more of them.
    """
    def bin_of(value: Column) -> Column:
        return F.floor(F.unix_date(value) / BIN_DAYS).cast("int")

    names = [c for c in history.columns if c not in (key, "valid_from", "valid_to")]
    used = sorted(r[0] for r in (facts if days is None else days).where(F.col(day).isNotNull()).select(bin_of(F.col(day))).distinct().collect())
    first, last = bin_of(F.col("valid_from")), bin_of(F.date_sub("valid_to", 1))
    met = F.filter(F.array(*map(F.lit, used)).cast("array<int>"), lambda b: (b >= first) & (last.isNull() | (b <= last)))
    periods = history.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *names,
                             F.explode(met).alias("_period_bin"))
    binned = facts.withColumn("_bin", bin_of(F.col(day)))
    holds = (F.col(day) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(day) < F.col("_to")))
    joined = binned.join(periods, (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_period_bin")) & holds, "left")
    return joined.select(*facts.columns, *names)
