"""Listings of stored files: presence, size and age, without reading contents."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _open(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def data_files(spark: SparkSession, folder: str) -> Iterator:
    """Statuses of the data files below ``folder``, from the file system's own listing; none if it does not exist.

    Lazy: whoever wants to know whether there is one takes the first.
    """
    files, path = _open(spark, folder)
    if not files.exists(path):
        return
    listing = files.listFiles(path, True)
    while listing.hasNext():
        status = listing.next()
        if not status.getPath().getName().startswith(("_", ".")):
            yield status


def folder_report(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """folder, files, bytes, size_mb, present (a data file exists), passed (and one has bytes).

    The required folders drive the report, so that an absent one, or an absent root, shows up as rows.
    Only they are asked: presence takes the first files of a listing, size the file system's summary
    (which also counts marker files).  No job is started.
    """
    rows = []
    for folder in folders:
        files, path = _open(spark, f"{root.rstrip('/')}/{folder}")
        present = passed = False
        for status in data_files(spark, f"{root.rstrip('/')}/{folder}"):
            present, passed = True, status.getLen() > 0
            if passed:
                break
        summary = files.getContentSummary(path) if present else None
        size = summary.getLength() if summary else 0
        rows.append((folder, summary.getFileCount() if summary else 0, size, size / (1024 * 1024), present, passed))
    return spark.createDataFrame(
        rows, "folder string, files long, bytes long, size_mb double, present boolean, passed boolean")


def missing_tables(spark: SparkSession, database: str, required: list[str]) -> list[str]:
    """Required tables that the catalog does not list."""
    listed = {t.name for t in spark.catalog.listTables(database)}
    return [name for name in required if name not in listed]


def file_freshness(spark: SparkSession, folder: str, as_of: Column, max_age_hours: int = 24) -> DataFrame:
    """Age of the newest file; status NO_DATA where there is none."""
    newest = max((s.getModificationTime() for s in data_files(spark, folder)), default=None)
    last = None if newest is None else datetime.fromtimestamp(newest / 1000, timezone.utc)
    return freshness_of(spark.createDataFrame([(last,)], "last_modified timestamp"), as_of, max_age_hours)


def freshness_of(newest: DataFrame, as_of: Column, max_age_hours: int = 24) -> DataFrame:
    """last_modified -> age_hours, fresh, threshold_hours and status (FRESH, STALE, NO_DATA)."""
    seconds = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("last_modified").cast("timestamp"))
    hours = (seconds.cast("decimal(20,0)") / 3600).cast("decimal(20,2)")
    fresh = F.coalesce(seconds <= max_age_hours * 3600, F.lit(False))
    status = F.when(F.col("last_modified").isNull(), "NO_DATA").when(fresh, "FRESH").otherwise("STALE")
    return newest.select("*", hours.alias("age_hours"), fresh.alias("fresh"),
                         F.lit(max_age_hours).alias("threshold_hours"), status.alias("status"))
