"""Compaction of the small files of a stored table; files that are filled well stay as they are.

The rows of the small files are written beside the table.  A note there that names the old files makes them
complete: from then on the old files go and the new ones are moved in, and whoever opens the table by
``settle_compaction`` finishes what was interrupted.  Without the note the draft is dropped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from starmill.operators import folders
from starmill.operators.sinks import read_table, write_table

TARGET_BYTES = 256 << 20
_REPLACES = "_replaces"


def _draft(path: str) -> str:
    return f"{path.rstrip('/')}__compact"


def settle_compaction(spark: SparkSession, path: str) -> str:
    """Finish or drop an interrupted compaction; gives back the path."""
    draft, path = _draft(path), folders.settle(spark, path)
    if (note := folders.read_note(spark, draft, _REPLACES)) is not None:
        for name in json.loads(note):
            folders.remove(spark, f"{path}/{name}")
        folders.move_all(spark, draft, path)
    else:
        folders.remove(spark, draft)
    return path


def small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Files under half the target size, of the partitions that have more of them than their bytes need."""
    by_partition: dict[str, list[tuple[str, int]]] = {}
    for name, size in folders.data_files(spark, path):
        if size < target_bytes / 2:
            by_partition.setdefault(name.rpartition("/")[0], []).append((name, size))
    return [name for small in by_partition.values() if len(small) > -(-sum(s for _, s in small) // target_bytes) for name, _ in small]


def compact_small_files(spark: SparkSession, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                        target_bytes: int = TARGET_BYTES) -> list[str]:
    """Rewrite the small files of partitions worth it, about ``target_bytes`` each; gives back the names of the files replaced.

    One job for all partitions, rebalanced on the partition columns: adaptive execution merges small partitions'
    rows into a task and splits large ones at its advisory size.
    """
    path = settle_compaction(spark, path)
    names = small_files(spark, path, target_bytes)
    if not names:
        return []
    rows: DataFrame = spark.read.schema(read_table(spark, path).schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])
    written = write_table(rows, _draft(path), partition_by=partition_by, sort_by=sort_by, in_place=True)["rows"]
    if written != rows.count():  # from file footers
        raise OSError(f"{written} rows written for the small files of {path}")
    folders.write_note(spark, _draft(path), _REPLACES, json.dumps(names))
    settle_compaction(spark, path)
    return names
