"""Writing, replacing, appending, refreshing and compacting stored tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators import folders
from starmill.session import tidy

log = logging.getLogger("starmill")
# Of stored tables, whatever the session's own default.
COMPRESSION = "zstd"
REQUIRED = "starmill.required"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(folders.settle(spark, path))


def read_or_empty(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """A stored table, created empty on first use."""
    empty = T.StructType([T.StructField(f.name, f.dataType) for f in contract])
    spark.createDataFrame([], empty).write.mode("ignore").parquet(folders.settle(spark, path))
    return spark.read.schema(empty).parquet(path)


def observed(seen: Observation) -> dict | None:
    """Metrics of a finished action; ``None`` where they are unknown, as when an empty plan is optimized away."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return None


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, notes: Mapping[str, str] | None = None, in_place: bool = False,
                options: Mapping[str, str] | None = None, gathered: bool = False, **metrics) -> dict:
    """Write Parquet and return the row count (and ``metrics``), observed during the write itself.

    An overwrite is finished beside the table, with its ``notes``, and then put in its place: a job that dies leaves the
    old table whole.  ``in_place`` is for folders that nobody else reads.  ``options`` go to the writer.

    A partitioned table is rebalanced on its partition columns: adaptive
    execution splits a hot partition over tasks and merges small ones.  The
    writer needs the rows sorted by partition anyway; ``sort_by`` refines that
    order, so that the files' min/max values prune.  ``gathered`` rows lie by
    these partitions already, in the stored table that they are read from or by a shuffle of the
    caller's: they are written where they are, without another one, some more files than partitions.
    """
    seen, spark = Observation(), df.sparkSession
    beside = mode == "overwrite" and not in_place
    if partition_by and not gathered:
        df = df.hint("rebalance", *partition_by)
    # Counted in the last stage, where a re-run task counts once.
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    if partition_by or sort_by:
        rows = rows.sortWithinPartitions(*(partition_by or []), *(sort_by or []))
    out = rows.write.mode(mode).option("compression", COMPRESSION).options(**(options or {}))
    if partition_by:
        out = out.partitionBy(*partition_by)
    with tidy(spark):
        out.parquet(folders.beside(path) if beside else folders.settle(spark, path))
    if beside:
        for name, text in (notes or {}).items():
            folders.write_note(spark, folders.beside(path), name, text)
        folders.switch(spark, path)
    counts = observed(seen)
    if counts is None:  # counted again rather than taken for 0
        counts = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]).first().asDict()
    log.info("wrote %s rows to %s", counts["rows"], path)
    return counts


def export_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Delimited text for other tools: header, comma, double quotes, full replace; its files may be compressed."""
    out = df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    with tidy(df.sparkSession):
        out.csv(path, compression=compression)


def one_per_key(df: DataFrame, key: str, best: list[Column]) -> DataFrame:
    """The first row per key in the order of ``best``, which must be total; rows without a key all stay.

    Spark limits each key to one row before the shuffle, so a key that repeats a lot costs nothing.
    """
    order = Window.partitionBy(key).orderBy(*best)
    ranked = df.where(F.col(key).isNotNull()).withColumn("_row", F.row_number().over(order))
    return ranked.where("_row = 1").drop("_row").unionByName(df.where(F.col(key).isNull()))


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds."""
    out = df.hint("rebalance", *partition_by).write.mode("overwrite").option("compression", COMPRESSION)
    with tidy(df.sparkSession):
        out.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def compact_sorted(df: DataFrame, path: str, sort_keys: list[str], files: int | None = None) -> None:
    """Rewrite a table to a new path in range-sorted files, for tight min/max pruning.

    The range takes in every column, so that a single hot sort key still spreads.
    """
    spread = F.xxhash64(*df.columns)
    by = [*[F.col(k) for k in sort_keys], spread]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    with tidy(df.sparkSession):
        ranged.sortWithinPartitions(*sort_keys).write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def _ddl_column(field: T.StructField, default: str | None) -> str:
    comment = field.metadata.get("comment")
    parts = [f"`{field.name}` {field.dataType.simpleString()}", "" if field.nullable else "NOT NULL",
             f"DEFAULT {default}" if default else "", f"COMMENT {quoted(comment)}" if comment else ""]
    return " ".join(p for p in parts if p)


def quoted(text: str) -> str:
    """A text as a literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def move_into(spark: SparkSession, staging: str, target: str, replace: bool, tag: str = "") -> None:
    """Move the data files of a finished staging folder to ``target``, within one file system, instead of copying them.

    To replace, the folder takes the target's place.  An append gives its files names that begin with ``tag``, in
    place of those that so begin already: a source that is loaded again replaces its own files.
    """
    if replace:
        folders.remove(spark, folders.beside(target))
        folders.rename(spark, staging, folders.beside(target))
        folders.switch(spark, target)
        return
    folders.settle(spark, target)
    if tag:
        for name in folders.data_paths(spark, target):
            if name.rpartition("/")[2].startswith(tag):
                folders.remove(spark, f"{target}/{name}")
    folders.move_all(spark, staging, target, tag)


def register_table(spark: SparkSession, name: str, path: str, contract: T.StructType, comment: str = "",
                   partition_by: list[str] | None = None, defaults: dict[str, str] | None = None) -> None:
    """Declare a stored folder as a catalog table, if it is not there yet: types, required columns, defaults, comments.

    The catalog takes columns of files as nullable, so the required ones are also noted as a table property.
    """
    partitions = partition_by or []
    columns = ", ".join(_ddl_column(f, (defaults or {}).get(f.name)) for f in contract)
    required = ",".join(f.name for f in contract if not f.nullable)
    noted = f"TBLPROPERTIES ('{REQUIRED}' = '{required}')" if required else ""
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{path}' COMMENT {quoted(comment)} {noted}")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def analyze_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> None:
    """Collect the statistics that the cost-based optimizer uses: of all columns, or of the given ones."""
    chosen = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {chosen}")
