"""Shared helpers: reading tables, written intermediate tables, global order with prefix sums."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.session import work_folder

# Python workers see at most so many bytes of a partition at once, whatever the length of the texts.
BATCH_BYTES = 16 << 20

_roots: dict[str, str] = {}
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Bound what one Python worker holds by bytes (the default: 64 MB), and give the workers this package.

    The package goes with the session's files, once, so that a worker finds it wherever it runs.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    app, package = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app in _shipped or not package.is_dir():
        return
    _shipped.add(app)
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # read by the driver, which serves it to all workers
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))


_holder: list = [None, None]


def claim_memory(holder: object, release: Callable[[], None] | None = None) -> None:
    """In a Python worker: only one operator's look-ups stay in memory, those of the one that runs.

    A worker process serves one operator after the other; the former holder's look-ups are released,
    also by a holder that keeps none.
    """
    if _holder[0] is not holder:
        if _holder[1]:
            _holder[1]()
        _holder[:] = [holder, release]


def hadoop_path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this module wrote."""
    files, at = hadoop_path(spark, path)
    files.delete(at, True)


def _root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = root = f"{work_folder(spark)}/llm-{uuid.uuid4().hex[:8]}"

        def clean() -> None:
            try:
                remove_folder(spark, root)
            except Exception:  # noqa: BLE001  the session has ended already; the cluster's clean-up takes the folder
                pass

        atexit.register(clean)
    return _roots[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared work folder; what is left is deleted when the driver ends."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex[:8]}"


#: With this setting Spark deletes the shuffle files of a query when it ends, not when the driver collects garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` written to the shared work folder and read back: cuts lineage, survives lost executors.

    ``tidy`` frees the shuffle files of the write at its end.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    before = spark.conf.get(_TIDY)
    try:
        spark.conf.set(_TIDY, "true" if tidy else before)
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(_TIDY, before)
    kept = spark.read.schema(df.schema).parquet(folder)
    kept.stored_in = folder
    return kept


def drop(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    if folder := getattr(df, "stored_in", None):
        remove_folder(df.sparkSession, folder)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, prefixed until it clashes with no column of ``df`` (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ordered_prefix(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str,
                   parts: int | None = None) -> DataFrame:
    """Global order with running totals: ``_row`` and, for each of ``sums``, the total of all rows before.

    The rows are cut into ranges of the order and stored with the range's number.
    Only the totals per range (one row each) are summed up centrally; within a range a
    running sum adds the rest.  The scan order breaks ties, so that equal rows, however
    many, still spread over the ranges.  Wide columns should not come along.
    """
    spark = df.sparkSession
    df = df.withColumns({f"_v_{k}": v for k, v in sums.items()}).withColumn("_tie", F.monotonically_increasing_id())
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [*order, F.col("_tie").asc()]
    cut = stored(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), name)
    total = {"_row": F.count(F.lit(1))} | {k: F.coalesce(F.sum(f"_v_{k}"), F.lit(0)) for k in sums}
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    bases = cut.groupBy("_part").agg(*[v.alias(f"_n_{k}") for k, v in total.items()])
    bases = bases.select("_part", *[F.coalesce(F.sum(f"_n_{k}").over(before), F.lit(0)).cast("long").alias(f"_b_{k}")
                                    for k in total])
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    run = {"_row": F.lit(1)} | {k: F.col(f"_v_{k}") for k in sums}
    out = cut.join(F.broadcast(bases), "_part")
    out = out.withColumns({k: F.col(f"_b_{k}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in run.items()})
    out = out.drop("_part", "_tie", *[f"_v_{k}" for k in sums], *[f"_b_{k}" for k in total])
    out.stored_in = cut.stored_in
    return out


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def extended(schema: T.StructType, **fields: str) -> T.StructType:
    """``schema`` with more nullable fields, given as name = type."""
    return T.StructType([*schema.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()]])


def add_columns(df: DataFrame, new: dict[str, str], value: Callable[[list], dict[str, pa.Array]], text: str) -> DataFrame:
    """``df`` with columns computed by Arrow batch from its column ``text``; ``new`` has their types.

    ``value()`` is called with the batch's texts, null as None.  Other columns pass through, whatever their names.
    """
    python_ready(df.sparkSession)
    at, plain = df.columns.index(text), [f"c{i}" for i in range(len(df.columns))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = value(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *[made[n] for n in new]], names=[*plain, *safe])

    safe = [f"n{i}" for i in range(len(new))]
    schema = extended(df.toDF(*plain).schema, **dict(zip(safe, new.values())))
    return df.toDF(*plain).mapInArrow(add, schema).toDF(*df.columns, *new)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a column, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [*batch.schema.names, *new]
    return pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=names)
