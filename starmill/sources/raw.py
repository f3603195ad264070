"""Raw tables: files or catalog tables, read under the contract and never by inference."""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.dimensions import VERSION
from starmill.operators.sinks import move_into, observed
from starmill.schemas import RAW, coerce

log = logging.getLogger("starmill")
CORRUPT = "_corrupt_record"


class LoadError(Exception):
    """More unreadable rows than the load allows."""


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "csv", with_version: bool = False) -> DataFrame:
    """A raw table from files.  Text files keep every value as text; the builders convert it.

    Columns go by the header's names: their order does not matter and extra ones
    are left out.  A missing one, or a file whose header differs from the
    others', is an error rather than a shifted table.
    ``with_version`` adds the source file's modification time, the tie-breaker
    for duplicate ids that carry no business date.
    """
    if fmt == "csv":
        df = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    version = [F.col("_metadata.file_modification_time").alias(VERSION)] if with_version else []
    return df.select(*RAW[table].names, *version)


def read_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalog table; ``count_reads`` adds its row count to the first action on it."""
    try:
        return spark.table(f"{database}.{table}")
    except Exception:
        log.error("cannot read %s.%s", database, table)
        raise


def count_reads(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its row count, filled by the first action instead of by one of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The result of a warehouse query, read by the executors."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_for_load(spark: SparkSession, path: str, contract: T.StructType, **options: str) -> DataFrame:
    """Delimited text under a typed contract, by position, header skipped; bad rows keep their text."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in contract] + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).options(**options).csv(path))


def bulk_load(spark: SparkSession, path: str, table: str, contract: T.StructType, target: str, quarantine: str,
              loaded_at: Column, max_errors: int = 100, append: bool = False, **options: str) -> dict:
    """Load text files into a Parquet table, in place of it or (``append``) beside what it holds.

    Rows that do not parse, or lack a required column, go to the quarantine, in a folder of this source
    and table: a repeated load replaces its own lines there, and an appended one its own files in the target.  The load itself counts the bad rows; the text is
    parsed a second time only if there are any.  With more than ``max_errors`` of them the load fails
    before the target is touched; else the written files are moved there.  ``options`` go to the
    reader, such as ``dateFormat``.
    """
    rows = read_for_load(spark, path, contract, **options)
    lacking = F.lit(False)
    for f in contract:
        lacking = lacking | F.col(f.name).isNull() if not f.nullable else lacking
    unfit = F.col(CORRUPT).isNotNull() | lacking
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(unfit).alias("bad"))
    staging, source = f"{target}_staging", hashlib.md5(path.encode()).hexdigest()[:12]
    counted.where(~unfit).drop(CORRUPT).write.mode("overwrite").parquet(staging)
    counts = observed(seen)
    if counts is None:
        counts = rows.cache().agg(F.count(F.lit(1)).alias("read"), F.count_if(unfit).alias("bad")).first().asDict()
        rows.unpersist()
    if counts["bad"]:
        parsed = F.to_json(F.struct(*contract.names)).alias("parsed")
        bad = rows.where(unfit).select(
            F.lit(table).alias("table_name"), loaded_at.alias("load_ts"), F.col(CORRUPT).alias("raw_line"), parsed)
        bad.write.mode("overwrite").parquet(f"{quarantine}/load={table}-{source}")
    if counts["bad"] > max_errors:
        raise LoadError(f"{table}: {counts['bad']} unreadable rows, {max_errors} allowed")
    move_into(spark, staging, target, replace=not append, tag=f"{source}-" if append else "")
    return {"table_name": table, "rows_read": counts["read"], "rows_loaded": counts["read"] - counts["bad"],
            "rows_rejected": counts["bad"]}


def schema_drift(spark: SparkSession, path: str, table: str, fmt: str = "csv", sampling: float = 1.0) -> DataFrame:
    """The contract against the schema found in the files: one row per column.  Text files are read whole by default.

    status: ``match``, ``type_differs``, ``missing`` (not in the files) or ``extra`` (allowed).
    """
    if fmt == "csv":
        found = (spark.read.option("header", True).option("inferSchema", True)
                 .option("samplingRatio", sampling).csv(path).schema)
    else:
        found = spark.read.format(fmt).load(path).schema
    have = {f.name: f.dataType.simpleString() for f in found}
    want = {f.name: f.dataType.simpleString() for f in RAW[table]}
    rows = []
    for name in [*want, *[n for n in have if n not in want]]:
        if name not in have:
            status = "missing"
        elif name not in want:
            status = "extra"
        else:
            status = "match" if have[name] == want[name] else "type_differs"
        rows.append((table, name, want.get(name), have.get(name), status))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, contract_type string, found_type string, status string")


def coercion_failure(table: str, column: str) -> Column:
    """True where a value is there but does not convert to the contract's type."""
    return F.col(column).isNotNull() & coerce(F.col(column), RAW[table][column].dataType).isNull()
