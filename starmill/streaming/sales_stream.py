"""Continuous ingest of files: each new key is appended once, however late it comes."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.ledger import append_new
from starmill.operators.sinks import read_table
from starmill.plans.pipeline import load_fact
from starmill.plans.summaries import sync_summaries
from starmill.plans.warehouse import DIM_TABLES, open_star


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                files: str = "*", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", files)
    if fmt == "csv":
        reader = reader.option("header", True)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(folder)


def append_stream(stream: DataFrame, key: str, target: str, checkpoint: str):
    """Start an append of what is there now to a Parquet folder, each key once.

    A watermark would drop what arrives after it; the target itself tells what is known, so a row is never too
    late and a batch repeated after a restart adds nothing.  Rows without a key are all appended.
    """
    def load(batch: DataFrame, _batch_id: int) -> None:
        append_new(batch, target, key)

    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def load_sales_stream(stream: DataFrame, target: str, checkpoint: str):
    """Append newly arrived raw sales to the stored fact, one load per micro-batch.

    A batch that is repeated after a failure, or a sale that is delivered twice
    at any distance, adds nothing: the ledger of the fact's ids knows it.  The stored summaries follow, also those that a
    batch which died in between left behind.
    """
    spark = stream.sparkSession

    def load(batch: DataFrame, _batch_id: int) -> None:
        rows = {d: read_table(spark, f"{target}/{t}").count() for d, t in DIM_TABLES.items()}
        loaded = load_fact(spark, batch, target, F.lit(datetime.now(timezone.utc)), rows, append=True)
        sync_summaries(open_star(spark, target, rows), target, loaded)

    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
