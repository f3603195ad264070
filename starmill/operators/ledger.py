"""A table's keys in a ledger, so that an append reads only what its keys may hit, and takes effect exactly once.

The ledger lies beside the table.  Its rows, a key and some columns, are hashed into bucket folders, and its
files carry Bloom filters of the key.  A batch of few keys opens the buckets these fall into only, and within them
only files whose filter lets one of them pass; a large batch is joined with the whole ledger, which is narrower than the table.

An append writes lines and entries beside both, notes that they are complete, and then moves them in.  Whoever
comes next completes a noted append and discards one that was not: table and ledger never disagree.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators import folders
from starmill.operators.sinks import one_per_key, read_or_empty, write_table

BUCKETS = 64  # fixed for a table once it has a ledger
# Keys of a batch that are sent to the scan, at most; with more of them every bucket is likely to be hit.
LISTED = 1_000
GENERATION, STATE = "_generation", "_state"


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(BUCKETS)).cast("int")


class Ledger:
    """Entries (``key`` and the columns ``also``) of the table stored at ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, also: tuple[str, ...] = (), number: str | None = None):
        """``number`` names a column whose highest value the ledger keeps in mind."""
        self.spark, self.path, self.key, self.also, self.number = spark, path.rstrip("/"), key, list(also), number
        self.folder = f"{self.path}__keys"
        self.entering = f"{self.path}__entering"  # new lines and entries on their way in
        self.recover()

    def recover(self) -> None:
        """Complete an append that was noted as complete; discard any other."""
        folders.settle(self.spark, self.path), folders.settle(self.spark, self.folder)
        done = folders.read_note(self.spark, self.entering, STATE)
        if done is not None:
            folders.move_all(self.spark, f"{self.entering}/lines", self.path)
            folders.move_all(self.spark, f"{self.entering}/keys", self.folder)
            folders.write_note(self.spark, self.folder, STATE, done)
        folders.remove(self.spark, self.entering)

    @property
    def top(self) -> int:
        """The highest ``number`` in the table, -1 without rows."""
        return json.loads(folders.read_note(self.spark, self.folder, STATE))["top"]

    def _write(self, rows: DataFrame, path: str, number: int, **metrics) -> dict:
        """Entries of ``number`` lines; filters are sized for a bucket's share of them."""
        entries = rows.where(F.col(self.key).isNotNull()).select(
            bucket_of(F.col(self.key)).alias("bucket"), self.key, *self.also, *([self.number] if self.number else []))
        return write_table(entries, path, partition_by=["bucket"], sort_by=[self.key], in_place=True, options={
            f"parquet.bloom.filter.enabled#{self.key}": "true",
            f"parquet.bloom.filter.expected.ndv#{self.key}": str(max(64, 2 * number // BUCKETS))}, **metrics)

    def ensure(self, table: DataFrame) -> None:
        """Build the ledger of a table that has none, or whose lines have been replaced since."""
        generation = folders.read_note(self.spark, self.path, GENERATION) or ""
        if folders.read_note(self.spark, self.folder, GENERATION) == generation:
            return
        new = folders.beside(self.folder)
        seen = self._write(table, new, table.count(), **({"top": F.max(self.number)} if self.number else {}))
        folders.write_note(self.spark, new, GENERATION, generation)
        folders.write_note(self.spark, new, STATE, json.dumps({"top": -1 if seen.get("top") is None else seen["top"]}))
        folders.switch(self.spark, self.folder)

    def entries(self) -> DataFrame:
        kinds = {f.name: f.dataType.simpleString() for f in self.spark.read.parquet(self.path).schema}
        names = [self.key, *self.also, *([self.number] if self.number else [])]
        schema = ", ".join([*(f"`{n}` {kinds[n]}" for n in names), "bucket int"])
        return self.spark.read.schema(schema).parquet(self.folder)

    def known(self, batch: DataFrame) -> DataFrame:
        """Entries that the keys of ``batch`` may hit: of few keys, only their buckets and themselves are asked for."""
        few = batch.select(self.key, bucket_of(F.col(self.key)).alias("b")).where(F.col(self.key).isNotNull()).limit(LISTED + 1).collect()
        entries = self.entries()
        if len(few) <= LISTED:
            entries = entries.where(F.col("bucket").isin(sorted({r["b"] for r in few})) & F.col(self.key).isin(sorted({r[0] for r in few})))
        return entries.select(self.key, *self.also)

    def unknown(self, lines: DataFrame, batch: DataFrame | None = None) -> DataFrame:
        """The lines whose key and other ledger columns no entry has; ``batch`` is a cheaper source of their keys."""
        known = self.known(lines if batch is None else batch)
        known = known.select([F.col(c).alias(f"_known{i}") for i, c in enumerate(known.columns)])
        # The other columns are compared as ranges: so both sides meet by the key alone, by which the lines are dealt already.
        same = F.col(self.key) == F.col("_known0")
        for i, c in enumerate(self.also, 1):
            same = same & (F.col(c) <= F.col(f"_known{i}")) & (F.col(c) >= F.col(f"_known{i}"))
        return lines.join(known, same, "left_anti").select(*lines.columns)

    def append(self, lines: DataFrame, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
               gathered: bool = False, **metrics) -> dict:
        """Add lines to the table and their keys to the ledger, both or neither; the counts of ``write_table``.

        ``gathered`` lines lie by the partitions already.
        """
        if self.number:
            metrics["top"] = F.max(self.number)
        staged = f"{self.entering}/lines"
        written = write_table(lines, staged, partition_by=partition_by, sort_by=sort_by, in_place=True, gathered=gathered, **metrics)
        if written["rows"]:
            self._write(self.spark.read.schema(lines.schema).parquet(staged), f"{self.entering}/keys", written["rows"])
            top = max(self.top, written["top"]) if self.number else -1
            folders.write_note(self.spark, self.entering, STATE, json.dumps({"top": top}))
        self.recover()
        return written


def append_new(df: DataFrame, path: str, key: str, partition_by: list[str] | None = None) -> dict:
    """Append the rows whose ``key`` is new, one per key; a replayed batch adds nothing.  Rows without a key are all appended."""
    spark = df.sparkSession
    ledger = Ledger(spark, path, key)
    ledger.ensure(read_or_empty(spark, path, df.schema))
    once = one_per_key(df, key, [F.col(c).desc_nulls_last() for c in df.columns])
    return ledger.append(ledger.unknown(once, batch=df), partition_by)

