"""Token ids in files: fixed-size blocks as byte planes, each compressed, with an index of chunks and documents.

A file set is a Parquet dataset (any file system, Spark's commit protocol).  A row is a block of
up to BLOCK_IDS ids of one file part:

* ``part``, ``chunk``: the part and the block's number in it; ``first``: ids before it in the part;
  ``n_ids``: its ids; ``planes``: binaries, plane k holds byte k of every id, compressed with
  zstandard; planes that are zero throughout are left out at the upper end;
* ``doc_id``, ``doc_row``, ``doc_first``, ``doc_ids``: arrays with an entry for every document that
  has an id in the block: its id, its number in the part, the place in the part where it starts, its length.

Parts ascend by doc_id.  The chunk index beside it has a row per part: ids and documents before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import python_ready, texts_of
from starmill.llm.words import ID, chunk_ids

BLOCK_IDS = 1 << 16
END_ID = 2
LEVEL = 3

_BLOCK = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int32()),
    ("planes", pa.list_(pa.binary())), ("doc_id", pa.list_(pa.int64())), ("doc_row", pa.list_(pa.int64())),
    ("doc_first", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64()))])
_BLOCK_SQL = ("part int, chunk long, first long, n_ids int, planes array<binary>, doc_id array<long>,"
              " doc_row array<long>, doc_first array<long>, doc_ids array<long>")


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Byte planes of little-endian ids, each compressed; empty planes at the upper end are left out."""
    planes = np.ascontiguousarray(ids.astype(ID).view(np.uint8).reshape(-1, ID.itemsize).T)
    used = 1 + max((k for k in range(ID.itemsize) if planes[k].any()), default=0)
    pack = zstandard.ZstdCompressor(level=LEVEL)
    return [pack.compress(p.tobytes()) for p in planes[:used]]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    out = np.zeros((ID.itemsize, n_ids), np.uint8)
    unpack = zstandard.ZstdDecompressor()
    for k, plane in enumerate(planes):
        out[k] = np.frombuffer(unpack.decompress(plane, max_output_size=n_ids), np.uint8)
    return np.ascontiguousarray(out.T).view(ID).ravel()


class _Blocks:
    """Cuts the ids of a part's documents into blocks; holds one block and one document."""

    def __init__(self, part: int, block_ids: int):
        self.part, self.block_ids, self.buffer, self.held = part, block_ids, [], 0
        self.chunk = self.first = self.row = 0
        self.docs: list[tuple[int | None, int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        entry = (doc_id, self.row, self.first + self.held, len(ids))
        self.row += 1
        while len(ids):
            self.docs.append(entry)
            piece, ids = ids[:self.block_ids - self.held], ids[self.block_ids - self.held:]
            self.buffer.append(piece)
            self.held += len(piece)
            if self.held == self.block_ids:
                yield self.close()

    def close(self) -> dict:
        columns = [list(c) for c in zip(*self.docs)]
        block = dict(zip(_BLOCK.names, [self.part, self.chunk, self.first, self.held,
                                        to_planes(np.concatenate(self.buffer)), *columns]))
        self.first, self.chunk, self.held, self.buffer, self.docs = self.first + self.held, self.chunk + 1, 0, [], []
        return block


def write(df: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id", text: str = "text",
          end_id: int = END_ID, block_ids: int = BLOCK_IDS, parts: int | None = None) -> None:
    """Write the ids of all texts, each with the end id after it, in ascending order of the id column.

    A null text is empty; null ids come first; rows with equal ids are ordered by their texts' hash, then
    by the scan, and may lie in several parts.  Other columns are left out.  An empty table writes an
    empty dataset.  Texts are shuffled once, by ranges of the id, and encoded in that order.
    """
    spark = df.sparkSession
    python_ready(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = rows.select("doc_id", "text", order[1].alias("h"), order[2].alias("n"))
    cut = rows.repartitionByRange(parts, order[0], "h", "n").sortWithinPartitions(order[0], "h", "n")
    cut = cut.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, blocks = chunk_ids(tokenizer, lower=True).ids, np.array([end_id], ID).tobytes(), None
        for batch in batches:
            for part, doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch, "text")):
                blocks = blocks or _Blocks(part, block_ids)
                for block in blocks.add(doc_id, np.frombuffer(ids_of(t) + end, ID)):
                    yield pa.RecordBatch.from_pylist([block], _BLOCK)
        if blocks and blocks.held:
            yield pa.RecordBatch.from_pylist([blocks.close()], _BLOCK)

    # The planes are compressed already.
    cut.mapInArrow(encode, _BLOCK_SQL).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    own = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"), (F.max(F.array_max("doc_row")) + 1).alias("docs"),
                                     F.count(F.lit(1)).alias("chunks"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    index = own.select("part", "ids", "docs", "chunks", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long").alias(f"{c}_before") for c in ("ids", "docs")])
    index.coalesce(1).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``part``, ``doc_row``, ``doc_id``, ``start`` (ids of all documents before it), ``ids`` (binary): one row per document.

    A block gives its whole documents at once; only those cut by a block's end are
    put together over a shuffle, each from its own pieces.
    """
    python_ready(spark)
    width = ID.itemsize

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                data = from_planes(b["planes"], b["n_ids"]).tobytes()
                a = [max(f - b["first"], 0) for f in b["doc_first"]]
                z = [min(f + n - b["first"], b["n_ids"]) for f, n in zip(b["doc_first"], b["doc_ids"])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["part"]] * len(a), pa.int32()), pa.array(b["doc_row"], pa.int64()),
                    pa.array([b["chunk"]] * len(a), pa.int64()), pa.array(b["doc_id"], pa.int64()),
                    pa.array(b["doc_first"], pa.int64()), pa.array(b["doc_ids"], pa.int64()),
                    pa.array([data[x * width:y * width] for x, y in zip(a, z)], pa.binary())],
                    names=["part", "doc_row", "chunk", "doc_id", "doc_first", "n", "ids"])

    pieces = spark.read.parquet(f"{folder}/blocks").mapInArrow(
        decode, "part int, doc_row long, chunk long, doc_id long, doc_first long, n long, ids binary")
    whole = F.octet_length("ids") == F.col("n") * width
    name = ["part", "doc_row", "doc_id", "doc_first"]
    cut = pieces.filter(~whole).groupBy(*name).agg(
        F.sort_array(F.collect_list(F.struct("chunk", F.hex("ids").alias("ids")))).alias("p"))  # pieces of one document
    docs = pieces.filter(whole).select(*name, "ids").union(
        cut.select(*name, F.unhex(F.array_join("p.ids", "")).alias("ids")))
    index = spark.read.parquet(f"{folder}/index").select("part", "ids_before")
    return (docs.join(F.broadcast(index), "part")  # a row for each part
            .select("part", "doc_row", "doc_id", (F.col("ids_before") + F.col("doc_first")).alias("start"), "ids"))
