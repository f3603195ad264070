"""Exact duplicates by recipes: texts as ordered lists of verified content-defined chunks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, all_columns, claim_memory, fresh, python_ready, stored

# A cut lies where the hash of the last WINDOW bytes ends in CUT_BITS zeros: every 2 KB on average.
WINDOW = 16
CUT_BITS = 11
MIN_CHUNK, MAX_CHUNK = 256, 16384
ID_BYTES = 16
# Conflicting identifiers that are sent to all tasks; with more of them the identifiers are made longer.
MAX_CONFLICTS = 10_000

_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")
_RUNS = re.compile(b"  +")


def normalise(text: str | None) -> bytes:
    """Each run of blanks and of the controls 9 to 13 as one blank, in UTF-8; null is empty."""
    data = (text or "").encode().translate(_SPACES)
    return _RUNS.sub(b" ", data) if b"  " in data else data


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    words = [hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)]
    return np.frombuffer(b"".join(words), "<u4")


def cut(data: bytes) -> list[bytes]:
    """Chunks of ``data``: cuts follow the content, so that equal passages give equal chunks.

    A chunk has MIN_CHUNK to MAX_CHUNK bytes (the last may be shorter).
    """
    if len(data) <= MIN_CHUNK:
        return [data]
    value = _gear()[np.frombuffer(data, np.uint8)]
    rolled = value.copy()
    for k in range(1, WINDOW):
        rolled[k:] += value[:-k] << np.uint32(k)
    # The upper bits depend on the whole window.
    spots = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
    out, start = [], 0
    for spot in [*spots.tolist(), len(data)]:
        while spot - start > MAX_CHUNK:
            out.append(data[start:start + MAX_CHUNK])
            start += MAX_CHUNK
        if spot - start >= MIN_CHUNK or (spot == len(data) and spot > start):
            out.append(data[start:spot])
            start = spot
    return out


def chunk_id(chunk: bytes, id_bytes: int, conflicts: frozenset[bytes] = frozenset()) -> bytes:
    """Digest of a chunk.  For a digest that two different chunks share, the chunk itself follows it."""
    digest = hashlib.blake2b(chunk, digest_size=id_bytes).digest()
    return digest + len(chunk).to_bytes(4, "little") + chunk if digest in conflicts else digest


def chunks(df: DataFrame, text: str, id_bytes: int) -> DataFrame:
    """``id``, ``chunk``: every chunk of every text, once per batch."""
    python_ready(df.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim_memory(cut)
        for batch in batches:
            found = {c for t in batch.column(0).to_pylist() for c in cut(normalise(t))}
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk_id(c, id_bytes) for c in found], pa.binary()), pa.array(list(found), pa.binary())],
                names=["id", "chunk"])

    return df.select(text).mapInArrow(split, "id binary, chunk binary")


def conflicting_ids(df: DataFrame, text: str, id_bytes: int, limit: int) -> list[bytes]:
    """Identifiers that stand for two different chunks, at most ``limit`` + 1 of them.

    The bytes themselves are compared: this is the only time that texts move, and of equal
    chunks one per task does.
    """
    same = chunks(df, text, id_bytes).groupBy("id").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
    return [bytes(r["id"]) for r in same.filter("a <> b").select("id").limit(limit + 1).collect()]


def with_recipe(df: DataFrame, recipe: str, digest: str | None = None, text: str = "text",
                id_bytes: int = ID_BYTES) -> DataFrame:
    """All columns of ``df`` and the recipe (the text's chunk identifiers in order), and the text's SHA-256.

    Two texts have equal recipes exactly if they are equal after ``normalise``: every identifier
    is verified against the bytes of all chunks that have it.
    """
    while len(found := conflicting_ids(df, text, id_bytes, MAX_CONFLICTS)) > MAX_CONFLICTS:
        id_bytes = min(64, 2 * id_bytes)
    conflicts = frozenset(found)

    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        claim_memory(cut)
        data = [normalise(t) for t in texts]
        recipes = [b"".join([chunk_id(c, id_bytes, conflicts) for c in cut(d)]) for d in data]
        made = {recipe: pa.array(recipes, pa.binary())}
        return made | ({digest: pa.array([hashlib.sha256(d).hexdigest() for d in data])} if digest else {})

    return add_columns(df, {recipe: "binary"} | ({digest: "string"} if digest else {}), add, text)


def exact_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", id_bytes: int = ID_BYTES) -> DataFrame:
    """``id_column``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``: one row per row of ``df``.

    Texts are equal if they are identical after ``normalise``; null equals empty.  Of equal texts the
    row with the smallest id is kept; a null id loses to any other; of rows that repeat the kept id,
    one is kept.  Groups are counted before the shuffle, and only those with more than one row
    are joined back, so texts without a copy move no further.  An empty table gives an empty result.
    """
    docs = with_recipe(df.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "recipe", "sha", "text", id_bytes)
    docs = stored(docs.drop("text").withColumn("row", F.monotonically_increasing_id()), "recipes")
    # The recipe itself is the key; as a struct minimum, a null id comes last.
    first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    groups = docs.groupBy("recipe").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    out = docs.join(groups, "recipe", "left")
    single = F.col("n").isNull()
    return out.select(
        F.col("id").alias(id_column),
        F.when(single, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("first.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def first_of_each(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole row with the smallest id of each group of equal texts; each task passes on one row per group."""
    recipe, n = fresh(df, "_recipe"), fresh(df, "_n")
    order = Window.partitionBy(recipe).orderBy(F.col(id_column).asc_nulls_last(), F.xxhash64(*all_columns(df)))
    return (with_recipe(df, recipe, text=text).withColumn(n, F.row_number().over(order))
            .filter(F.col(n) == 1).select(*all_columns(df)))
