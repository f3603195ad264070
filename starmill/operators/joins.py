"""Joins from a large table to a lookup table that is unique on the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only when it is known to hold at most this many rows, and about so many bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
_TEXT_BYTES = 40
# A key with more than this share of the large side (at most 100 keys have it) is spread over SALTS tasks.
HOT_SHARE = 0.01
SALTS = 256
_MAX_HOT = 100  # 1 / HOT_SHARE
# Columns of few distinct values go to the rows as numbers, a short for each dense key, in blocks of so many keys.
MOST_VALUES = 10_000
KEY_BLOCK = 1024
_SKETCH_ITEMS = 10_000


def row_bytes(schema: T.StructType) -> int:
    """Bytes of a row in a broadcast table, roughly: text columns count as _TEXT_BYTES."""
    return 16 + sum(8 + _TEXT_BYTES * isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in schema)


def is_small(schema: T.StructType, rows: int, broadcast_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a lookup side of so many rows is broadcast."""
    return rows <= broadcast_rows and rows * row_bytes(schema) <= BROADCAST_BYTES


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> dict[str, list]:
    """Values that hold more than ``share`` of the rows, at most 100 per key column.

    One pass over the key columns only, with a bounded sketch per task.  A miss
    costs time, never rows: the result steers salting and nothing else.
    """
    sketches = [F.expr(f"approx_top_k(`{k}`, {_MAX_HOT}, {_SKETCH_ITEMS})").alias(k) for k in keys]
    found = df.agg(F.count(F.lit(1)).alias("_rows"), *sketches).first()
    return {
        k: [top["item"] for top in (found[k] or [])
            if top["item"] is not None and top["count"] >= share * found["_rows"]]
        for k in keys
    }


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: list, spread: str | Column,
                salts: int = SALTS) -> DataFrame:
    """Shuffle join that spreads the hot (and the missing) keys of ``left``.

    Rows of ``left`` with a hot key get one of ``salts`` numbers from the column
    ``spread``; the few matching rows of ``right`` are copied once per number.
    ``spread`` must be fixed per row, so that a re-run task repeats its choice.
    """
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    number = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, number).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", *, spread: str | Column,
                right_rows: int | None = None, hot: list | None = None, probe: DataFrame | None = None,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``left`` to a lookup table: broadcast if it is counted small in rows and bytes, else a salted shuffle join.

    ``right`` is counted (from file footers, if it is stored) unless ``right_rows`` is known.
    ``probe`` is a cheaper source of the hot keys than ``left``, such as the scan below it.
    """
    if right_rows is None:
        right_rows = right.count()
    if is_small(right.schema, right_rows, broadcast_rows):
        return left.join(F.broadcast(right), key, how)
    if hot is None:
        hot = hot_keys(left if probe is None else probe, [key])[key]
    return salted_join(left, right, key, how, hot, spread)


def numbered_values(rows: DataFrame, columns: list[str], most: int = MOST_VALUES) -> DataFrame | None:
    """The distinct values of some columns with a number, ``_code``, for each; None if they are more than ``most``."""
    found = rows.select(*columns).distinct().limit(most + 1).collect()
    if len(found) > most:
        return None
    schema = T.StructType([T.StructField("_code", T.IntegerType()), *[T.StructField(f.name, f.dataType) for f in rows.select(*columns).schema]])
    return rows.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(sorted(found, key=repr))], schema)


def with_number(rows: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``rows`` with the number of their values, in place of the values."""
    columns = [c for c in values.columns if c != "_code"]
    known = F.broadcast(values.select(F.col("_code").alias(name), *[F.col(c).alias(f"_known_{c}") for c in columns]))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_known_{c}"))
    return rows.join(known, same).drop(*columns, *[f"_known_{c}" for c in columns])


def with_values(rows: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``rows`` with the values of their number, in place of it."""
    return rows.join(F.broadcast(values.withColumnRenamed("_code", name)), name).drop(name)


def key_blocks(lookup: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """A lookup table of dense whole keys as blocks of numbers, and the values of the numbers.

    A key takes two bytes, so that a table too large to broadcast as rows may go to all tasks all the same.  None where the
    columns have too many values, or keys repeat, are sparse or too many.
    """
    seen = lookup.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n"), F.count_distinct(key).alias("distinct")).first()
    if not seen["n"] or seen["low"] < 0 or seen["n"] != seen["distinct"] or seen["high"] > 4 * seen["n"] or 2 * seen["high"] > BROADCAST_BYTES:
        return None
    values = numbered_values(lookup, columns)
    if values is None:
        return None
    number = F.col("_number").cast("short")
    block, place = F.floor(F.col(key) / KEY_BLOCK).alias("_block"), F.pmod(key, F.lit(KEY_BLOCK)).cast("int").alias("_place")
    given = with_number(lookup.where(F.col(key).isNotNull()), values, "_number").select(block, place, number.alias("_number"))
    # Every place of a block is there, whether it has a key or not.
    places = lookup.sparkSession.range((seen["high"] // KEY_BLOCK + 1) * KEY_BLOCK).withColumnRenamed("id", key)
    whole = given.unionByName(places.select(block, place, F.lit(None).cast("short").alias("_number"))).repartition("_block")
    listed = whole.groupBy("_block", "_place").agg(F.max("_number").alias("_number")).groupBy("_block").agg(
        F.sort_array(F.collect_list(F.struct("_place", "_number")))["_number"].alias("_numbers"))
    return listed, values


def block_join(left: DataFrame, blocks: DataFrame, key: str, name: str) -> DataFrame:
    """``left`` with the number of its key; rows whose key is not in the blocks go, as in an inner join."""
    left = left.withColumn("_block", F.floor(F.col(key) / KEY_BLOCK)).join(F.broadcast(blocks), "_block")
    number = F.get("_numbers", F.pmod(key, F.lit(KEY_BLOCK)).cast("int")).cast("int")
    return left.withColumn(name, number).drop("_block", "_numbers").where(F.col(name).isNotNull())


def count_orphans(fact: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """One row: how many fact rows have a key (or a missing key) that the lookup lacks.

    The fact is reduced to one row per key before it is shuffled, so a hot key costs nothing.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    missing = per_key.join(lookup.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_count"))
