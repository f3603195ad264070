"""Documents as token pieces, packed into few fixed-size sequences with a certified bound.

Each partition packs its pieces by best fit, largest first, and compares its number of
sequences with lower bounds from dual feasible functions.  A partition that meets its
bound is optimal and keeps its well-filled sequences, the others only full ones.  The pieces of all other
sequences go to a pool, which is dealt anew, in another order, and packed again, until all meet their
bounds, one partition has the whole pool, or a round saves next to nothing.  Each piece keeps the bound of the
partition that packed it last, and whether that was met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import drop, extended, python_ready, stored, texts_of, with_columns
from starmill.llm.words import ID, chunk_ids

CAPACITY = 1024
END_ID = 2
# What one task packs: a piece takes some 100 bytes there.
PIECES_PER_TASK = 200_000
# Below the limit of a task the session's cores share the pieces, but a lane has this many at least: smaller ones waste room.
PIECES_LEAST = 1024
# A round that saves less than this part of the pool's sequences is the last.
GAIN = 1000
# A sequence with at most this part of its room free stands if its lane meets the bound, and if it misses it.
WELL_FILLED, FULL_ENOUGH = 16, 64
MAX_GROUPS = 4096  # that are packed apart
SLICE_ROWS = 500  # of a batch whose texts and ids are Python objects at once


def pieces(df: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Columns of ``df`` but the text, and a row per piece: ``piece``, ``start``, ``length``, ``ids`` (binary).

    A document is its ids and the end id; a null or empty text is the end id alone.  Only a document
    longer than ``capacity`` is cut; all its pieces are full but the first.  Clashing columns are replaced.
    """
    python_ready(df.sparkSession)
    keep = [c for c in df.columns if c.lower() not in {text.lower(), "piece", "start", "length", "ids"}]
    plain = [f"c{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(keep, plain)], F.col(f"`{text}`").alias("text"))
    end, width = np.array([end_id], ID).tobytes(), ID.itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_ids(tokenizer, lower=False).ids
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            rows, piece, start, ids = [], [], [], []
            for i, t in enumerate(texts_of(batch, "text")):
                data = encode(t) + end
                n = len(data) // width
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(i), piece.append(k), start.append(a), ids.append(data[a * width:b * width])
            out = pa.RecordBatch.from_arrays(batch.columns[:-1], names=plain).take(pa.array(rows, pa.int64()))
            yield with_columns(out, {
                "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                "length": pa.array([len(x) // width for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())})

    schema = extended(rows.drop("text").schema, piece="int", start="long", length="long", ids="binary")
    return rows.mapInArrow(cut, schema).toDF(*keep, "piece", "start", "length", "ids")


def bound_of_counts(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs, by two families of dual feasible functions.

    A function that sums to at most 1 over every set of sizes that fits into one sequence
    gives the bound ceil(sum f(size)).  All in integers.
    """
    size = np.array(sorted(counts), np.int64)
    count = [counts[n] for n in size.tolist()]

    def bound(f: np.ndarray, one: int) -> int:
        return -(-sum(c * v for c, v in zip(count, f.tolist())) // one)

    best = bound(size, capacity)
    for e in range(1, capacity // 2 + 1):  # below e: nothing; above capacity - e: a whole sequence
        best = max(best, bound(np.where(size > capacity - e, capacity, np.where(size < e, 0, size)), capacity))
    for k in range(1, 21):  # (k + 1) * size in whole sequences, rounded down, over k; exact multiples as they are
        whole, rest = np.divmod((k + 1) * size, capacity)
        best = max(best, bound(np.where(rest == 0, size * k, whole * capacity), capacity * k))
    return best


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    sizes, counts = np.unique(lengths, return_counts=True)
    return bound_of_counts(dict(zip(sizes.tolist(), counts.tolist())), capacity)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, largest first: sequence and offset of each length, and the fill of each sequence."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by free room
    rooms, fills = 0, []  # rooms: bit r is set if a sequence with room r is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = free_at[room].pop()
            if not free_at[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, capacity - room
        fills[b] += n
        if left := room - n:
            free_at[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _round(df: DataFrame, parts: int, number: int, last: bool, capacity: int, group: Column) -> DataFrame:
    """Deal the pieces of each ``group`` (numbers from 0) over ``parts`` lanes and pack each; ``done`` tells which placements stand."""
    def fit(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy().astype(np.int64)
        bins, offsets, fills = best_fit(lengths, capacity)
        done, bound = np.full(len(fills), True), lower_bound(lengths, capacity)
        if not last:
            done = capacity - fills <= capacity // (FULL_ENOUGH if len(fills) > bound else WELL_FILLED)
        first = (number + 1 << 56) | (group.column("lane")[0].as_py() << 28)
        made = {"sequence_id": first + bins, "offset": offsets, "lane_bound": np.full(len(bins), bound),
                "certified": np.full(len(bins), len(fills) == bound), "done": done[bins]}
        for name, values in made.items():
            group = group.append_column(name, pa.array(values))
        return group

    # A row's number in a stored table is the same in each run of a task.  The lanes of a later round must mix
    # the former ones: of any ``parts`` rows in a row each lane gets one, in an order that the round seeds.
    row = F.monotonically_increasing_id()
    turn = F.xxhash64(F.floor(row / parts), F.lit(number)) if number else F.lit(0)
    dealt = df.withColumn("lane", group * parts + F.pmod(F.pmod(row, F.lit(parts)) + F.pmod(turn, F.lit(parts)), F.lit(parts)))
    return dealt.groupBy("lane").applyInArrow(fit, extended(
        dealt.schema, sequence_id="long", offset="long", lane_bound="long", certified="boolean", done="boolean"))


def _lanes(spark: SparkSession, pieces: int, pieces_per_task: int) -> int:
    """As many lanes as the cores can pack side by side, and never more pieces in one than a task holds."""
    return max(1, -(-pieces // pieces_per_task), min(spark.sparkContext.defaultParallelism, pieces // PIECES_LEAST))


def _numbered(df: DataFrame, by: str) -> Column:
    """A number, from 0, for each value of a column with few of them; null is one too."""
    values = [r[0] for r in df.select(by).distinct().limit(MAX_GROUPS + 1).collect()]
    if len(values) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups to pack apart")
    known = sorted(v for v in values if v is not None)
    numbers = F.create_map(*[F.lit(x) for k, v in enumerate(known, 1) for x in (v, k)])[F.col(by)] if known else F.lit(0)
    return F.coalesce(numbers, F.lit(0)).cast("long")


def pack(df: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES_PER_TASK, by: str | None = None) -> DataFrame:
    """Adds ``sequence_id``, ``offset``, ``lane_bound`` and ``certified`` to rows with a ``length`` of 1 to ``capacity``.

    Pieces are dealt by number, not by key, so that no hot key meets in one task; equal rows are
    separate pieces.  Other columns are carried along and should be narrow.  A lane has about
    ``pieces_per_task`` pieces at most in every round, and what stands is stored.  ``lane_bound`` is the least number of sequences
    for the lane that packed the piece last, ``certified`` whether it used no more.  A sequence has pieces of one value
    of the column ``by`` only, if that is given.  Lengths that are null or out of range
    have no place and must be filtered before.  An empty table gives an empty result.  Clashing columns are replaced.
    """
    place = ["sequence_id", "offset", "lane_bound", "certified"]
    names = [c for c in df.columns if c.lower() not in place]
    plain = ["length" if c == "length" else f"c{i}" for i, c in enumerate(names)]
    spark = df.sparkSession
    left = stored(df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)]), "pieces")
    python_ready(spark)
    packed, number, used = [], 0, None
    group = _numbered(left, plain[names.index(by)]) if by else F.lit(0).cast("long")
    parts = _lanes(spark, left.count(), pieces_per_task)
    while True:
        now = stored(_round(left.select(*plain), parts, number, parts == 1, capacity, group), f"packed{number}")
        if used:
            needed = now.select("sequence_id").distinct().count()
            if needed > used - max(1, used // GAIN):  # next to nothing saved: what is better stands
                packed.append((now if needed < used else left).select(*plain, *place))
                break
        packed.append(now.filter("done").select(*plain, *place))
        drop(left)
        rest = now.filter("not done").select(*plain, *place)
        used = rest.select("sequence_id").distinct().count()
        if parts == 1 or not used:
            break
        left, number = stored(rest, "pool"), number + 1
        parts = _lanes(spark, left.count(), pieces_per_task)
    out = packed[0]
    for more in packed[1:]:
        out = out.union(more)
    return out.toDF(*names, *place)


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences used, and a lower bound for any packing of the same pieces."""
    counts = packed.groupBy("length").count().collect()  # at most ``capacity`` rows
    return packed.select("sequence_id").distinct().count(), bound_of_counts({r["length"]: r["count"] for r in counts}, capacity)


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` (binary, at most the capacity) and ``starts`` of its pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex(ids).alias("ids"))))  # at most ``capacity`` pieces
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.unhex(F.array_join("p.ids", "")).alias("ids"), F.col("p.offset").alias("starts")))
