"""Fingerprints for edit distance: a randomised embedding, sampled, banded and verified.

All texts share one random walk: at step j, standing on character c, the walk writes c and moves on or
stays, as a random bit of (j, c) says.  After an insertion or deletion two walks soon fall in step
again, so a small edit distance becomes a small Hamming distance of what they write.  A fingerprint
has 4 bits of what is written at about 256 to 512 steps, spread evenly over the whole walk.  The steps are
nested: level k has one in each 2^k, half of those of level k - 1, so fingerprints of texts of different
lengths are compared on the steps they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, drop, fresh, python_ready, stored

SAMPLES = 512
PERIOD = 1024  # steps after which the walk's random bits repeat
CLASSES = 256
SEED = 20
# Prints alike by 0.8 share one of 32 samples of 9 steps with a probability of 0.99; unlike ones, a tenth of whose steps agree, hardly ever.
BANDS, BAND_STEPS = 32, 9
NEAR = 0.8
LISTED = 8  # members of a bucket whose pairs are listed; more are compared in groups of two blocks
BLOCK = 4_000  # a group has two blocks at most, some 4 MB
_SEGMENT = 1 << 16
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


@lru_cache(maxsize=1)
def _dwell() -> bytes:
    """How many steps the walk stays on a character of a class, from a step on; at PERIOD x class."""
    bits = np.random.RandomState(SEED).randint(0, 2, (PERIOD, CLASSES)).astype(bool)
    bits[-1] = True  # so that every stay ends
    out = np.zeros((PERIOD, CLASSES), np.uint8)
    stay = np.ones(CLASSES, np.int64)
    for step in range(PERIOD - 1, -1, -1):
        stay = np.where(bits[step], 1, stay + 1)
        out[step] = stay
    return out.tobytes()


def _mix(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint64(SEED)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(29))
    return h


def _finer(blocks: np.ndarray, level: int, to: int) -> np.ndarray:
    """Where the steps of these blocks of ``level`` stand among those of a finer level ``to``."""
    for k in range(level, to, -1):
        blocks = 2 * blocks + (_mix(k, blocks) & np.uint64(1)).astype(np.int64)
    return blocks


def level_of(n_chars: int) -> int:
    """The walk takes some two steps a character."""
    return max(0, (2 * n_chars - 1).bit_length() - SAMPLES.bit_length() + 1) if n_chars else 0


@lru_cache(maxsize=64)
def _steps(level: int, block: int) -> np.ndarray:
    """Sampled steps of a level, SAMPLES blocks at a time."""
    return _finer(np.arange(block * SAMPLES, (block + 1) * SAMPLES), level, 0)


class Walk:
    """A walk under way: fed with text, it keeps the sampled digits and never the path."""

    def __init__(self, level: int):
        self.level, self.step, self.digits = level, 0, []

    def copy(self) -> Walk:
        other = Walk(self.level)
        other.step, other.digits = self.step, list(self.digits)
        return other

    def feed(self, text: str) -> Walk:
        dwell, mask = _dwell(), PERIOD - 1
        for a in range(0, len(text), _SEGMENT):
            codes = np.frombuffer(text[a:a + _SEGMENT].encode("utf-32-le", "surrogatepass"), np.uint32)
            j, begin, ends = self.step, self.step, []
            for c in ((codes ^ (codes >> np.uint32(8))) & np.uint32(CLASSES - 1)).astype(np.uint8).tobytes():
                j += dwell[(j & mask) << 8 | c]
                ends.append(j)
            self.step, path = j, np.array(ends, np.int64)
            for block in range((begin >> self.level) // SAMPLES, (j >> self.level) // SAMPLES + 1):
                at = _steps(self.level, block)
                at = at[(at >= begin) & (at < j)]
                letters = codes[np.searchsorted(path, at, side="right")]
                digit = _mix(at, letters) >> np.uint64(60)
                self.digits += zip((at >> self.level).tolist(), digit.tolist())
        return self

    def fingerprint(self) -> str:
        """Level in two hex digits, then a hex digit for each sampled step; ``-`` for one beyond the end."""
        out = ["-"] * -(-self.step // (1 << self.level))
        for block, digit in self.digits:
            out[block] = "0123456789abcdef"[digit]
        return f"{self.level:02x}" + "".join(out)


def fingerprint(text: str | None) -> str:
    """Fingerprint of a whole text; that of a null or empty one has no digits."""
    return Walk(level_of(len(text or ""))).feed(text or "").fingerprint()


def likeness(a: str, b: str) -> float:
    """Share of equal digits (0 to 1) on the coarser one's steps; of two empty texts 1, of one and a text 0."""
    if a == b:
        return 1.0
    if a[:2] > b[:2]:
        a, b = b, a
    x, y = (np.frombuffer(s[2:].encode(), np.uint8) for s in (a, b))
    n, fine = int(b[:2], 16), int(a[:2], 16)
    if n > fine:
        at = _finer(np.arange(-(-len(x) >> (n - fine)) or 0), n, fine)
        x = np.where(at < len(x), np.concatenate([x, np.full(1, 45, np.uint8)])[np.minimum(at, len(x))], 45)
    both, most = min(len(x), len(y)), max(len(x), len(y))
    return float(((x[:both] == y[:both]) & (x[:both] != 45)).sum() / most) if both else 0.0


def with_fingerprint(df: DataFrame, name: str, text: str = "text") -> DataFrame:
    """All columns of ``df`` and the fingerprint; a column of that name is replaced."""
    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        return {name: pa.array([fingerprint(t) for t in texts], pa.string())}

    return add_columns(df.drop(name), {name: "string"}, add, text)


def _row(fp: str, level: int) -> np.ndarray:
    """Digits of a fingerprint at its own or a coarser level, as bytes."""
    own, digits = int(fp[:2], 16), np.frombuffer(fp[2:].encode(), np.uint8)
    if level == own:
        return digits
    at = _finer(np.arange(-(-len(digits) >> (level - own))), level, own)
    return np.where(at < len(digits), np.append(digits, np.uint8(45))[np.minimum(at, len(digits))], np.uint8(45))


@lru_cache(maxsize=2048)
def _picks(length: int) -> np.ndarray:
    """Places of each band's digits in a row of that length: of a fixed shuffle, the first one within the row.

    A row longer or shorter by a step or two thus has nearly all places in common.
    """
    shuffles = np.random.RandomState(SEED).rand(BANDS, BAND_STEPS, SAMPLES)
    return shuffles[:, :, :max(1, length)].argmin(axis=2)


def band_keys(fp: str, threshold: float = NEAR) -> np.ndarray:
    """Keys of a fingerprint's bands at its own level and, if a coarser one may be alike, at the next one.

    Texts of the next level have about SAMPLES / 2 blocks there or more, and lengths of alike texts differ by the
    threshold at most; a tenth is left for walks that are shorter or longer than usual.
    """
    own, bands, out = int(fp[:2], 16), np.arange(BANDS), []
    for level in (own, own + 1) if len(fp) - 2 >= 0.9 * threshold * SAMPLES else (own,):
        row = _row(fp, level)
        digits = (row if len(row) else np.full(1, 45, np.uint8))[_picks(len(row))]
        out.append(_mix(level, bands, *digits.T).view(np.int64))
    return np.concatenate(out)


def forest(prints: list[str], threshold: float) -> list[tuple[int, int]]:
    """Places of pairs alike by ``threshold`` that join all that chains of such pairs join.

    Whoever is reached becomes a head in its turn and is held against all that are not reached yet.
    """
    own = np.array([int(fp[:2], 16) for fp in prints])
    rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by level: a row for each print of this level or a finer one
    for level in set(own.tolist()):
        found = [_row(fp, level) if o <= level else np.zeros(0, np.uint8) for fp, o in zip(prints, own.tolist())]
        lengths = np.array([len(r) for r in found])
        table = np.zeros((len(found), lengths.max(initial=0)), np.uint8)
        for i, r in enumerate(found):
            table[i, :len(r)] = r
        rows[level] = table, lengths
    links, open_ = [], np.arange(len(prints))
    while len(open_):
        heads, open_ = [int(open_[0])], open_[1:]
        while heads and len(open_):
            head, reached = heads.pop(), []
            coarser = np.maximum(own[open_], own[head])
            for level in np.unique(coarser).tolist():
                table, lengths = rows[level]
                others = open_[coarser == level]
                equal = ((table[others] == table[head]) & (table[head] > 45)).sum(axis=1)
                reached.append(others[equal / np.maximum(1, np.maximum(lengths[others], lengths[head])) >= threshold])
            new = np.concatenate(reached)
            links += [(head, i) for i in new.tolist()]
            heads += new.tolist()
            open_ = np.setdiff1d(open_, new)
    return links


def print_classes(prints: DataFrame, threshold: float = NEAR) -> DataFrame:
    """``fp``, ``class_id`` of fingerprints (``fp``, each once, with the smallest id ``first``) that have a link.

    A fingerprint gives BANDS samples of BAND_STEPS digits at its own level and, near a limit, at the next, so that lengths on
    both sides of it meet.  All pairs in a bucket of equal samples count.  Those of small buckets are listed,
    each pair once, and verified.  A larger bucket is cut into blocks, and each two blocks are one
    group, in which members are verified against heads until all are reached.  Chains cross groups and buckets.
    Other columns are left out; without rows the result is empty.  Each table is deleted once the next one is stored.
    """
    from starmill.llm.simhash import components

    python_ready(prints.sparkSession)
    nodes = stored(prints.withColumn("node", F.monotonically_increasing_id()), "prints", tidy=True)

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(fp, threshold) for fp in batch.column(0).to_pylist()]
            node = np.repeat(batch.column(1).to_numpy(), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*keys, np.zeros(0, np.int64)])), pa.array(node)],
                                             names=["key", "node"])

    bands = stored(nodes.select("fp", "node").mapInArrow(band, "key long, node long"), "bands", tidy=True)
    hot = stored(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets", tidy=True)
    members = stored(bands.join(hot, "key"), "members", tidy=True)
    drop(bands), drop(hot)
    small = members.filter(F.col("n") <= LISTED)
    pairs = small.select("key", F.col("node").alias("a")).join(small.select("key", F.col("node").alias("b")), "key")
    pairs = pairs.filter("a < b").select("a", "b").distinct()
    of = nodes.select("node", "fp")

    @F.pandas_udf("double")
    def alike(a, b):
        import pandas as pd

        return pd.Series([likeness(x, y) for x, y in zip(a, b)])

    pairs = pairs.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b")
    edges = pairs.withColumn("like", alike("x", "y")).filter(F.col("like") >= threshold).select("a", "b")

    def join(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        links = np.array(forest(group.column("fp").to_pylist(), threshold), np.int64).reshape(-1, 2)
        ends = np.sort(node[links], axis=1)
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    large = members.filter(F.col("n") > LISTED).withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")
    edges = edges.union(large.join(of, "node").groupBy("key", "i", "j").applyInArrow(join, "a long, b long"))
    edges = stored(edges, "edit-edges", tidy=True)
    drop(members)
    labels = components(edges).toDF("node", "label")
    linked = nodes.join(labels, "node")
    least = linked.groupBy("label").agg(F.min("first").alias("class_id"))
    classes = stored(linked.join(least, "label").select("fp", "class_id"), "print-classes", tidy=True)
    drop(edges), drop(nodes)
    return classes


def with_class(df: DataFrame, fp: str, id_column: str = "doc_id", threshold: float = NEAR) -> DataFrame:
    """All columns of ``df`` and ``class_id``, the smallest id of the rows whose fingerprints ``fp`` chains join.

    Equal fingerprints are folded first.  Only fingerprints that more than one row has or that are linked are looked up.  A null
    id never is the smallest; a class of null ids only has a null id.  Rows with a null fingerprint are their own class.
    A column ``class_id`` is replaced, others stay whatever their names.  An empty table gives an empty result.
    """
    df = df.drop("class_id")
    prints = stored(df.groupBy(F.col(f"`{fp}`").alias("fp")).agg(F.min(f"`{id_column}`").alias("first"), F.count(F.lit(1)).alias("n"))
                    .filter("fp is not null"), "distinct", tidy=True)
    linked = print_classes(prints.select("fp", "first"), threshold)
    key, own, known = fresh(df, "_fp"), fresh(df, "_class"), fresh(df, "_known")
    found = prints.join(linked.withColumn("linked", F.lit(True)), "fp", "left").filter("linked or n > 1")
    classes = stored(found.select(F.col("fp").alias(key), F.when(F.col("linked"), F.col("class_id")).otherwise(F.col("first")).alias(own),
                                  F.lit(True).alias(known)), "classes", tidy=True)
    drop(prints), drop(linked)
    out = df.join(classes, F.col(f"`{fp}`") == F.col(key), "left")
    return out.withColumn("class_id", F.when(F.col(known), F.col(own)).otherwise(F.col(f"`{id_column}`"))).drop(key, own, known)


def near_classes(df: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = NEAR) -> DataFrame:
    """``id_column``, ``fingerprint``, ``class_id``: texts joined by chains of fingerprints alike by ``threshold``.

    The class id is the smallest id.  Verified are the fingerprints, not the texts.
    """
    docs = stored(with_fingerprint(df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text")),
                                   "fp", "text").drop("text"), "edit-prints", tidy=True)
    return with_class(docs, "fp", "id", threshold).select(
        F.col("id").alias(id_column), F.col("fp").alias("fingerprint"), "class_id")


def _compare(doc_id: int | None, text: str, fp: str, start: Walk, following: str, next_fp: str) -> dict:
    """A document against its edited text, whose last third is the beginning of the next one, and against the next one."""
    n = len(text)
    kept, tail = text[:n - n // 3], following[:n // 3]
    level = level_of(len(kept) + len(tail))
    walk = start.copy() if start.level == level else Walk(level).feed(kept)
    edited = walk.feed(tail).fingerprint()
    digest = hashlib.sha256((kept + tail).encode()).hexdigest()
    return dict(zip(_OUT.names, [doc_id, n, digest, fp, edited, likeness(fp, edited), likeness(fp, next_fp)]))


def _begin(text: str) -> tuple[Walk, str]:
    """The walk over the first two thirds of a text, and the fingerprint of the whole."""
    n = len(text)
    start = Walk(level_of(n)).feed(text[:n - n // 3])
    return start, start.copy().feed(text[n - n // 3:]).fingerprint()


def compare_with_next(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, and its likeness to the document's edited text and to the next document.

    The next document has the next smaller id; after the last comes the first.  The edited text has, in
    place of its last third, as many characters from the beginning of the next one (or all it has).  Null
    ids come last; rows with equal ids are ordered by text.  Null texts are empty.  A lone row follows itself.
    An empty table gives an empty result.

    Texts are shuffled once, by ranges of the id, and compared as they stream by in order.  A range's last
    document waits for the first one of the next range: two texts for each range are paired afterwards.
    """
    spark = df.sparkSession
    python_ready(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "n": F.monotonically_increasing_id()})
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").asc(), F.col("n").asc()]
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranges = ranges.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("part"))

    schema = pa.schema([*_OUT, ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])
    sql = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
           " near_edited double, near_next double, part int, first string, last string")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for doc_id, t, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                start, fp = _begin(t)
                if held:
                    out.append(_compare(*held, t, fp))
                else:
                    out.append({"part": part, "first": t})
                held = (doc_id, t, fp, start)
            yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([{"doc_id": held[0], "part": part, "last": held[1]}], schema)

    done = stored(ranges.mapInArrow(stream, sql), "compared", tidy=True)
    firsts = done.filter("first is not null").select("part", F.col("first").alias("following"))
    used = sorted(r["part"] for r in firsts.select("part").collect())  # a number for each range
    follows = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "part int, after int")
    waiting = done.filter("last is not null").select("doc_id", "part", F.col("last").alias("text")).join(follows, "part")
    pairs = waiting.join(firsts.withColumnRenamed("part", "after"), "after").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            yield pa.RecordBatch.from_pylist([_compare(d, t, *reversed(_begin(t)), f, fingerprint(f)) for d, t, f in rows], _OUT)

    columns = _OUT.names
    ends = pairs.mapInArrow(finish, sql.split(", part")[0])
    return done.filter("n_chars is not null").select(*columns).union(ends.select(*columns)).withColumnRenamed("doc_id", id_column)
