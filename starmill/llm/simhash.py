"""SimHash fingerprints of word shingles, linked at a small Hamming distance by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, all_columns, claim_memory, drop, fresh, stored

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority of the hash bits of all shingles, repeats included; 0 without words.

    Only A-Z is lower-cased; words are separated by blanks and the controls 9 to 13, which is
    what ``bytes`` methods do.  A text with fewer words is one shingle.
    """
    seq = text.lower().split()
    if not seq:
        return 0
    if len(seq) < words:
        shingles = [b" ".join(seq)]
    else:
        shingles = map(b" ".join, zip(*(seq[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, HASH_SEED) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        block = np.unpackbits(hashes[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += block.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def with_fingerprint(df: DataFrame, name: str, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of ``df`` and the fingerprint (signed long).  A null text has no words."""
    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        claim_memory(fingerprint)
        values = [fingerprint(t.encode(), words) if t else 0 for t in texts]
        return {name: pa.array(np.array(values, np.uint64).view(np.int64))}

    return add_columns(df, {name: "long"}, add, text)


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(0xFFFFFFFF))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints within ``max_bits`` (at most 3); ``prints`` has each once, as ``fp``.

    With two segments of 32 bits, one of them differs in at most one bit.  So each fingerprint looks
    up, in each segment's table, its own segment and those with one more bit set: of two segments one
    bit apart, exactly one finds the other.  The complete distance is verified in the join.  The second
    table leaves out pairs the first one finds.  A segment that many fingerprints share is one key;
    an adaptive join splits it.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius 1 cover distances up to 3")
    half = F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned("fp", 32).alias("own")),
        F.struct(F.lit(1).alias("seg"), _low(F.col("fp")).alias("own"))))
    table = prints.select("fp", half.alias("h")).select("fp", "h.seg", "h.own")
    flips = F.expr("filter(transform(sequence(0, 31), i -> own | shiftleft(1L, i)), k -> k <> own)")
    probe = table.select(F.col("fp").alias("q"), "seg", F.explode(F.concat(F.array("own"), flips)).alias("key"), "own")
    table = table.withColumnRenamed("own", "key")
    apart = F.bit_count(F.col("q").bitwiseXOR(F.col("fp")))
    first = F.bit_count(F.shiftrightunsigned(F.col("q").bitwiseXOR(F.col("fp")), 32))
    found = probe.join(table, (probe.seg == table.seg) & (probe.key == table.key) & (apart <= max_bits)
                       & ((probe.own != probe.key) | (F.col("q") < F.col("fp")))  # equal segments: each pair once
                       & ((probe.seg == 0) | (first > 1)))
    return found.select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b"))


def _is_star(edges: DataFrame) -> bool:
    """Whether every node is either a centre or hangs on one centre."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.max("e.up").alias("up"), F.sum("e.down").alias("down"))
    return nodes.filter("down > 1 or (down > 0 and up > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (the smallest node reachable) for the nodes of undirected ``edges`` (``a`` < ``b``).

    Alternates two steps until only stars are left: every node hands its larger neighbours to the
    smallest one it sees, then its smaller ones.  Both keep the components and add no edges.  Minima are
    aggregated before the shuffle and no neighbour list is collected, so a hub costs one row per edge.
    """
    edges = stored(edges.distinct(), "edges")
    while not _is_star(edges):
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = stored(large.distinct(), "large")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        small = stored(small.distinct(), "small")
        drop(edges), drop(large)
        edges = small
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(edges.select("a", "a").distinct())


def print_labels(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp``, ``label`` for fingerprints that have a link; ``prints`` has each fingerprint once."""
    return components(links(prints, max_bits)).toDF("fp", "label")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``id_column``, ``fp`` and ``component_id``, the smallest id reachable over links; one row per row of ``df``.

    Equal fingerprints are folded first, so copies cost nothing beyond their own row.  Empty texts
    (and nulls) have fingerprint 0 and link like others.  A null id never is the smallest; a component
    of null ids only has a null id.  Repeated rows stay.  An empty table gives an empty result.
    """
    fp = fresh(df.select(id_column), "fp")
    docs = stored(with_fingerprint(df.select(id_column, text), fp, text, words).drop(text), "prints")
    prints = stored(docs.groupBy(F.col(fp).alias("fp")).agg(F.min(id_column).alias("first")), "distinct")
    labels = print_labels(prints.select("fp"), max_bits)
    own = prints.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = own.groupBy("label").agg(F.min("first").alias("component_id"))
    of_print = own.join(least, "label").select(F.col("fp").alias(fp), "component_id")
    return docs.join(of_print, fp)


def first_of_each(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest id of each component, whole; of rows with equal ids and fingerprints, one.

    Texts move once, one row for each task and fingerprint.
    """
    fp, n = fresh(df, "fp"), fresh(df, "_n")
    order = [F.col(id_column).asc_nulls_last(), F.xxhash64(*all_columns(df))]
    marked = stored(with_fingerprint(df, fp, text, words), "marked")
    prints = stored(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(id_column).alias("first")), "distinct")
    labels = print_labels(prints.select("fp"), max_bits)
    own = prints.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    best = Window.partitionBy("label").orderBy(F.col("first").asc_nulls_last(), "fp")
    keep = own.withColumn(n, F.row_number().over(best)).filter(F.col(n) == 1).select(F.col("fp").alias(fp))
    kept = marked.join(keep, fp, "left_semi")
    one = kept.withColumn(n, F.row_number().over(Window.partitionBy(fp).orderBy(*order))).filter(F.col(n) == 1)
    return one.select(*all_columns(df))
