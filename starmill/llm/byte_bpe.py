"""Byte-level BPE in DataFrame expressions: ranked merges folded over the bytes of words.

A text is cut into words by the vocabulary's pattern.  A word is an array of byte ids; each step of the
fold merges the first pair of lowest rank, until no pair has a rank.  Ranks of pairs are a literal map
in the plan, hashed into small maps so that a look-up takes constant time.  The most frequent words of the
corpus, but no long ones, are folded so, once, and go to the tasks with their function, as a table of bounded size.
Arrow batches of words look their distinct words up in it.  Those that it lacks leave holes in the ids of their
texts; the same fold, once for each distinct word of a batch, fills them.  Decoding looks up the bytes of each id
and concatenates them.

The words are no literal, since Spark keeps a plan's text with all values of its literals, several times, on the driver.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import all_columns, claim_memory, drop, extended, python_ready, stored

# Words in the table, about: nineteen of twenty occurrences in the check's tables.
HEAD_WORDS = 200_000
HEAD_BYTES = 64  # of a word in the table, at most; its ids are no more, so the table's size is bounded
LONG_BYTES = 64  # of a word whose next pair is looked for among all, at most; those of longer ones are kept in a heap
_NONE = 2**31 - 1
_HOLE = -1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _literal(rows: str, kind: str) -> Column:
    """A constant of a nested type, from JSON; the optimizer folds it once, when the query is planned."""
    return F.from_json(F.lit(rows), kind)


def _grouped(items: Iterator[tuple[int, str]], groups: int, brackets: str) -> str:
    """JSON of a list with the items of each group between brackets; items are text from the start, which takes least memory."""
    table = [""] * groups
    for group, item in items:
        table[group] = f"{table[group]},{item}" if table[group] else item
    return "[" + ",".join(f"{brackets[0]}{t}{brackets[1]}" for t in table) + "]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the first pair of lowest rank is merged until no pair has a rank."""
    if len(word) > LONG_BYTES:
        return _merged_long(word, ranks)
    cuts = list(range(len(word) + 1))
    pairs = [ranks.get(word[i:i + 2], _NONE) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) != _NONE:
        at = pairs.index(best)
        del cuts[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(word[cuts[at]:cuts[at + 2]], _NONE)
        if at:
            pairs[at - 1] = ranks.get(word[cuts[at - 1]:cuts[at + 1]], _NONE)
    return [ranks[word[a:z]] for a, z in zip(cuts, cuts[1:])]


def _merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same from a heap of pairs, by rank and place; one that is no longer there is passed over."""
    n = len(word)
    ends, before, begins = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        rank, at = heappop(heap)
        middle = ends[at]
        if not begins[at] or middle == n or ranks.get(word[at:ends[middle]]) != rank:
            continue
        begins[middle], ends[at] = 0, ends[middle]
        end = ends[at]
        if end < n:
            before[end] = at
            if (rank := ranks.get(word[at:ends[end]])) is not None:
                heappush(heap, (rank, at))
        if at and (rank := ranks.get(word[before[at]:end])) is not None:
            heappush(heap, (rank, before[at]))
    return [ranks[word[i:ends[i]]] for i in range(n) if begins[i]]


def looked_up(words: pa.ListArray, table: pa.Table) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids of each row's words, with a hole for each word that ``table`` (``word``, ``ids``) lacks, and these words, in order."""
    flat, rows = words.flatten(), words.offsets.to_numpy() - words.offsets[0].as_py()
    distinct = flat.dictionary_encode()
    head, known = table["word"].combine_chunks(), table["ids"].combine_chunks()
    values = np.append(known.flatten().to_numpy(zero_copy_only=False), np.int32(_HOLE))
    starts = np.append(known.offsets.to_numpy() - known.offsets[0].as_py(), np.int32(len(values)))  # the last one is the hole
    at = pc.index_in(distinct.dictionary, value_set=head).fill_null(len(head)).to_numpy()[distinct.indices.to_numpy()]
    ends = np.cumsum(counts := np.diff(starts)[at], dtype=np.int64)
    ids = values[np.repeat(starts[at] - (ends - counts), counts) + np.arange(counts.sum())]
    holes = at == len(head)

    def listed(of_word: np.ndarray, items: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.append(0, of_word)[rows], pa.int32()), items)

    return listed(ends, pa.array(ids, pa.int32())), listed(np.cumsum(holes), flat.filter(pa.array(holes)))


def filled(ids: pa.ListArray, missing: pa.ListArray, ranks: dict[bytes, int]) -> pa.ListArray:
    """``ids`` with each hole replaced by the ids of its word; ``missing`` has a row's words of the holes, in order."""
    flat, starts = ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    words = missing.flatten().dictionary_encode()
    folds = [merged(w.encode(), ranks) for w in words.dictionary.to_pylist()]
    of = words.indices.to_numpy()
    sizes = np.fromiter(map(len, folds), np.int64, len(folds))
    values = np.fromiter((i for f in folds for i in f), np.int32, int(sizes.sum()))
    places, counts = np.cumsum(sizes) - sizes, sizes[of]
    times = np.ones(len(flat), np.int64)
    times[flat == _HOLE] = counts
    out = np.repeat(flat, times)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    out[out == _HOLE] = values[np.repeat(places[of], counts) + inside]
    bounds = np.concatenate([[0], np.cumsum(times)])[starts - starts[0]]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(out, pa.int32()))


class Vocabulary:
    """Expressions for one rank file; ``pattern`` cuts texts into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = f"(?U){pattern}"  # classes as Unicode has them
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        self.buckets = 1 << max(1, len(pairs).bit_length())
        keyed = [(a * self.size + b, rank) for a, b, rank in pairs]
        del pairs
        keys = _grouped(((key % self.buckets, str(key)) for key, _ in keyed), self.buckets, "[]")
        values = _grouped(((key % self.buckets, str(rank)) for key, rank in keyed), self.buckets, "[]")
        # JSON has no maps with numbers as keys: a map is its keys and its values.
        self._tables = F.struct(
            _literal(keys, "array<array<bigint>>").alias("keys"), _literal(values, "array<array<int>>").alias("ranks"),
            _literal(json.dumps([ranks[bytes([b])] for b in range(256)]), "array<int>").alias("bytes"))
        pieces = {rank: token.hex() for token, rank in ranks.items()}
        self._hex = _literal(json.dumps([pieces.get(i) for i in range(self.size)]), "array<string>")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def _rank(self, tables: Column, a: Column, b: Column) -> Column:
        """Rank of the merged pair, or _NONE."""
        key = a.cast("long") * self.size + b
        bucket = (key % self.buckets).cast("int")
        at = F.array_position(F.get(tables["keys"], bucket), key).cast("int")
        return F.coalesce(F.get(F.get(tables["ranks"], bucket), at - 1), F.lit(_NONE))

    def fold(self, word: Column) -> Column:
        """Ids of one word, as an array."""
        return _let(self._tables, lambda tables: self._fold(tables, word))

    def _bytes(self, tables: Column, word: Column) -> Column:
        letters = F.split(F.decode(F.encode(word, "utf-8"), "ISO-8859-1"), "")
        return F.transform(letters, lambda c: F.get(tables["bytes"], F.ascii(c)))

    def _fold(self, tables: Column, word: Column) -> Column:
        n, none = F.octet_length(word), F.expr("array()").cast("array<int>")
        first = self._bytes(tables, word)

        def start(ids: Column) -> Column:
            ranks = F.transform(F.slice(ids, 2, n), lambda b, i: self._rank(tables, F.get(ids, i), b))
            return F.struct(ids.alias("ids"), ranks.alias("ranks"))

        def merge(state: Column, best: Column, at: Column) -> Column:
            """Merge the pair at place ``at`` (from 1): the merged token's id is its rank."""
            ids, ranks = state["ids"], state["ranks"]
            left = F.when(at > 1, F.array(self._rank(tables, F.get(ids, at - 2), best))).otherwise(none)
            right = F.when(at < F.size(ranks), F.array(self._rank(tables, best, F.get(ids, at + 1)))).otherwise(none)
            return F.struct(
                F.concat(F.slice(ids, 1, at - 1), F.array(best), F.slice(ids, at + 2, F.size(ids))).alias("ids"),
                F.concat(F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))), left, right,
                         F.slice(ranks, at + 2, F.size(ids))).alias("ranks"))

        def step(state: Column, _: Column) -> Column:
            return _let(F.array_min(state["ranks"]), lambda best: F.when(
                best.isNull() | (best == _NONE), state).otherwise(
                _let(F.array_position(state["ranks"], best).cast("int"), lambda at: merge(state, best, at))))

        folded = _let(first, lambda ids: F.aggregate(F.sequence(F.lit(1), n), start(ids), step, lambda s: s["ids"]))
        return F.when(n == 1, first).otherwise(folded)

    def text_of(self, ids: Column) -> Column:
        """Bytes of an array of ids."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self._hex, i)), ""))

    def counts(self, df: DataFrame, text: Column) -> DataFrame:
        """``word``, ``count``: the distinct words of all texts, stored."""
        return stored(df.select(F.explode(self.words(text)).alias("word")).groupBy("word").count(), "words")

    def folded(self, words: DataFrame, name: str) -> DataFrame:
        """``word``, ``ids`` of distinct words, stored."""
        return stored(words.select("word").repartition("word").select("word", self.fold(F.col("word")).alias("ids")), name)

    def encode(self, df: DataFrame, text: str, folded: DataFrame, keep_text: bool = True) -> DataFrame:
        """``df`` with ``ids`` of the whole texts; words that ``folded`` (bounded, it goes to all tasks) lacks are folded in Arrow batches."""
        python_ready(df.sparkSession)
        kept = df if keep_text else df.drop(text)
        ranks, table, plain = self.ranks, folded.select("word", "ids").toArrow(), [f"c{i}" for i in range(len(kept.columns))]
        parts = df.select(*all_columns(kept), self.words(F.col(f"`{text}`"))).toDF(*plain, "words")

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            claim_memory(merged)
            for batch in batches:
                *columns, words = batch.columns
                yield pa.RecordBatch.from_arrays([*columns, filled(*looked_up(words, table), ranks)], names=[*plain, "ids"])

        schema = extended(kept.toDF(*plain).schema, ids="array<int>")
        return parts.mapInArrow(fill, schema).toDF(*kept.columns, "ids")


def frequent(counts: DataFrame, size: int) -> DataFrame:
    """``word`` of about ``size`` most frequent rows of ``counts`` (``word``, ``count``), or of all if there are fewer.

    Two aggregations find the count from which on words fit, to a 64th; of those just below it as many as still fit
    are taken by their hash.  No task sees more than its own rows.
    """
    def at_least(limits: list[int]) -> list[int]:
        return list(counts.agg(*[F.count_if(F.col("count") >= n) for n in limits]).first())

    def cut(limits: list[int]) -> tuple[int, int, int, int]:
        """The last limit that too many words reach, how many do, the next one, and how many reach that."""
        found = at_least(limits)
        at = max(i for i, n in enumerate(found) if n > size)
        return limits[at], found[at], limits[at + 1], found[at + 1]

    if at_least([1])[0] <= size:
        return counts.select("word")
    low, _, high, _ = cut([1 << k for k in range(63)])
    low, more, high, fit = cut(sorted({low + (high - low) * i // 64 for i in range(65)}))
    places = 1 << 30
    room = F.pmod(F.xxhash64("word"), F.lit(places)) < places * (size - fit) // (more - fit)
    return counts.filter((F.col("count") >= high) | ((F.col("count") >= low) & room)).select("word")


def encoded(df: DataFrame, vocabulary: Vocabulary, text: str = "text", head_words: int = HEAD_WORDS,
            keep_text: bool = True) -> DataFrame:
    """All columns of ``df`` (but the text, if it isn't to be kept) and ``ids`` (array of int), the ids of the whole text; a
    column so named is replaced.

    The distinct words of all texts are counted; the most frequent ones of at most HEAD_BYTES are folded once and come back to the
    texts as a table.  Texts are not shuffled: the remaining words are folded in the Arrow batches of their texts.

    A null or empty text has no ids.  Every match of the pattern is encoded by itself, without special
    tokens, however long it is.  Repeated rows each get their ids.  An empty table gives an empty result.
    """
    value = F.col(f"`{text}`")
    counts = df.select(F.explode(vocabulary.words(value)).alias("word")).groupBy("word").count()
    counts = stored(counts.filter(F.octet_length("word") <= HEAD_BYTES), "word-counts", tidy=True)
    folded = vocabulary.folded(frequent(counts, head_words), "frequent")
    drop(counts)
    return vocabulary.encode(df.drop("ids"), text, folded, keep_text)
