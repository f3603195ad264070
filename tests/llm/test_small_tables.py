"""Each operator against brute force on small tables: nulls, empty and very long texts, ties, repeated rows,
empty tables, and extra columns whose names clash with the operator's own."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starmill.llm import (byte_bpe, chat_tree, common, edit_fingerprint, exact_dedup, language, packing, sharding, simhash,
                          token_files, toxicity, words)
from starmill.llm.oracle import ORACLE

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BLANKS = re.compile("[\x20\x09-\x0d]+")

ODD = [
    None, "", " ", "\n", "\t\n  x", "  two  blanks ", "a", "A", "1", "²½", "naïve Straße ÉCOLE", "Καλημέρα κόσμε Σ", "漢字 仮名", "école",
    "it's we'll 'quoted'", "<|endoftext|> <|startoftext|>", "nul\x00 and \x1c sep", "a b c", "line\r\nend\n\n\nthree", "🙂🙂 emoji",
    "same words here again", "same  words\there\nagain", "SAME WORDS HERE AGAIN", "x" * 5000, "word " * 3000, "ab" * 3000, "no-break" + "-" * 300,
]
EXTRA = ("size int, shard string, slot int, score string, ids string, fp int, recipe int, _recipe int, start int, piece string,"
         " length string, sequence_id int, `a.b` int, lang_pred int, _score int, _n int, kept string")


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, some twice, ids that are missing or repeat, and columns named like those the operators make."""
    rng = random.Random(3)
    plain = [" ".join(rng.choice(["the", "of", "erth", "onde", "in", "ha"]) for _ in range(rng.randint(1, 400))) for _ in range(60)]
    texts = ODD + plain + plain[:5] + [None, ""]
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (40, "other text"), (None, plain[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in EXTRA.split(","):
        name, kind = c.strip().rsplit(" ", 1)
        df = df.withColumn(name.strip("`"), F.lit("7").cast(kind))
    return df.repartition(5)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture
def none(docs):
    return docs.filter("false")


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def packed_ids(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def sort(rows):
    return sorted(rows, key=repr)


def test_shards(spark, docs, none):
    shards = lambda df: sharding.byte_shards(
        df.select("doc_id", "text", "slot", "shard"), [F.col("doc_id").asc_nulls_first()], sharding.byte_size(F.col("text")), 7)
    found = sorted(shards(docs).collect(), key=lambda r: (r["shard"], r["slot"]))
    assert len(found) == docs.count() and shards(none).count() == 0
    total, before = sum(r["size"] for r in found), 0
    last = (-1, -1)
    for r in found:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        assert r["shard"] == (2 * before + r["size"]) * 7 // (2 * total)
        assert r["slot"] == (last[1] + 1 if r["shard"] == last[0] else 0)
        before, last = before + r["size"], (r["shard"], r["slot"])
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)


def test_one_key_for_all_rows_spreads(spark):
    """Rows that are equal in every column still fill all shards alike."""
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    sizes = sharding.byte_shards(df, [F.col("doc_id").asc()], sharding.byte_size(F.col("text")), 8).groupBy("shard").count().collect()
    assert [r["count"] for r in sizes] == [500] * 8


def test_chunks_are_what_the_library_says():
    rng = random.Random(5)
    parts = [t for t in ODD if t] + [" ", "\n", "  ", "\t", "'", ".", "É", "ſ", "K", "a"]
    for path, lower in ((BYTE_BPE, False), (WORD_BPE, True)):
        ids = words.ChunkIds(path, lower, max_chunks=50)  # forgets all the time
        for text in [*parts, *("".join(rng.choice(parts)[:40] for _ in range(rng.randint(1, 5))) for _ in range(1500))]:
            assert ids.ids(text) == ids.encode(text), repr(text)


def test_pieces_and_packing(spark, docs, rows, none):
    library = Tokenizer.from_file(BYTE_BPE)
    library.encode_special_tokens = True
    pieces = packing.pieces(docs, BYTE_BPE)
    assert {"shard", "a.b"} <= set(pieces.columns) and packing.pack(packing.pieces(none, BYTE_BPE)).count() == 0
    found = packing.pack(pieces.select("doc_id", "piece", "start", "length", "ids"), pieces_per_task=40)
    want = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want += [(doc_id, k, a, z - a, packed_ids(ids[a:z])) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    got = found.collect()
    assert sort((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got) == sort(want)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    used, bound = packing.certificate(found)
    assert used == len(by_sequence) and bound <= used <= bound * 1.05 + 1
    texts = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(found).collect()}
    assert sum(map(len, texts.values())) == 4 * sum(w[3] for w in want) and len(texts) == used


def test_bound_and_best_fit():
    assert packing.lower_bound(np.array([600] * 10 + [500] * 3), 1024) == 12  # the plain sum says 8
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 1025, 500)
        bins, offsets, fills = packing.best_fit(lengths, 1024)
        assert packing.lower_bound(lengths, 1024) <= len(fills) and fills.max() <= 1024
        assert np.array_equal(np.bincount(bins, lengths), fills)
        for b in range(len(fills)):
            at = np.argsort(offsets[bins == b])
            assert np.array_equal(offsets[bins == b][at], np.cumsum(lengths[bins == b][at]) - lengths[bins == b][at])


def test_rounds_bring_gaps_together(spark):
    """Many small partitions: what is left over in each is packed together."""
    lengths = np.random.default_rng(1).integers(50, 900, 900)
    found = packing.pack(spark.createDataFrame([(int(n),) for n in lengths], "length long"), pieces_per_task=50)
    used, bound = packing.certificate(found)
    alone = sum(len(packing.best_fit(lengths[a:a + 50], 1024)[2]) for a in range(0, 900, 50))
    at_once = len(packing.best_fit(lengths, 1024)[2])
    assert found.count() == 900 and bound <= at_once <= used < alone


def test_small_inputs_are_certified_too(spark, monkeypatch):
    """A few hundred pieces are dealt over several lanes, each with its bound; a single lane tells whether it met it."""
    seen, deal = [], packing._round
    monkeypatch.setattr(packing, "_round", lambda df, parts, *rest: seen.append(parts) or deal(df, parts, *rest))
    rng = np.random.default_rng(3)
    monkeypatch.setattr(packing, "_lanes", lambda spark, n, most: max(1, n // 128))  # whatever the session's cores
    for lengths, exact in ((rng.integers(50, 900, 500), None), (np.array([512] * 40), True), (np.array([400, 400, 400]), True)):
        seen.clear()
        got = packing.pack(spark.createDataFrame([(int(n), 1) for n in lengths], "length long, certified int")).collect()
        assert len(got) == len(lengths) and seen[0] == max(1, len(lengths) // 128)
        used, bound = len({r["sequence_id"] for r in got}), packing.lower_bound(lengths, 1024)
        assert bound <= used <= len(packing.best_fit(lengths, 1024)[2]) * 1.02 + 1
        if seen == [1]:
            assert {r["lane_bound"] for r in got} == {bound} and {r["certified"] for r in got} == {used == bound} == {exact}


def test_no_round_exceeds_a_tasks_pieces(spark, monkeypatch):
    """Lengths that no lane packs to its bound: the pool hardly shrinks, and the lanes stay bounded."""
    lengths, seen, deal = np.random.default_rng(2).integers(300, 500, 3200), [], packing._round

    def watched(df, parts, *rest):
        out = deal(df, parts, *rest)
        seen.append((df.count(), max(r["count"] for r in out.groupBy("lane").count().collect())))
        return out

    monkeypatch.setattr(packing, "_round", watched)
    found = packing.pack(spark.createDataFrame([(int(n),) for n in lengths], "length long"), pieces_per_task=200)
    assert len(seen) > 1 and seen[1][0] > 2000  # most pieces are exchanged
    assert max(most for _, most in seen) <= 240
    fills = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k"), F.countDistinct("offset").alias("o"))
    assert found.count() == 3200 and fills.filter("n > 1024 or k <> o").isEmpty()


def test_long_words_stay_out_of_the_literal_map(spark, monkeypatch):
    vocabulary = byte_bpe.Vocabulary(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    taken, folded = [], vocabulary.folded
    monkeypatch.setattr(vocabulary, "folded", lambda words, name: taken.extend(r["word"] for r in words.collect()) or folded(words, name))
    texts = ["漢字仮名" * 40, "é" * 33, "a" * 64, "short words"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 5)], "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encoded(df, vocabulary).collect()}
    assert max(len(w.encode()) for w in taken) == byte_bpe.HEAD_BYTES == 64
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    assert all(got[i] == library.encode_ordinary(t) for i, t in enumerate(texts * 5))


def test_token_files(spark, docs, rows, none, tmp_path):
    library = Tokenizer.from_file(WORD_BPE)
    library.encode_special_tokens = True
    folder = common.new_folder(spark, "files")
    token_files.write(docs, folder, WORD_BPE, block_ids=500, parts=4)
    found = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    want = [(i, packed_ids([*library.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows]
    assert sort((r["doc_id"], bytes(r["ids"])) for r in found) == sort(want)
    at = 0
    for r in found:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)
    empty = common.new_folder(spark, "files")
    token_files.write(none, empty, WORD_BPE)
    assert token_files.read(spark, empty).count() == 0


def test_planes():
    for ids in ([0], [1, 2, 3], [2**32 - 1, 0, 7], list(range(70000, 70500))):
        assert token_files.from_planes(token_files.to_planes(np.array(ids, "<u4")), len(ids)).tolist() == ids
    assert len(token_files.to_planes(np.array([5, 49000], "<u4"))) == 2


def slow_fingerprint(text: str) -> int:
    seq = [w for w in BLANKS.split(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    shingles = [" ".join(seq[i:i + 3]) for i in range(len(seq) - 2)] if len(seq) >= 3 else [" ".join(seq)] * bool(seq)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs, rows, none):
    found = simhash.near_duplicates(docs).collect()
    prints = {t: slow_fingerprint(t or "") for _, t in rows}
    reach = {p: {p} for p in prints.values()}
    for a in list(reach):
        for b in list(reach):
            if (a ^ b).bit_count() <= 3 and reach[a] is not reach[b]:
                reach[a] |= reach[b]
                for p in reach[b]:
                    reach[p] = reach[a]
    least = {}
    for doc_id, text in rows:
        if doc_id is not None:
            key = min(reach[prints[text]])
            least[key] = min(doc_id, least.get(key, doc_id))
    want = [(i, prints[t] - (prints[t] >> 63 << 64), least.get(min(reach[prints[t]]))) for i, t in rows]
    fp = [c for c in simhash.near_duplicates(docs).columns if c.endswith("fp")][0]
    assert sort((r["doc_id"], r[fp], r["component_id"]) for r in found) == sort(want)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({min(s) for s in reach.values()})
    assert simhash.first_of_each(none).count() == 0


def test_all_links_and_long_chains(spark):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(300)}
    for v in list(values)[:100]:
        for _ in range(4):  # chains of small steps
            for b in rng.sample(range(64), rng.randint(1, 3)):
                v ^= 1 << b
            values.add(v)
    values |= {1 << b for b in range(64)} | {0}  # a dense group
    signed = [v - (v >> 63 << 64) for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    pairs = {(min(a, b), max(a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {(r["a"], r["b"]) for r in found} == pairs
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    labels = {r["node"]: r["label"] for r in simhash.components(chain).collect()}
    assert labels == {i: 0 for i in range(201)} | {500: 500, 501: 500}


@pytest.mark.parametrize("id_bytes", [1, 16])
def test_exact(spark, docs, rows, none, id_bytes):
    """One byte per identifier makes different chunks collide: their bytes decide."""
    found = exact_dedup.exact_duplicates(docs, id_bytes=id_bytes).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(BLANKS.sub(" ", text or ""), []).append(doc_id)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert sort((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == sort(want)
    assert sum(r["kept"] for r in found) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    assert exact_dedup.exact_duplicates(none).count() == 0
    kept = exact_dedup.first_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_chunks_follow_the_content():
    rng = random.Random(4)
    data = bytes(rng.randrange(256) for _ in range(60_000))
    for text in (b"", b"a", data, b"a" * 40_000, data[:300]):
        cuts = exact_dedup.cut(text)
        assert b"".join(cuts) == text and max(map(len, cuts)) <= exact_dedup.MAX_CHUNK
    moved = exact_dedup.cut(b"some words before" + data)
    assert len(set(exact_dedup.cut(data)) & set(moved)) > len(moved) * 0.8


def test_byte_bpe(spark, docs, rows, none):
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    vocabulary = byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    got = byte_bpe.encoded(docs, vocabulary, head_words=5)
    got = got.withColumn("bytes", vocabulary.text_of(F.col("ids"))).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["ids"] == library.encode_ordinary(r["text"] or ""), repr(r["text"])
        assert bytes(r["bytes"]) == (r["text"] or "").encode()
    assert byte_bpe.encoded(none, vocabulary, head_words=5).count() == 0


def test_byte_bpe_of_long_words(spark):
    """Words of up to 100,000 letters, also where a merge makes a pair of a lower rank."""
    rng, letters = random.Random(1), "abcdefghijklmnopqrstuvwxyz"
    pieces = [*letters, "é", "ß", "漢", "字", "the", "er", "ation", "x"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(65, 300))) for _ in range(300)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(60, 200))) for _ in range(100)]
    texts += ["".join(rng.choice("aab") for _ in range(rng.randint(65, 300))) for _ in range(100)]
    texts += ["=*" * 90, "ab" * 3000, "x" * 100_000, "".join(rng.choice(letters) for _ in range(100_000))]
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("long", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = byte_bpe.encoded(df, byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)).select("doc_id", "ids").collect()
    assert [r["doc_id"] for r in got if r["ids"] != library.encode_ordinary(texts[r["doc_id"]])] == []


def test_byte_bpe_where_a_merge_makes_a_lower_pair(spark):
    """A made-up vocabulary in which single merges and merges of a whole rank differ."""
    tokens = [bytes([b]) for b in range(256)] + [b"bab", b"cab", b"aba", b"ab", b"ba", b"abab", b"bb", b"ca"]
    ranks = {t: i for i, t in enumerate(tokens)}
    rng, vocabulary = random.Random(2), byte_bpe.Vocabulary(ranks, r"\p{L}+")

    def slow(word: bytes) -> list[int]:
        parts = [bytes([b]) for b in word]
        while True:
            best, at = min(((ranks.get(a + b, 999), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(999, 0))
            if best == 999:
                return [ranks[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 150))) for _ in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "text string")
    for r in byte_bpe.encoded(df, vocabulary, head_words=3).collect():
        assert r["ids"] == slow(r["text"].encode()), r["text"]


def test_words_that_the_map_lacks_fill_the_holes_of_their_texts(spark):
    ranks, rng = byte_bpe.read_ranks(RANKS), random.Random(5)
    library = tiktoken.Encoding("holes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choice("aeinrst äß漢") for _ in range(rng.randint(1, n))).encode() for n in (3, 12, 64, 65, 400) for _ in range(60)]
    for word in words:
        want = library._core_bpe.encode_single_piece(word)
        assert byte_bpe.merged(word, ranks) == want == byte_bpe._merged_long(word, ranks)
    fold = {w: byte_bpe.merged(w.encode(), ranks) for w in ("zxqv", "xx", "qqqzzq")}
    ids, missing = [[], [-1], [7, -1, -1], [1, 2], [-1, 9]], [[], ["zxqv"], ["xx", "zxqv"], [], ["qqqzzq"]]
    want = [[], fold["zxqv"], [7, *fold["xx"], *fold["zxqv"]], [1, 2], [*fold["qqqzzq"], 9]]
    made = pa.array(ids, pa.list_(pa.int32())), pa.array(missing, pa.list_(pa.string()))
    assert byte_bpe.filled(*made, ranks).to_pylist() == want
    assert byte_bpe.filled(*(m.slice(2, 2) for m in made), ranks).to_pylist() == want[2:4]
    assert byte_bpe.filled(*(m.slice(0, 1) for m in made), ranks).to_pylist() == [[]]
    df = spark.createDataFrame([(1, "a rare zxqvkw"), (2, None), (3, "")], "doc_id long, text string")
    got = byte_bpe.encoded(df, byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN), head_words=1, keep_text=False)
    assert got.columns == ["doc_id", "ids"] and "aggregate(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == {1: library.encode_ordinary("a rare zxqvkw"), 2: [], 3: []}


def test_plans_hold_no_frequent_words(spark):
    """Spark keeps the text of a plan on the driver, with the values of its literals, for as long as the session lasts."""
    ranks, rng = byte_bpe.read_ranks(RANKS), random.Random(7)
    library = tiktoken.Encoding("plan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choice("bcdfgkqxzé漢") for _ in range(12)) for _ in range(2000)]
    df = spark.createDataFrame([(i, " ".join(words[i::20] + words[:i])) for i in range(20)], "doc_id long, text string")
    got = byte_bpe.encoded(df, byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN))
    plan = got._jdf.queryExecution().toString()
    assert not any(w in plan for w in words) and len(plan) < 20_000
    assert all(r["ids"] == library.encode_ordinary(r["text"]) for r in got.collect())


def test_words_are_looked_up_in_the_table(spark):
    table = pa.table({"word": pa.array(["-", "a", "bb"]), "ids": pa.array([[9], [1], [2, 3]], pa.list_(pa.int32()))}).slice(1)
    words = pa.array([[], ["a", "x", "bb"], ["bb"], [], ["y", "y", "a"]], pa.list_(pa.string()))
    ids, missing = [[], [1, -1, 2, 3], [2, 3], [], [-1, -1, 1]], [[], ["x"], [], [], ["y", "y"]]
    for at, n in ((0, 5), (1, 2), (2, 3), (3, 1), (0, 0)):
        found = byte_bpe.looked_up(words.slice(at, n), table)
        assert [f.to_pylist() for f in found] == [ids[at:at + n], missing[at:at + n]]
    assert [f.to_pylist() for f in byte_bpe.looked_up(words.slice(1, 2), table.slice(2))] == [[[-1, -1, -1], [-1]], [["a", "x", "bb"], ["bb"]]]


def test_frequent_words(spark):
    rng = random.Random(4)
    counts = [(f"w{i}", rng.choice([1, 1, 1, 2, 2, 3, 9, 70, 71, 5000])) for i in range(5000)] + [("top", 10**9)]
    df = spark.createDataFrame(counts, "word string, count long")
    for size in (10, 600, 2500, 4900):
        taken = {r["word"] for r in byte_bpe.frequent(df, size).collect()}
        least = min(n for w, n in counts if w in taken)
        assert 0.9 * size - 9 < len(taken) < 1.1 * size + 9 and all(w in taken for w, n in counts if n > least * 65 / 64 + 1)
    assert byte_bpe.frequent(df, 5001).count() == 5001 and byte_bpe.frequent(df.limit(0), 5).count() == 0


def test_chat_tree(spark):
    rng = random.Random(6)
    said = ["hi", "### assistant: no", "</turn>\n", "\\", "\\### Assistant: </turn> ok", "", None, "é\n" * 50, "\\\\</turn>", "a:b"]
    rows = []
    for conv in [*range(60), None]:
        copy = random.Random(conv % 7 if conv is not None else 99)
        for turn in range(copy.randint(1, 6)):
            rows.append((conv, turn if turn != 3 else None, copy.choice(["user", "assistant", "sys: tem", "a\\b", None]), copy.choice(said)))
        if conv is not None and conv % 3 == 0:
            rows.append((conv, 9, "assistant", rng.choice(said)))
    rows += [(61, 0, "user", "long " * 20_000), (61, 1, "assistant", "x" * 50_000), (62, 0, "user", "twice"), (62, 0, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, conversations = chat_tree.build(df.withColumn("rank", F.lit(1)))
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    sql = ORACLE["op4_chat_tree"].replace("ORDER BY turn,", "ORDER BY turn NULLS FIRST,")
    want = [r for r in con.execute(sql).fetchall() if r[0] != -7]
    names = [d[0] for d in con.description]
    got = [tuple(r[n] for n in names) for r in chat_tree.read_back(nodes, conversations).collect()]
    assert sort(got) == sort(want)
    # The stream has every prefix once, in depth-first order, and no gaps.
    prefixes = set()
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for turns in by_conv.values():
        turns = [t[2:] for t in sorted(turns)]
        prefixes |= {tuple(turns[:k + 1]) for k in range(len(turns))}
    found = sorted(nodes.collect(), key=lambda r: r["start"])
    assert len(found) == len(prefixes)
    at, stream = 0, "".join(r["text"] for r in found)
    for r in found:
        assert r["start"] == at
        at += len(r["text"])
        before = "".join(stream[s["from"]:s["to"]] for s in r["ancestors"])
        assert len(before) == r["position"]
        assert tuple(chat_tree.parse(before + r["text"])) in prefixes
        open_at = max((s["to"] for s in r["ancestors"]), default=0)
        assert open_at <= r["start"]
    nothing = chat_tree.build(df.filter("false"))
    assert chat_tree.read_back(*nothing).count() == 0


def test_toxicity(spark):
    rng = random.Random(8)
    calm = "the weather report says that a mild wind will come over the hills and bring some rain to the valley".split()
    rude = ["idiot", "moron", "stupid"]
    rows, labels = [], []
    for i in range(700):
        text = [rng.choice(calm) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            text[rng.randrange(30):0] = rng.sample(rude, 2)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "the wind"), (1002, "you " + "1d10t and m0r0n " * 3), (1003, "x" * 30_000), (1004, "é " * 5),
             (1005, "the s t u p i d and st.up.id wind")] + rows[:3]
    labels += [(None, 1), (1, None), (2, 0), (5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("_score", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    got = toxicity.with_score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [(score[i] >= 0.5, bool(t)) for i, t in labels[:700] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([a == b for a, b in held]) > 0.98
    assert score[1002] > 0.5 and score[1005] > 0.5 and max(score[1000], score[1001], score[None]) < 0.5
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < 0.5 for r in got)
    for few in (marks.filter("false"), marks.filter("toxic = 0")):
        assert {round(r["score"], 2) for r in toxicity.with_score(docs, toxicity.fit(docs, few)).collect()} == {0.0}
    assert toxicity.with_score(docs.filter("false"), toxicity.fit(docs.filter("false"), marks)).count() == 0


def test_restored_words():
    counts = np.zeros(toxicity.SYMBOLS ** 4, np.int64)
    toxicity.count_grams(["stupid idiot moron scum loser weather valley hills a I"] * 50 + [None, ""], counts)
    reader = toxicity.Reader(toxicity.log_probabilities(counts))
    for token, word in {"1d10t": "idiot", "$tupid!!": "stupid", "m0r0n": "moron", "s.c.u.m": "scum", "l0ser,": "loser",
                        "mooooron": "moron", "STUPID": "stupid", "hills": "hills", "val-ley": "valley"}.items():
        assert reader.read(token) == (word,), token
    assert reader.read("2024") == () and reader.restored("you s t u p i d m0ron") == "you stupid moron"


def test_no_disguise_is_lost_before_the_lattice():
    counts = np.zeros(toxicity.SYMBOLS ** 4, np.int64)
    toxicity.count_grams(["stupid idiot moron scum fuck shit ass dumbass hello will valley weather a I the you"] * 50, counts)
    logp = toxicity.log_probabilities(counts)
    reader = toxicity.Reader(logp)
    for token, word in {"a$$": "ass", "sh!+": "shit", "idio+": "idiot", "!diot": "idiot", "dumba$$": "dumbass", "iiddiioott": "idiot",
                        "stuupid": "stupid", "$cum!!!!!!!!": "scum", "hello!": "hello", "(will),": "will", "“idio+”.": "idiot",
                        "@you": "you"}.items():
        assert reader.read(token) == (word,), token
    for text, word in {"f u c k!": "fuck", "(i d i o t)": "idiot", '"s c u m"': "scum", "f  u  c  k": "fuck", "m\to\tr\to\tn": "moron",
                       "s\nh\r\ni\nt": "shit", "a s s": "ass", "a $ $": "ass", "s - c - u - m": "scum"}.items():
        assert reader.runs(f"the {text} you") == [word], text
        assert reader.restored(text) == word
    assert reader.runs("you don't a I, will the a") == []
    for blanks in range(190, 205):  # a word over each place of the 200th character
        text = "." * blanks + "1d10t" + "." * 300 + "m0r0n"
        assert toxicity.decode(text, logp).split() == ["idiot", "moron"], blanks


def test_gram_counts_by_hand():
    counts = np.zeros(toxicity.SYMBOLS ** 4, np.int64)
    toxicity.count_grams(["ab", None, "B!"], counts)
    at = lambda *s: int(np.ravel_multi_index(s, (toxicity.SYMBOLS,) * 4))
    want = {at(0, 0, 0, 1): 1, at(0, 0, 1, 2): 1, at(0, 1, 2, 0): 1, at(0, 0, 0, 2): 1, at(0, 0, 2, 0): 1}
    assert {int(i): int(counts[i]) for i in np.flatnonzero(counts)} == want


def test_language(spark):
    rng = random.Random(9)
    lexicon = {"x": "the of and to in that was".split(), "y": "der die und nicht mit für ein".split(), "z": "le la et une pas dans".split()}
    rows = [(i, lang, " ".join(rng.choice(lexicon[lang]) for _ in range(12))) for i in range(300) for lang in [rng.choice("xyz")]]
    rows += [(900, "x", None), (901, None, ""), (902, "y", "123 !!"), (None, None, "the of and"), (903, None, "der " * 20_000), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("lang_pred", F.lit(1)).withColumn("_pred", F.lit(2))
    held = language.fold("doc_id", 3) == 1
    model = language.fit(docs, ~held)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None and r["doc_id"] < 900)
    other = {r["doc_id"]: r["lang_pred"] for r in got}
    assert (other[900], other[901], other[902], other[None], other[903]) == ("und", "und", "und", "x", "y")
    kept = language.without_unknown(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    none = docs.filter("false")
    blank = language.fit(none, F.lit(True))
    assert language.identify(none, blank).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, blank).collect()} == {"und"}
    one = language.fit(docs.filter("lang = 'x'"), F.lit(True))
    assert {r["lang_pred"] for r in language.identify(docs, one).collect()} == {"x", "und"}


def test_nothing_learned_drops_no_text(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, "12 34", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in corpus_pipeline.spoken(spark, df, "").collect()] == [1]


def test_codewords():
    for n in (2, 3, 4, 6, 12):
        code = language.codewords(n)
        apart = min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i])
        assert apart >= (1 if n < 4 else 4)


def test_edit_fingerprints(spark, docs, rows, none):
    got = edit_fingerprint.compare_with_next(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows) and edit_fingerprint.compare_with_next(none).count() == 0
    single = [i for i, _ in rows if i is not None and sum(j == i for j, _ in rows) == 1]
    found = {r["doc_id"]: r for r in got}
    for k, (doc_id, text) in enumerate(order[:-1]):
        after = order[k + 1]
        if doc_id not in single or after[0] not in single:
            continue
        t, following = text or "", after[1] or ""
        n = len(t)
        edited = t[:n - n // 3] + following[:n // 3]
        r = found[doc_id]
        prints = [edit_fingerprint.fingerprint(x) for x in (t, edited, following)]
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (n, *prints[:2])
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == edit_fingerprint.likeness(prints[0], prints[1])
        assert r["near_next"] == edit_fingerprint.likeness(prints[0], prints[2])
    lone = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert edit_fingerprint.compare_with_next(lone).first()["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()


def slow_walk(text: str) -> list[tuple[int, str]]:
    """(step, character) of the whole walk, by the stays."""
    dwell, steps = edit_fingerprint._dwell(), []
    for c in text:
        code = ord(c)
        stay = dwell[len(steps) % edit_fingerprint.PERIOD * 256 + ((code ^ code >> 8) & 255)]
        steps += [c] * stay
    return steps


def test_fingerprint_samples_the_walk():
    rng = random.Random(1)
    for n in (0, 1, 5, 256, 257, 3000, 70_000):
        text = "".join(rng.choice("abcdefgh é漢") for _ in range(n))
        fp, steps, level = edit_fingerprint.fingerprint(text), slow_walk(text), edit_fingerprint.level_of(n)
        assert len(fp) == 2 + -(-len(steps) // (1 << level)) and (n < 257 or 200 < len(fp) < 600)
        for b, digit in enumerate(fp[2:]):
            at = int(edit_fingerprint._finer(np.array([b]), level, 0)[0])
            assert at >> level == b
            want = "-" if at >= len(steps) else "0123456789abcdef"[int(edit_fingerprint._mix(np.array([at]), np.array([ord(steps[at])]))[0]) >> 60]
            assert digit == want
        cut = rng.randint(0, n)
        walk = edit_fingerprint.Walk(level).feed(text[:cut])
        assert walk.copy().feed(text[cut:]).fingerprint() == fp


def test_edit_distance_shows(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randint(900, 3000))) for _ in range(30)]
    near = [t[:400] + t[401:] for t in base]  # one character less
    alike = [edit_fingerprint.likeness(edit_fingerprint.fingerprint(a), edit_fingerprint.fingerprint(b)) for a, b in zip(base, near)]
    apart = [edit_fingerprint.likeness(edit_fingerprint.fingerprint(a), edit_fingerprint.fingerprint(b)) for a, b in zip(base, base[1:])]
    assert np.median(alike) > 0.9 and max(apart) < 0.35
    rows = [(i, t) for i, t in enumerate(base + near + base[:4])] + [(200, None), (201, "")]
    found = {r["doc_id"]: r["class_id"] for r in edit_fingerprint.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows) and found[200] == found[201] == 200
    assert all(found[30 + i] == found[i] == i for i in range(30) if alike[i] >= edit_fingerprint.NEAR)
    assert all(found[60 + i] == i for i in range(4))
    assert edit_fingerprint.near_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_levels_meet_near_a_limit_and_clashing_columns_stay(spark):
    """Texts alike on both sides of a level's limit share a bucket; so do pairs within a level; helper names are free to use."""
    rng = random.Random(12)
    met = []
    for n in (256, 512, 1024, 4096):
        for _ in range(12):
            t = "".join(rng.choice("abcdefghijklmnop ") for _ in range(n + rng.randint(1, n // 10)))
            cut = rng.randint(n // 10, n // 6)
            prints = [edit_fingerprint.fingerprint(x) for x in (t, t[:-cut])]
            if edit_fingerprint.likeness(*prints) >= edit_fingerprint.NEAR:
                met.append(bool(set(edit_fingerprint.band_keys(prints[0])) & set(edit_fingerprint.band_keys(prints[1]))))
    assert len(met) > 30 and np.mean(met) > 0.95
    rows = [(1, "00ab", 5), (2, "00ab", 5), (None, "00ab", 5), (3, None, 5), (4, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, fp string, _known int")
    for c in ("_fp", "_class", "class_id", "key", "node", "n", "first"):
        df = df.withColumn(c, F.lit(9))
    found = edit_fingerprint.with_class(df, "fp")
    assert sorted(found.columns) == sorted(df.columns)
    assert sorted([(r["doc_id"], r["class_id"], r["_known"], r["_fp"]) for r in found.collect()], key=repr) == sorted(
        [(1, 1, 5, 9), (2, 1, 5, 9), (None, 1, 5, 9), (3, 3, 5, 9), (4, 4, 5, 9)], key=repr)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables are not here")
def test_edit_classes_of_the_drivers_table(spark):
    """class_id is that of all pairs alike, and planted near copies (by edit distance) are found."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: edit_fingerprint.fingerprint(r["text"]) for r in rows}
    ids = sorted(prints)
    label = {i: i for i in ids}
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if edit_fingerprint.likeness(prints[a], prints[b]) >= edit_fingerprint.NEAR:
                x, y = sorted((label[a], label[b]))
                label = {i: x if c == y else c for i, c in label.items()}
    df = spark.createDataFrame(list(prints.items()), "doc_id long, fp string")
    assert {r["doc_id"]: r["class_id"] for r in edit_fingerprint.with_class(df, "fp").collect()} == label


def test_classes_keep_every_link_of_a_bucket(spark, monkeypatch):
    """Prints edited independently, chains of edits and short texts: the classes are those of all pairs."""
    rng = random.Random(5)

    def changed(digits, share):
        return "".join(rng.choice("0123456789abcdef") if rng.random() < share else c for c in digits)

    origin = "".join(rng.choice("0123456789abcdef") for _ in range(400))
    prints = [origin, *[changed(origin, 0.15) for _ in range(600)]]
    chain = ["".join(rng.choice("0123456789abcdef") for _ in range(300))]
    for _ in range(100):
        chain.append(changed(chain[-1], 0.1) + "7")
    prints = [f"00{d}" for d in dict.fromkeys(prints + chain)] + ["00"]
    want = list(range(len(prints)))
    for a, b in edit_fingerprint.forest(prints, edit_fingerprint.NEAR):  # as checked below
        x, y = want[a], want[b]
        want = [min(x, y) if w in (x, y) else w for w in want]
    for a in range(len(prints)):
        for b in range(a):
            assert want[a] == want[b] or edit_fingerprint.likeness(prints[a], prints[b]) < edit_fingerprint.NEAR
    assert all(edit_fingerprint.likeness(prints[a], prints[b]) >= edit_fingerprint.NEAR
               for a, b in edit_fingerprint.forest(prints, edit_fingerprint.NEAR))
    monkeypatch.setattr(edit_fingerprint, "BLOCK", 50)  # groups of two blocks as well
    df = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fp string")
    found = {r["doc_id"]: r["class_id"] for r in edit_fingerprint.with_class(df, "fp").collect()}
    assert [found[i] for i in range(len(prints))] == want and len(set(want)) < 20
    same = np.mean([(edit_fingerprint._picks(n) == edit_fingerprint._picks(n + 2)).all(axis=1).mean() for n in range(100, 250)])
    assert same > 0.85
    texts = ["the quick brown fox jumps over the lazy dog by the river", "the quick brown fox jumps over the lazy dog by the rivers"]
    likes = edit_fingerprint.likeness(*map(edit_fingerprint.fingerprint, texts))
    short = {r["doc_id"]: r["class_id"] for r in edit_fingerprint.near_classes(
        spark.createDataFrame(list(enumerate(texts)) + [(2, "ab"), (3, "cd")], "doc_id long, text string")).collect()}
    assert likes >= edit_fingerprint.NEAR and short == {0: 0, 1: 0, 2: 2, 3: 3}


def test_stages_take_anything(spark, docs, none, tmp_path):
    """Every stage but the last gives back the columns it got, on odd and on empty tables."""
    spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en")).withColumn("source", F.lit(None).cast("string"))
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, none.withColumn("lang", F.lit(None).cast("string"))):
            out = stage(spark, df, str(tmp_path))
            assert out.count() <= df.count() * 20
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == df.columns
            if df is not odd:
                assert out.count() == 0
