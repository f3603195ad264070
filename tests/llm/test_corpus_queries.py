"""The registered queries on the driver's tables, whole, against brute force or held-out labels."""

import hashlib
import os
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from starmill.llm import byte_bpe, edit_fingerprint, packing, simhash
from starmill.llm.queries import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")


def documents(folder: str) -> pd.DataFrame:
    return pd.read_parquet(f"{folder}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def result(spark, name: str, folder: str) -> pd.DataFrame:
    return QUERIES[name](spark, folder).toPandas().sort_values("doc_id", kind="stable").reset_index(drop=True)


def library_ids(file: str, texts) -> list[list[int]]:
    library = Tokenizer.from_file(public_tokenizers.path(file))
    library.encode_special_tokens = True
    return [[*e.ids, 2] for e in library.encode_batch(list(texts), add_special_tokens=False)]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards(spark):
    docs, found = documents(LARGER), result(spark, "op1_byte_shards", LARGER)
    size = docs["text"].map(lambda t: len(t.encode()) + 16)
    middle = 2 * (size.cumsum() - size) + size
    assert (found["size"] == size).all() and (found["shard"] == middle * 40 // (2 * size.sum())).all()
    assert (found["text_crc32"] == docs["text"].map(lambda t: zlib.crc32(t.encode()))).all()
    assert (found["slot"] == found.groupby("shard").cumcount()).all() and set(found["law"]) == {"bytes"}
    assert found["grown_shard"].isna().all()
    assert (found.groupby("shard")["size"].sum() - size.sum() / 40).abs().max() <= size.max()


def test_packing(spark):
    docs, found = documents(LARGER), result(spark, "op2_best_fit_packing", LARGER)
    want = {}
    for doc_id, ids in zip(docs["doc_id"], library_ids("byte_bpe_50k.json", docs["text"])):
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want |= {(doc_id, k): (a, z - a, crc(ids[a:z])) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found.itertuples()} == want
    for _, group in found.sort_values("offset").groupby("sequence_id"):
        assert group["offset"].tolist() == (group["length"].cumsum() - group["length"]).tolist() and group["length"].sum() <= 1024
    bound = packing.lower_bound(found["length"].to_numpy(), 1024)
    assert bound <= found["sequence_id"].nunique() <= 1.002 * bound + 1


def test_byte_bpe(spark):
    docs, found = documents(SMALL), result(spark, "op5_byte_bpe", SMALL)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r, text in zip(found.itertuples(), docs["text"]):
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_files(spark):
    docs, found = documents(LARGER), result(spark, "op6_bit_plane_files", LARGER)
    ids = library_ids("word_bpe_49k.json", docs["text"])
    n = pd.Series([len(x) for x in ids])
    assert (found["n_tokens"] == n).all() and (found["start"] == n.cumsum() - n).all()
    assert found["ids_crc32"].tolist() == [crc(x) for x in ids]


def test_simhash(spark):
    docs, found = documents(LARGER), result(spark, "op8_simhash", LARGER)
    prints = np.array([int(f, 16) for f in found["fingerprint"]], np.uint64)
    assert found["fingerprint"].tolist() == [f"{simhash.fingerprint(t.encode()):016x}" for t in docs["text"]]
    label = np.arange(len(prints))
    while True:
        new = np.array([label[np.bitwise_count(prints ^ p) <= 3].min() for p in prints])
        if (new == label).all():
            break
        label = new
    assert found["component_id"].tolist() == docs["doc_id"].to_numpy()[label].tolist()


def test_edit_fingerprints(spark):
    docs, found = documents(SMALL)[::-1], result(spark, "op10_edit_fingerprints", SMALL)[::-1]
    texts = docs["text"].tolist()
    for r, t, after in zip(found.itertuples(), texts, texts[1:] + texts[:1]):
        edited = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        assert r.fingerprint == edit_fingerprint.fingerprint(t) and r.edited_fingerprint == edit_fingerprint.fingerprint(edited)
    assert (found["near_edited"] > found["near_next"] + 0.2).mean() > 0.98


def test_language(spark):
    docs, found = documents(LARGER), result(spark, "op7_language", LARGER)
    held = docs["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert (found["held_out"] == held).all() and found["score"].between(0, 1).all()
    assert (found["lang_pred"] == docs["lang"])[held].mean() > 0.99


def test_toxicity(spark):
    found = result(spark, "op3_toxicity", LARGER)
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.5)).all()
    both = found.merge(pd.read_parquet(f"{LARGER}/labels.parquet"), on="doc_id")
    held = both[both["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.93
    clean = held[held["toxic"] == 0]
    assert (clean["predicted"] == 0).mean() > 0.97


def test_pipeline(spark):
    """Each stage's decisions by themselves, then the last stage's rows from what the others kept."""
    sf, docs = SMALL, spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.toPandas().set_index("doc_id")
        kept = corpus_pipeline.stored(stage(spark, kept, sf), "test")
        assert kept.columns == docs.columns
        after = kept.toPandas().set_index("doc_id")
        assert before.loc[after.index].sort_index().equals(after.sort_index())
        gone = before.drop(after.index)
        if name == "toxicity":
            labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")["toxic"]
            assert labels.reindex(after.index).fillna(0).mean() < labels.mean() / 2
        elif name == "language ID":
            assert not gone["text"].map(lambda t: any(c.isalpha() for c in t or "")).any()
        elif name == "exact dedup":
            assert set(after.index) == set(before.reset_index().groupby(
                before["text"].str.replace("[\x20\x09-\x0d]+", " ", regex=True).to_numpy())["doc_id"].min())
        else:
            prints = np.array([simhash.fingerprint(t.encode()) for t in before["text"]], np.uint64)
            near = np.bitwise_count(prints[:, None] ^ prints) <= 3
            reach = near.copy()
            while (reach @ near > 0).sum() > reach.sum():
                reach = reach @ near > 0
            ids = before.index.to_numpy()
            assert set(after.index) == {ids[r].min() for r in reach}
    pieces = corpus_pipeline.run(spark, sf).toPandas()
    assert set(pieces["doc_id"]) == set(kept.toPandas()["doc_id"]) and pieces.groupby("sequence_id")["length"].sum().max() <= 1024


