"""The operators over the driver's tables, by name: each applies one operator and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import (byte_bpe, chat_tree, edit_fingerprint, exact_dedup, language, merkle, packing, periodic_runs, quality,
                          sharding, simhash, token_files, toxicity)
from starmill.llm.common import new_folder, table

SHARDS = 40


def op1_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The text stays behind; only its size and checksum are ordered.
    rows = docs.select("doc_id", sharding.byte_size(F.col("text")).alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = sharding.byte_shards(rows, [F.col("doc_id").asc_nulls_first()], F.col("size"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                                       "lane_bound", "certified")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.with_score(docs, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % toxicity.FOLDS == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    nodes, conversations = chat_tree.build(turns.union(planted))
    return chat_tree.read_back(nodes, conversations)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    vocabulary = byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    docs = byte_bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, keep_text=False)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2(vocabulary.text_of(F.col("ids")), 256).alias("decoded_sha256"))


def op6_bit_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    docs = token_files.read(spark, folder)
    return docs.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.fold("doc_id", 3) == 1
    found = language.identify(docs.drop("lang"), language.fit(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.with_class(edit_fingerprint.compare_with_next(table(spark, sf_dir, "documents")), "fingerprint")


def _crc(column: str) -> Column:
    """Unsigned CRC-32 of an id as text; null for a null."""
    return F.crc32(F.col(column).cast("string"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    rest = [F.col(c) for c in docs.columns[:-1]]
    tampered = merkle.leaf(*rest, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    leaves = docs.withColumn("leaf", merkle.leaf(*rest, F.col("text")))
    leaves = leaves.select("doc_id", "source", "leaf", F.when(_crc("doc_id") % 2 == 0, tampered).otherwise(F.col("leaf")).alias("shown"))
    return merkle.build(leaves, "source", ["doc_id"], "leaf").verify("shown").drop("source", "shown")


def op12_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, _ = quality.with_score(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.select("doc_id", (~quality.learning("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = _crc("doc_id")
    g = F.floor(h / 10).cast("long")
    repeated = periodic_runs.repeated_from(F.col("text"), lambda n: g % n, lambda n: 1 + F.floor((n - g % n) / (3 + g % 8)).cast("long"))
    docs = docs.withColumn("text", F.when(h % 10 == 0, repeated).otherwise(F.col("text")))
    found = periodic_runs.with_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.short")
    return out.select("doc_id", "n_runs", (-F.col("best.back")).alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_shards, op2_best_fit_packing, op3_toxicity, op4_chat_tree, op5_byte_bpe, op6_bit_plane_files, op7_language, op8_simhash, op9_exact_dedup,
    op10_edit_fingerprints, op11_merkle_manifest, op12_pu_quality, op13_periodic_runs)}
