"""The corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmill.llm import exact_dedup, language, packing, simhash, toxicity
from starmill.llm.common import stored, table


def calm(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below 0.5 for toxicity."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose text has a language, which unlabelled ones get from the model; those without a letter go."""
    return language.without_unknown(docs, language.fit(docs, language.fold("doc_id", 3) != 1))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact_dedup.first_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near fingerprints."""
    return simhash.first_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset; a sequence holds texts of one language only."""
    pieces = packing.pieces(docs.select("doc_id", "lang", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces.drop("ids"), by="lang")


STAGES = [("toxicity", calm), ("language ID", spoken), ("exact dedup", exact), ("simhash near-dedup", near),
          ("best-fit packing", pack)]

#: Fingerprints, classifiers and tokenizers are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
