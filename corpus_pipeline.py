"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, BPE. Each stage is written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, for every
row that they keep. Stages run on whole tables and whole texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, exact_dedup, language, mixing, near_dedup
from tessera.llm.common import documents, stash

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letters) go; the model is fitted on the labelled rows of `docs`."""
    return language.accepted(docs, language.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs, keep="smallest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word shingles the smallest doc_id stays."""
    return near_dedup.drop_near(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of sources takes it: not at all, once or twice."""
    return mixing.emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and digests of the ids and of what they decode to."""
    return bpe.round_trip_digests(docs, WORD_BPE, with_ids=True)


STAGES = [("language_id", language_id), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mix", mix), ("encode", encode)]

#: SQL has no BPE or learned language model; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
