"""Documents to training shards: each stage calls one operator of voltmesh.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmesh.llm import decontamination, language, mixing, sharding, simhash
from voltmesh.llm.common import held_out, settle, table

#: Shards of one weight that the last stage deals documents to.
SHARDS = 16

#: Language models, fingerprints and alignments have no counterpart in SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or mostly in no language learned from the labelled ones, go."""
    model = language.fit(docs.filter(~held_out(F.col("doc_id"))))
    return language.reject_unknown(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the least id."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, bits=simhash.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that all sources have one expected size."""
    return mixing.mix(docs).select(docs.columns)


def shard_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return sharding.assign(docs, [1.0] * SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard_records", shard_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each one's result written for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
