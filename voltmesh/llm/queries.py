"""The queries of this folder and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination,
    dialogues,
    language,
    mixing,
    neighbours,
    prefixes,
    quality,
    repeats,
    secrets,
    sharding,
    simhash,
    urls,
    vectors,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Shards of the registered query, all of one weight.
SHARDS = 16

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, found through trigram posting lists."""
    return secrets.secret_list(table(spark, folder, "documents"))


SQL["op1_secret_scan"] = secrets.secret_sql()


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language by n-gram masks learned from the rows not held out."""
    return language.language_list(table(spark, folder, "documents"))


@query
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Documents copied so that all sources have the same expected size."""
    return mixing.mix(table(spark, folder, "documents"))


SQL["op3_mix_sources"] = mixing.mix_sql()


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document."""
    benchmark = table(spark, folder, "benchmark")
    return decontamination.leak_list(table(spark, folder, "documents"), benchmark)


@query
def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and its component of linked fingerprints."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's measures and verdict by the line-first rules."""
    return quality.quality_list(table(spark, folder, "documents"))


SQL["op6_quality_rules"] = quality.quality_sql()


@query
def op7_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's bytes that repeat in strings of 400 bytes and more, and what is left."""
    return repeats.repeat_list(table(spark, folder, "documents"))


SQL["op7_remove_repeats"] = repeats.repeat_sql()


@query
def op8_shard_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place among 16 shards of one weight."""
    return sharding.shard_list(table(spark, folder, "documents"), [1.0] * SHARDS)


SQL["op8_shard_records"] = sharding.shard_sql(SHARDS)


@query
def op9_filter_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict, by rule or by trees trained on the URLs that a rule decides."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op10_quality_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score by its nearest labelled neighbours."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return neighbours.quality_scores(table(spark, folder, "documents"), labels)


@query
def op11_repair_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest repair and the digest of the result."""
    conversations = table(spark, folder, "conversations")
    return dialogues.repair_list(conversations, dialogues.damaged(conversations))


SQL["op11_repair_conversations"] = dialogues.repair_sql()


@query
def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every 50th, through a forest of random-projection trees."""
    return vectors.nearest_list(table(spark, folder, "embeddings"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with the sums of its subtree."""
    return prefixes.conversation_trie(table(spark, folder, "conversations"))


SQL["op13_prefix_trie"] = prefixes.trie_sql()
