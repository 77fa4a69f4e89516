"""Weighted rendezvous hashing of record keys onto shards. DataFrame functions only.

Every shard draws a number in (0, 1) from the hash of (seed, key, shard); the
highest -weight / ln(draw) takes the record. A shard's draw does not depend on the other
shards, so one shard more takes records into itself and moves no other.
The law kept is `key`: id and shard count decide, so copies of one record stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voltmesh.operators.skew import running_sums, sliced

from .common import digits

SEED = "shard"


def key_text(key: Column) -> Column:
    """The key as text; all null keys count as one empty key."""
    return F.coalesce(key.cast("string"), F.lit(""))


def scores(key: Column, weights: Sequence[float], seed: str = SEED) -> Column:
    """Array of (score, -shard), one for each shard; equal scores go to the lower shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")

    def score(weight: Column, shard: Column) -> Column:
        draw = (digits(F.lit(seed), key, shard.cast("string")).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-weight / F.ln(draw)).alias("score"), (-shard).alias("back"))

    return F.transform(F.array(*[F.lit(float(w)) for w in weights]), score)


def best(scored: Column, shards: int) -> Column:
    """The winner among the first `shards` shards."""
    return (-F.array_max(F.slice(scored, 1, shards))["back"]).cast("int")


def assign(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    name: str = "shard",
    grown: float | None = None,
    grown_name: str = "grown_shard",
) -> DataFrame:
    """Add the shard of every row, and with `grown` (the weight of one shard more) the
    shard it would have then. Columns of these names that are there already are replaced.
    Rows with equal keys, repeated rows and null keys included, share a shard."""
    every = [*weights, *([] if grown is None else [grown])]
    named = [name, *([] if grown is None else [grown_name])]
    rows = docs.select(
        F.struct(*docs.drop(*named).columns).alias("row"),
        scores(key_text(F.col(key)), every).alias("scored"),
    )
    winners = [best(F.col("scored"), n).alias(c) for c, n in zip(named, (len(weights), len(every)))]
    return rows.select("row.*", *winners)


def shard_list(docs: DataFrame, weights: Sequence[float], grown: float = 1.0) -> DataFrame:
    """Where every document goes: doc_id, size (UTF-8 bytes and 1), text_crc32, law, shard,
    slot, grown_shard. A null text counts as empty.

    Slots number a shard's rows from 0 by hash of the id, then id (null first), size and
    crc. Equal rows are counted before the shuffle and numbered in one go, and the rows of a
    shard are cut into ranges of that order, so neither a hot id nor a shard is one task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = key_text(F.col("doc_id"))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        digits(F.lit("slot"), key).alias("_hash"),
    )
    groups = rows.groupBy("doc_id", "size", "text_crc32", "_hash").agg(F.count("*").alias("_n"))
    placed = assign(groups, weights, grown=grown)
    order = [F.col("_hash"), F.asc_nulls_first("doc_id"), F.col("size"), F.col("text_crc32")]
    cut = sliced(placed, ["shard"], order)
    numbered = running_sums(cut, ["shard"], F.col("_cut"), order, {"_end": F.col("_n")})
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("_end") - F.col("_n"), F.col("_end") - 1)).alias("slot"),
        "grown_shard",
    )


def shard_sql(shards: int) -> str:
    """The same list in DuckDB."""
    table: list[int] = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)

    def score(shard: int) -> str:
        draw = f"(('0x' || substr(md5('{SEED}#' || key || '#{shard}'), 1, 13))::bigint::double + 0.5)"
        return f"{{'score': -1.0 / ln({draw} / {float(1 << 52)!r}), 'back': -{shard}}}"

    return f"""
        with crc_table as (select {table} as t),
        rows as (
            select doc_id, coalesce(text, '') as body, coalesce(doc_id::varchar, '') as key
            from documents),
        coded as (
            select doc_id, key, strlen(body)::bigint + 1 as size,
                xor(list_reduce(
                    list_prepend(4294967295::bigint,
                        list_transform(regexp_extract_all(hex(body), '..'), lambda x: ('0x' || x)::bigint)),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as text_crc32
            from rows, crc_table),
        placed as (
            select *, ('0x' || substr(md5('slot#' || key), 1, 13))::bigint as h,
                -list_max([{", ".join(score(s) for s in range(shards))}]).back as shard,
                -list_max([{", ".join(score(s) for s in range(shards + 1))}]).back as grown
            from coded)
        select doc_id, size, text_crc32, 'key' as law, shard::int as shard,
            row_number() over (partition by shard
                order by h, doc_id nulls first, size, text_crc32) - 1 as slot,
            grown::int as grown_shard
        from placed"""
