"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

A source's repetition rate is its share of the target size over the size it has. Each
document's number of copies is the Poisson distribution of that rate, inverted at a
uniform number hashed from (seed, id, text); rates above `MAX_RATE` are the sum of
several independent draws, which is the same distribution. Copies are spread over the whole
output by a sort on a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import settle, unit

SEED = "mix"
#: Highest rate of one draw; the table of its distribution has TERMS entries, after which
#: less than 2^-52, the grain of the uniform numbers, is left.
MAX_RATE, TERMS = 8.0, 50
#: A table of rates is broadcast up to so many sources (about 420 bytes each), else joined.
BROADCAST_SOURCES = 10_000


def doc_key() -> list[Column]:
    """What a document's draws hang on: its id and its text. Equal rows draw alike."""
    return [
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.md5(F.coalesce(F.col("text"), F.lit(""))),
    ]


def size_of() -> Column:
    """UTF-8 bytes of the text; a null or empty text has size 1, so each source has a size."""
    return F.greatest(F.coalesce(F.octet_length("text"), F.lit(0)), F.lit(1)).cast("bigint")


def rates(docs: DataFrame, weights: DataFrame | None, total: float | None = None) -> DataFrame:
    """One row per source: source, size, rate.

    `weights` has source and weight (negative or null: 0); sources missing there get no
    copies. None means equal weights. `total` is the size to reach, that of the input if None.
    A null source is a source like any other.
    """
    sizes = docs.select(F.col("source"), size_of().alias("size")).groupBy("source").agg(
        F.sum("size").alias("size")
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        wanted = weights.groupBy(F.col("source").alias("_source")).agg(
            F.sum(F.greatest(F.col("weight").cast("double"), F.lit(0.0))).alias("weight")
        )
        weighted = sizes.join(wanted, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighted = settle(weighted, "sources")
    every, weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    aim = float(every or 0) if total is None else float(total)
    share = F.col("weight") / F.lit(weight) if weight else F.lit(0.0)
    return weighted.select("source", "size", (share * F.lit(aim) / F.col("size")).alias("rate"))


def distribution(rate: Column) -> Column:
    """P(X <= k) for k from 0 to TERMS - 1 of a rate of at most MAX_RATE."""
    first = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("sums"))
    steps = F.sequence(F.lit(1), F.lit(TERMS - 1))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(
            p.alias("p"), F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + p)).alias("sums")
        )

    return F.aggregate(steps, first, add, lambda acc: acc["sums"])


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    total: float | None = None,
    seed: str = SEED,
) -> DataFrame:
    """Every document as often as its draw says, in an order that mixes all sources.

    Columns of the input, then copy (bigint from 0) and mix_key; input columns of these
    two names are replaced. Sorted by mix_key over the whole output. Empty and null
    texts take part with size 1.
    """
    table = rates(docs, weights, total)
    draws = F.greatest(F.ceil(F.col("rate") / MAX_RATE), F.lit(1))
    table = table.select(
        F.xxhash64("source").alias("_mark"),
        F.col("source").alias("_source"),
        draws.cast("int").alias("_draws"),
        distribution(F.col("rate") / draws).alias("_sums"),
    )
    own = docs.drop("copy", "mix_key")
    rows = own.select(
        F.struct("*").alias("row"),
        F.concat_ws("#", *doc_key()).alias("key"),
        F.xxhash64("source").alias("mark"),
        F.col("source").alias("from"),
    )
    same = F.col("mark").eqNullSafe(F.col("_mark")) & F.col("from").eqNullSafe(F.col("_source"))
    few = table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rated = rows.join(F.broadcast(table) if few else table, same)

    def count(draw: Column) -> Column:
        at = unit(F.lit(seed), draw.cast("string"), F.col("key"))
        return F.size(F.filter(F.col("_sums"), lambda p: p <= at))

    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("_draws")), F.lit(0), lambda acc, draw: acc + count(draw)
    ).cast("bigint")
    drawn = rated.select("row", "key", copies.alias("copies")).filter("copies > 0")
    out = drawn.select(
        "row", "key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    )
    order = F.md5(F.concat_ws("#", F.lit(f"{seed}-order"), F.col("copy").cast("string"), F.col("key")))
    return out.select("row.*", "copy", order.alias("mix_key")).orderBy("mix_key", "copy")


def mix_sql(table: str = "documents") -> str:
    """`mix` with equal weights in DuckDB."""
    return f"""
        with keyed as (
            select *, row_number() over () as rid,
                coalesce(doc_id::varchar, '') || '#' || md5(coalesce(text, '')) as key,
                greatest(coalesce(strlen(text), 0), 1) as bytes
            from {table}),
        sizes as (select source, sum(bytes)::bigint as size from keyed group by source),
        rated as (
            select source, 1.0::double / (count(*) over ())::double
                * (sum(size) over ())::double / size::double as rate from sizes),
        cut as (select source, rate, greatest(ceil(rate / {MAX_RATE}), 1)::int as draws from rated),
        terms as (
            select source, k, sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1)))
                over (partition by source order by k) as p
            from cut, range({TERMS}) as r(k)),
        tables as (select source, list(p order by k) as sums from terms group by source),
        drawn as (
            select rid, key, sums, unnest(range(1, draws + 1)) as draw
            from keyed join cut on keyed.source is not distinct from cut.source
                join tables on keyed.source is not distinct from tables.source),
        counted as (
            select rid, sum(len(list_filter(sums, lambda p: p <=
                (('0x' || substr(md5('{SEED}#' || draw || '#' || key), 1, 13))::bigint::double + 0.5)
                / {float(1 << 52)!r})))::bigint as copies
            from drawn group by rid),
        copied as (
            select rid, unnest(range(copies)) as copy from counted where copies > 0)
        select doc_id, text, lang, source, n_chars, copy,
            md5('{SEED}-order#' || copy || '#' || key) as mix_key
        from copied join keyed using (rid)"""
