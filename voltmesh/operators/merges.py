"""Keyed merges: update, upsert, insert-ignore, replay."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import KEYS, STATUS_COLUMNS
from .filters import differs
from .skew import first_per_key, join_apart


def latest_per_key(
    feed: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[Column] | None = None
) -> DataFrame:
    """Newest feed row of each charger; equal times fall back to the status values."""
    if order is None:
        order = [F.col(c).desc_nulls_last() for c in ("statupddt", "nowtsdt", "lasttedt", "stat")]
    return first_per_key(feed, keys, order)


def merge_status(
    base: DataFrame,
    delta: DataFrame,
    columns: Sequence[str] = STATUS_COLUMNS,
    keys: Sequence[str] = KEYS,
    newer_only: bool = False,
) -> DataFrame:
    """Base rows with the delta's values where any tracked column differs.

    Unmatched base rows stay, unmatched delta rows are ignored. The delta has
    one row per key; latest_per_key makes it so. `newer_only` keeps a base row with a later statupddt.
    """
    incoming = delta.select(*keys, F.struct(*columns).alias("b"))
    joined = base.withColumn("a", F.struct(*columns)).join(incoming, list(keys), "left")
    hit = differs("a", "b", columns)
    if newer_only:
        hit = hit & F.coalesce(F.col("b.statupddt") >= F.col("a.statupddt"), F.lit(True))
    merged = {c: F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) for c in columns}
    return joined.select(*[merged[c].alias(c) if c in merged else F.col(c) for c in base.columns])


def replay_buffer(snapshot: DataFrame, buffer: DataFrame, newer_only: bool = False) -> DataFrame:
    """Bring a rebuilt snapshot up to date; only stat and statupddt are taken."""
    return merge_status(snapshot, buffer, ["stat", "statupddt"], newer_only=newer_only)


def upsert_status(
    buffer: DataFrame,
    delta: DataFrame,
    columns: Sequence[str] = STATUS_COLUMNS,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """merge_status, plus the delta rows whose key the buffer lacks, in one join."""
    left = buffer.select(*keys, F.struct(*columns).alias("a"))
    right = delta.select(*keys, F.struct(*columns).alias("b"))
    joined = left.join(right, list(keys), "full_outer")
    taken = F.col("a").isNull() | differs("a", "b", columns)
    row = F.when(taken, F.col("b")).otherwise(F.col("a"))
    return joined.select(*keys, *[row[c].alias(c) for c in columns])


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Target plus the batch rows with a new key, the first of each key."""
    return target.unionByName(
        first_per_key(batch, keys, order)
        .join(target.select(*keys), list(keys), "left_anti")
        .select(*target.columns)
    )


def keyed_update(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Set columns by key from a list; with `order`, its last entry for a key wins.

    Without `order` the list has one entry per key already.
    """
    entries = updates if order is None else first_per_key(updates, keys, order)
    right = entries.select(*keys, F.struct(*columns).alias("_new"))
    joined = join_apart(base, right, keys, "left")
    value = lambda c: F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}"))
    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in base.columns])


def take_codes(chargers: DataFrame, station_codes: DataFrame) -> DataFrame:
    """Region code of every charger from the code table; without a match it becomes null."""
    return (
        chargers.drop("addcd")
        .join(station_codes.select("statid", "addcd"), "statid", "left")
        .select(*chargers.columns)
    )


def keep_coded(chargers: DataFrame, station_codes: DataFrame) -> DataFrame:
    """As take_codes, but chargers without a match are left out."""
    return (
        chargers.drop("addcd")
        .join(station_codes.select("statid", "addcd"), "statid")
        .select(*chargers.columns)
    )


def with_delta_columns(snapshot: DataFrame, delta: DataFrame) -> DataFrame:
    """Every snapshot row with the delta's columns beside it (suffix up)."""
    right = delta.select(*KEYS, *[F.col(c).alias(f"{c}up") for c in STATUS_COLUMNS])
    return snapshot.join(right, KEYS, "left")


def fold_updates(
    base: DataFrame, log: DataFrame, seq: str, upsert: bool, small: bool = False
) -> DataFrame:
    """Apply logged deltas in the order of `seq` (one row per key and seq).

    Equal to merge_status, or upsert_status, once per delta. A key has as many
    entries as there are deltas since the last compaction, which bounds the list; the
    store compacts snapshot and buffer alike. `small` says that the log's size has been looked at
    and fits every task; updates of the base then happen where its rows lie, without a shuffle.
    """
    columns = STATUS_COLUMNS
    entries = log.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct(seq, F.struct(*columns).alias("v")))).alias("_log")
    )
    values = F.transform(F.col("_log"), lambda e: e["v"])
    held = base.withColumn("_held", F.struct(*columns))
    if small and not upsert:
        entries = F.broadcast(entries)
    joined = held.join(entries, KEYS, "full_outer" if upsert else "left")

    def step(now: Column, new: Column) -> Column:
        tests = [now[c] != new[c] for c in columns]
        differ = F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
        return F.when(now.isNull() | differ, new).otherwise(now)

    start = F.col("_held")
    if upsert:
        start = F.coalesce(start, F.element_at(values, 1))
    folded = joined.withColumn(
        "_now", F.when(F.col("_log").isNull(), start).otherwise(F.aggregate(values, start, step))
    )
    return folded.select(
        *[F.col(f"_now.{c}").alias(c) if c in columns else F.col(c) for c in base.columns]
    )
