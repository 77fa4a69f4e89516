import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltmesh.operators import filters, merges, skew
from voltmesh.schemas import KEYS, STATUS, STATUS_COLUMNS

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def table(spark, rows):
    return spark.createDataFrame([(s, c, st, at(a), at(b), at(n)) for s, c, st, a, b, n in rows], STATUS)


def as_dict(df):
    return {(r["statid"], r["chgerid"]): tuple(r[c] for c in STATUS_COLUMNS) for r in df.collect()}


def values(stat, a, b, n):
    return (stat, at(a), at(b), at(n))


def test_null_is_no_change(spark):
    base = table(spark, [("A", 1, 2, 1, 1, 1), ("B", 1, 2, 1, 1, 1), ("C", 1, 2, 1, 1, 1)])
    delta = table(spark, [("A", 1, 2, 1, 1, None), ("B", 1, 3, 1, 1, None), ("D", 1, 1, 1, 1, 1)])
    assert as_dict(merges.merge_status(base, delta)) == {
        ("A", 1): values(2, 1, 1, 1), ("B", 1): values(3, 1, 1, None), ("C", 1): values(2, 1, 1, 1),
    }
    assert filters.changed_rows(base, delta, STATUS_COLUMNS).count() == 1


def random_rows(rng, n, start):
    keys = rng.sample([(f"S{i}", c) for i in range(12) for c in (1, 2)], n)
    pick = lambda: rng.choice([None, start, start + 1])
    return [(s, c, rng.randint(1, 3), start + rng.randint(0, 1), start, pick()) for s, c in keys]


def test_merge_twice_is_merge_once(spark):
    rng = random.Random(1)
    base, delta = table(spark, random_rows(rng, 15, 0)), table(spark, random_rows(rng, 15, 0))
    once = merges.merge_status(base, delta)
    assert as_dict(merges.merge_status(once, delta)) == as_dict(once)


def test_buffered_replay_equals_direct_merge(spark):
    rng = random.Random(2)
    base = table(spark, random_rows(rng, 20, 0))
    first, second = table(spark, random_rows(rng, 15, 10)), table(spark, random_rows(rng, 15, 20))
    buffer = merges.upsert_status(merges.upsert_status(table(spark, []), first), second)
    replayed = merges.replay_buffer(base, buffer)
    direct = merges.merge_status(merges.merge_status(base, first), second)
    pick = lambda df: {k: v[:2] for k, v in as_dict(df).items()}
    assert pick(replayed) == pick(direct)


def test_replay_can_keep_newer_rows(spark):
    base, buffer = table(spark, [("A", 1, 2, 9, 9, 9)]), table(spark, [("A", 1, 3, 5, 5, 5)])
    assert as_dict(merges.replay_buffer(base, buffer))[("A", 1)][:2] == (3, at(5))
    assert as_dict(merges.replay_buffer(base, buffer, True))[("A", 1)][:2] == (2, at(9))


@pytest.mark.parametrize("upsert", [False, True])
def test_folding_a_log_equals_merging_each_delta(spark, upsert):
    rng = random.Random(3)
    merge = merges.upsert_status if upsert else merges.merge_status
    base = want = table(spark, random_rows(rng, 12, 0))
    log = None
    for batch in range(4):
        delta = table(spark, random_rows(rng, 14, 1))
        want = merge(want, delta)
        part = delta.withColumn("batch", F.lit(batch).cast("bigint"))
        log = part if log is None else log.unionByName(part)
    assert as_dict(merges.fold_updates(base, log, "batch", upsert)) == as_dict(want)


def test_insert_ignore_keeps_the_first(spark):
    base = table(spark, [("A", 1, 2, 1, 1, 1)])
    batch = table(spark, [("A", 1, 3, 2, 2, 2), ("B", 1, 1, 2, 2, 2), ("B", 1, 5, 1, 1, 1)])
    got = merges.insert_ignore(base, batch, KEYS, [F.col("statupddt")])
    assert as_dict(got) == {("A", 1): values(2, 1, 1, 1), ("B", 1): values(5, 1, 1, 1)}
    assert got.count() == 2


def test_keyed_update_takes_the_last_entry_even_if_null(spark):
    base = table(spark, [("A", 1, 2, 1, 1, 1), ("B", 1, 2, 1, 1, 1)])
    updates = table(spark, [("A", 1, 3, 1, 1, 1), ("A", 1, 4, 2, 2, None)])
    got = merges.keyed_update(base, updates, KEYS, ["stat", "nowtsdt"], [F.col("statupddt").desc()])
    assert as_dict(got) == {("A", 1): values(4, 1, 1, None), ("B", 1): values(2, 1, 1, 1)}


def test_unmatched_codes(spark):
    chargers = spark.createDataFrame([("A", "x"), ("B", "y")], "statid string, addcd string")
    found = spark.createDataFrame([("A", "1")], "statid string, addcd string")
    assert sorted(map(tuple, merges.take_codes(chargers, found).collect()), key=str) == [("A", "1"), ("B", None)]
    assert [tuple(r) for r in merges.keep_coded(chargers, found).collect()] == [("A", "1")]


def test_running_sums_over_slices_equal_plain_sums(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 3)}", i, rng.randint(-3, 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i bigint, v bigint")
    got = skew.running_sums(df, ["k"], F.floor(F.col("i") / 7), [F.col("i")], {"s": F.col("v")})
    totals, want = {}, {}
    for k, i, v in rows:
        totals[k] = totals.get(k, 0) + v
        want[i] = totals[k]
    assert {r["i"]: r["s"] for r in got.collect()} == want
