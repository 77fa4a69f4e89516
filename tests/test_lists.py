"""Lists folded from commands against applying the commands one by one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltmesh.operators import skew, user_lists
from voltmesh.streaming import commands as lists

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "user_id bigint, op string, item string, ts timestamp_ntz, event_id bigint, idx int, name string"


def commands(seed, n=900):
    rng = random.Random(seed)
    out = []
    minute = 0
    for i in range(n):
        minute += rng.choice([0, 0, 0, 1, 7])
        user = 1 if rng.random() < 0.4 else rng.randint(2, 9)
        op = rng.choices(["add", "remove", "removeall"], [6, 4, 0.4])[0]
        k = rng.randint(0, 5)
        out.append((user, op, f"M{k}", T0 + dt.timedelta(minutes=minute), i, k, f"n{i}"))
    return out


def apply_bookmark(state, op, item):
    if op == "removeall":
        state.clear()
    elif op == "add" and item not in state:
        state.append(item)
    elif op == "remove" and item in state:
        state.remove(item)


def apply_recent(state, op, item):
    if op == "removeall":
        state.clear()
        return
    if item in state:
        state.remove(item)
    if op == "add":
        state.insert(0, item)


def apply_filter(state, op, item):
    if op == "add":
        state.append(item)
    elif op == "remove" and item in state:
        state.remove(item)


CASES = [
    (apply_bookmark, user_lists.bookmark_state),
    (apply_recent, user_lists.recent_search_state),
    (apply_filter, user_lists.filter_state),
]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("apply,fold", CASES)
def test_lists(spark, seed, apply, fold):
    log = commands(seed)
    want = {}
    for user, op, item, *_ in log:
        apply(want.setdefault(user, []), op, item)
    got = {}
    for r in fold(spark.createDataFrame(log, SCHEMA)).orderBy("user_id", "pos").collect():
        entries = got.setdefault(r["user_id"], [])
        entries.append(r["item"])
        assert r["pos"] == len(entries)
    assert got == {u: items for u, items in want.items() if items}


@pytest.mark.parametrize(
    "entries", [user_lists.bookmark_entries, user_lists.recent_search_entries, user_lists.filter_entries]
)
def test_entries_stand_for_the_commands_before(spark, entries):
    log = commands(7)
    if entries is user_lists.filter_entries:
        log = [c for c in log if c[1] != "removeall"]
    whole = spark.createDataFrame(log, SCHEMA)
    start = user_lists.as_commands(entries(spark.createDataFrame(log[:500], SCHEMA)))
    rest = spark.createDataFrame(log[500:], SCHEMA).select(*start.columns)
    in_two = entries(start.unionByName(rest))
    key = lambda df: sorted((r["user_id"], r["item"], r["event_id"]) for r in df.collect())
    assert key(in_two) == key(entries(whole))


def test_flags(spark):
    log = commands(5)
    want = {}
    for user, op, _, _, _, idx, _ in log:
        if op != "removeall":
            want.setdefault(user, [0] * 6)[idx] = int(op == "add")
    got = user_lists.flag_state(spark.createDataFrame(log, SCHEMA)).collect()
    assert {r["user_id"]: r["flags"] for r in got} == {u: str(f) for u, f in want.items()}


def test_one_minute_of_one_user_is_cut(spark, monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 500)
    log = [(1, "add" if i % 3 else "remove", "M1", T0 + dt.timedelta(milliseconds=i // 2), i, 0, "n") for i in range(6000)]
    df = spark.createDataFrame(log, SCHEMA)
    order = [F.col("ts"), F.col("event_id")]
    rows = skew.sliced(df, ["user_id"], order).groupBy("_cut").count().collect()
    assert len(rows) >= 10 and max(r["count"] for r in rows) < 1500
    state = []
    for _, op, item, ts, event, *_ in log:
        if op == "add":
            state.append(event)
        elif state:
            state.pop(0)
    got = sorted((r["pos"], r["event_id"]) for r in user_lists.filter_state(df).collect())
    assert got == list(enumerate(state, 1))


def test_stored_text(spark):
    log = spark.createDataFrame(
        [(1, "add", "M1", T0, 1, 0, 'a "b"'), (1, "add", "M2", T0, 2, 0, "c"), (2, "add", "M1", T0, 3, 0, "x"),
         (2, "removeall", "", T0, 4, 0, ""), (3, "add", "M1", T0, 5, 0, "y")], SCHEMA,
    )
    placed = user_lists.bookmark_state(log, "name")
    placed = placed.withColumn("entry", user_lists.entry_text(placed["name"], placed["item"]))
    asked = spark.createDataFrame([(1,), (2,), (9,)], "user_id bigint")
    got = {r["user_id"]: r["items"] for r in user_lists.stored_lists(placed, log, asked).collect()}
    assert got == {1: '[["a \\"b\\"", "M1"], ["c", "M2"]]', 2: ""}


def merged(spark, store, log, schema, batches, seed=0):
    """The log in batches of random sizes, published now and then."""
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(log)), batches - 1))
    for number, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(log)])):
        store.add_batch(spark.createDataFrame(log[a:b], schema).select(*store.command.names), number)
        if rng.random() < 0.5:
            store.compact()
    return store.read()


@pytest.mark.parametrize("seed", range(2))
def test_filters_and_flags_from_a_stream(spark, tmp_path, seed):
    log = [c for c in commands(seed + 30, 400) if c[1] != "removeall"]
    whole = spark.createDataFrame(log, SCHEMA)
    key = lambda df: sorted((r["user_id"], r["item"], r["event_id"]) for r in df.collect())
    filters = merged(spark, lists.ListStore.of_filters(spark, str(tmp_path / "f")), log, SCHEMA, 5, seed)
    assert key(filters) == key(user_lists.filter_entries(whole))
    flags = lambda df: sorted(map(tuple, user_lists.flag_state(df).collect()))
    late = random.Random(seed).sample(log, len(log))  # flags do not mind the order
    entries = merged(spark, lists.ListStore.of_flags(spark, str(tmp_path / "g")), late, SCHEMA, 4, seed)
    assert flags(entries) == flags(whole)


def test_a_hot_minute_merges_into_the_entries(spark, monkeypatch):
    """One user's one item, in slices: no task sees them all, and the entries are as one by one."""
    monkeypatch.setattr(skew, "SLICE_ROWS", 300)
    rng = random.Random(4)
    log = [(1, rng.choice(["add", "remove"]), "M1", T0 + dt.timedelta(milliseconds=i), i, 0, "n") for i in range(4000)]
    log += [(2, "add", "M1", T0, 5000, 0, "n")]
    held = user_lists.merge_filters(None, spark.createDataFrame(log[:200] + log[-1:], SCHEMA))
    got = user_lists.merge_filters(held, spark.createDataFrame(log[200:4000], SCHEMA))
    state, added = [], 0
    for _, op, _, _, event, *_ in log[:4000]:
        if op == "add":
            added += 1
            state.append((event, added))
        elif state:
            state.pop(0)
    rows = got.collect()
    assert sorted((r["event_id"], r["nth"]) for r in rows if r["user_id"] == 1) == state
    assert [r["event_id"] for r in rows if r["user_id"] == 2] == [5000]


def test_the_fold_runs_once(spark, tmp_path):
    """What is cut into slices is written first, so counting and cutting do not run it again."""
    ran = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    log = spark.createDataFrame(commands(3, 500), SCHEMA)
    watched = log.mapInArrow(seen, SCHEMA)
    assert skew.sliced(watched, ["user_id"], [F.col("ts")]).count() == 500
    assert ran.value == 500
