"""Writers that come at once, too late, or again under another checkpoint lose nothing."""

import random
import threading

import pytest

from tests.test_feeds import rows_of, small_store, stats
from voltmesh.operators import regions
from voltmesh.schemas import STATUS
from voltmesh.sinks import ledger
from voltmesh.sinks import tables as sinks
from voltmesh.streaming import status


def together(*tasks):
    """Run tasks at once and give what each returned or raised."""
    out, gate = [None] * len(tasks), threading.Barrier(len(tasks))

    def run(at, task):
        gate.wait()
        try:
            out[at] = task()
        except Exception as error:  # noqa: BLE001  the test looks at it
            out[at] = error

    threads = [threading.Thread(target=run, args=pair) for pair in enumerate(tasks)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


@pytest.mark.parametrize("local", [True, False])
def test_one_of_many_creates_wins(spark, tmp_path, monkeypatch, local):
    """By hard links, or by renames as on other file systems."""
    if not local:
        link = lambda path, text: ledger._rename(spark, *ledger.file_system(spark, path), text)
        monkeypatch.setattr(ledger, "_link", link)
    path = str(tmp_path / "a" / "entry.json")
    ledger.create_new(spark, path, "first")
    out = together(*[lambda: ledger.create_new(spark, path, "late") for _ in range(4)])
    assert all(isinstance(e, sinks.PublishConflict) for e in out)
    assert (tmp_path / "a" / "entry.json").read_text() == "first"
    if local:
        for turn in range(10):
            path = str(tmp_path / "b" / f"{turn}.json")
            out = together(*[lambda n=n: ledger.create_new(spark, path, str(n)) for n in range(6)])
            assert sum(e is None for e in out) == 1
            assert out[int((tmp_path / "b" / f"{turn}.json").read_text())] is None
    assert not list(tmp_path.glob("*/.*")) or not local


def test_of_two_publishers_at_once_one_wins(spark, tmp_path):
    for turn in range(3):
        root = str(tmp_path / f"t{turn}")
        sinks.VersionedTable(spark, root).publish(spark.range(1))
        out = together(*[lambda n=n: sinks.VersionedTable(spark, root).publish(spark.range(n)) for n in (10, 20, 30)])
        lost = [e for e in out if isinstance(e, Exception)]
        assert all(isinstance(e, sinks.PublishConflict) for e in lost)
        table = sinks.VersionedTable(spark, root)
        assert table.last()[0] == 4 - len(lost) and table.read().count() in (10, 20, 30)


def test_rows_of_an_older_version_are_refused(spark, tmp_path):
    one, two = (sinks.VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.publish(spark.range(3))
    read = one.read()
    two.publish(two.read().union(spark.range(10, 12)))
    with pytest.raises(sinks.PublishConflict):
        one.publish(read.filter("id > 0"))
    with pytest.raises(sinks.PublishConflict):
        one.publish(spark.range(1), read_from=1)
    assert one.last()[0] == 2 and one.read().count() == 5
    assert len(list((tmp_path / "t" / "data").iterdir())) == 4, "the refused rows are gone"
    one.publish(spark.range(1), read_from=2)
    assert two.read().count() == 1


def test_a_stale_ledger_is_found_out(spark, tmp_path, monkeypatch):
    one, two = (sinks.VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.publish(spark.range(3))
    stale = two.ledger.entries()
    one.publish(spark.range(5))
    monkeypatch.setattr(two.ledger, "entries", lambda: stale)
    with pytest.raises(sinks.PublishConflict):
        two.publish(spark.range(9))
    assert one.read().count() == 5


def test_a_number_is_never_free_again(spark, tmp_path, monkeypatch):
    """A writer so late that its number has been dropped as old is found out after its create."""
    monkeypatch.setattr(ledger, "KEEP_ENTRIES", 3)
    book = ledger.Ledger(spark, str(tmp_path))
    for number in range(1, 6):
        book.add(number, {"n": number})
    for number in (1, 2):
        book.remove(number)
    late = ledger.Ledger(spark, str(tmp_path))
    fresh, asked = late.numbers, []
    monkeypatch.setattr(late, "numbers", lambda: [] if not asked and not asked.append(1) else fresh())
    with pytest.raises(sinks.PublishConflict):
        late.add(2, {"n": "late"})
    assert book.numbers() == [3, 4, 5]


def test_updates_at_once_all_count(spark, tmp_path):
    table = sinks.VersionedTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(1))
    add = lambda n: lambda: sinks.VersionedTable(spark, str(tmp_path / "t")).update(lambda df: df.union(spark.range(n, n + 1)))
    out = together(add(10), add(20), add(30))
    assert not [e for e in out if isinstance(e, Exception)]
    assert sorted(r[0] for r in table.read().collect()) == [0, 10, 20, 30]


def test_logs_with_two_writers(spark, tmp_path, monkeypatch):
    open_log = lambda: sinks.DeltaLog(spark, str(tmp_path / "log"), STATUS)
    one = open_log()
    one.add(rows_of(spark, ("A", 1, 1, 1)), "one", 0)
    add = lambda run: lambda: open_log().add(rows_of(spark, (run, 1, 1, 1)), run, 0)
    assert sorted(together(add("two"), add("three"), add("four"))) == [1, 2, 3]
    stale = open_log()
    monkeypatch.setattr(stale, "last", lambda: 0)
    with pytest.raises(sinks.PublishConflict):
        stale.add(rows_of(spark, ("X", 1, 1, 1)), "five", 0)
    with pytest.raises(sinks.PublishConflict):
        one.add(rows_of(spark, ("Y", 1, 1, 1)), "six", 0, expect=2)
    assert sorted(r["statid"] for r in one.read().collect()) == ["A", "four", "three", "two"]
    assert one.add(rows_of(spark, ("Z", 1, 1, 1)), "one", 0) == 0 and one.last() == 3
    assert len(list((tmp_path / "log" / "deltas").iterdir())) == 4


def test_control_row_under_two_jobs(spark, tmp_path):
    store = small_store(spark, tmp_path)
    twin = status.StatusStore(spark, str(tmp_path / "store"))
    out = together(lambda: store.set_control(ck=0), lambda: twin.set_control(at=55.0))
    assert out == [None, None] and store.control() == (0, 55.0)


def test_compaction_that_comes_second_loses(spark, tmp_path, monkeypatch):
    store = small_store(spark, tmp_path)
    store.merge_batch(rows_of(spark, ("A", 1, 2, 1)), 0)
    twin = status.StatusStore(spark, str(tmp_path / "store"))
    layout = lambda rows: (store.compact(), rows)[1]
    monkeypatch.setattr(twin, "layout", layout)
    with pytest.raises(sinks.PublishConflict):
        twin.compact()
    assert stats(store.read()) == {"A": 2, "B": 1, "C": 1}


def feed_of(spark, path):
    return spark.readStream.schema(STATUS).parquet(f"{path}/wave=*")


def test_overlap_under_two_checkpoints(spark, tmp_path):
    """A new checkpoint reads everything again; rows of both are there once."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    runs = [(("A", 1, 1, 0), ("B", 1, 1, 5)), (("B", 1, 1, 5), ("C", 1, 2, 30)), (("C", 1, 2, 30), ("D", 1, 2, 40))]
    for number, wave in enumerate(runs):
        rows_of(spark, *wave).write.parquet(f"{source}/wave={number}")
        checkpoint = str(tmp_path / ("old" if number < 2 else "new"))
        status.run_without_overlap(feed_of(spark, source), out, checkpoint).awaitTermination()
    rows = status.overlap_log(spark, out).read().collect()
    assert sorted(r["statid"] for r in rows) == ["A", "B", "C", "D"]


def test_overlap_of_streams_at_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows_of(spark, ("A", 1, 1, 0), ("B", 1, 1, 5)).write.parquet(f"{source}/wave=0")
    run = lambda name: lambda: status.run_without_overlap(feed_of(spark, source), out, str(tmp_path / name)).awaitTermination()
    assert together(run("x"), run("y")) == [None, None]
    assert sorted(r["statid"] for r in status.overlap_log(spark, out).read().collect()) == ["A", "B"]


def test_latest_state_under_a_new_checkpoint(spark, tmp_path):
    log = sinks.DeltaLog(spark, str(tmp_path / "log"), STATUS)
    for number, wave in enumerate([(("A", 1, 1, 1),), (("A", 1, 2, 2),), (("A", 1, 3, 3), ("B", 1, 1, 1))]):
        rows_of(spark, *wave).write.parquet(str(tmp_path / "in" / f"wave={number}"))
        checkpoint = str(tmp_path / ("old" if number < 2 else "new"))
        state = status.latest_state(feed_of(spark, str(tmp_path / "in"))).select(*STATUS.names)
        status.run_to_log(state, log, checkpoint, "update").awaitTermination()
    assert stats(status.latest_state(log.read())) == {"A": 3, "B": 1}


def test_no_table_of_rejected_rows_without_any(spark, tmp_path):
    store = small_store(spark, tmp_path)
    store.merge_batch(rows_of(spark, ("A", 1, 2, 1)), 0)
    assert not (tmp_path / "store" / "rejected").exists() and store.rejected().count() == 0
    store.merge_batch(rows_of(spark, ("A", 1, 2, 1), (None, 1, 2, 1)), 1)
    assert store.rejected().count() == 1


def test_a_damaged_entry_is_no_missing_table(spark, tmp_path):
    (tmp_path / "t" / "versions").mkdir(parents=True)
    (tmp_path / "t" / "versions" / "000000000001.json").write_text("not json")
    with pytest.raises(ValueError):
        sinks.VersionedTable(spark, str(tmp_path / "t")).ensure(spark.range(1))


COUNTED = "statid string, chgerid int, addcd string, stat int, statupddt timestamp_ntz, lasttedt timestamp_ntz, nowtsdt timestamp_ntz"


def test_counts_follow_the_log(spark, tmp_path):
    """Signed changes of the touched parts give what counting everyone gives, through waves, compactions
    and a rebuild; a wave reads no other part."""
    rng = random.Random(5)
    rows = [(f"S{i}", 1, rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), None, None, None) for i in range(200)]
    store = status.StatusStore(spark, str(tmp_path / "s"), parts=32)
    snapshot = store.tables[status.SNAPSHOT]
    snapshot.publish(spark.createDataFrame(rows, COUNTED))
    store.ensure_tables(0.0)
    counts = lambda: {r["addcd"]: r["n"] for r in store.available_codes().collect()}
    full = lambda: {r["addcd"]: r["n"] for r in regions.available_by_code(store.read()).collect()}
    assert counts() == full()
    for batch in range(5):
        wave = [(f"S{rng.randrange(220)}", 1, rng.choice([1, 2]), batch) for _ in range(6)]
        store.merge_batch(rows_of(spark, *wave), batch)
        moved = store.available_codes()
        used = {f.split("_part=")[1].split("/")[0] for f in moved.inputFiles() if "/snapshot/" in f and "_part=" in f}
        assert len(used) <= 6 * (batch % 2 + 1), "only parts that the log touches are read"
        assert counts() == full()
        if batch % 2:
            store.compact()
            assert store.counts.last()[1] == snapshot.last()[0] and counts() == full()
    store.begin_rebuild()
    store.finish_rebuild(spark.createDataFrame(rows[:150], COUNTED))
    assert counts() == full()
