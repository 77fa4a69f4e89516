import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.test_lists import SCHEMA, commands
from tests.test_merges import as_dict, random_rows, table
from voltmesh.operators import merges, user_lists
from voltmesh.schemas import CHARGER_FEED, CHARGER_FEED_V1
from voltmesh.sinks import tables as sinks
from voltmesh.sources import feeds, tables
from voltmesh.streaming import commands as lists
from voltmesh.streaming import status

PAGE = """<response><header><totalCount>2</totalCount></header><body><items>
<item><statNm>서울역 &amp; 광장</statNm><statId>ME000001</statId><chgerId>01</chgerId><lat>37.5</lat>
<lng>bad</lng><stat>2</stat><statUpdDt>20240102030405</statUpdDt><lastTedt></lastTedt><note></note></item>
<item><statNm>b</statNm><statId>ME000002</statId><chgerId>2</chgerId><powerType>급속</powerType></item>
</items></body></response>"""


def test_feed_page(spark, tmp_path):
    (tmp_path / "page1.xml").write_text(PAGE, "utf-8")
    rows = feeds.read_pages(spark, str(tmp_path)).orderBy("statid").collect()
    first = rows[0].asDict()
    assert list(first) == CHARGER_FEED.names and len(rows) == 2
    assert first["statnm"] == "서울역 & 광장" and first["chgerid"] == 1 and first["lat"] == 37.5
    assert first["lng"] is None and first["lasttedt"] is None and first["stat"] == 2
    assert first["statupddt"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    older = feeds.read_pages(spark, str(tmp_path), CHARGER_FEED_V1).orderBy("statid").collect()
    assert older[1]["powertype"] == "급속" and "location" not in older[1].asDict()


@pytest.mark.parametrize("schema", [CHARGER_FEED, CHARGER_FEED_V1])
def test_landed_pages_are_smaller_than_their_values(spark, tmp_path, schema):
    text = lambda f: F.concat(F.lit("P"), F.col("id") % 5).alias(f.name)
    value = lambda f: text(f) if f.dataType.typeName() == "string" else F.lit(None).cast(f.dataType).alias(f.name)
    rows = spark.range(3000).select(
        *[F.col("id").cast(f.dataType).alias(f.name) if f.name in ("statid", "chgerid") else value(f) for f in schema.fields]
    )
    feeds.write_pages(rows.coalesce(2), str(tmp_path / "pages"))
    landed = sum(p.stat().st_size for p in (tmp_path / "pages").glob("part-*"))
    assert landed < sum(len(str(v)) for r in rows.collect() for v in r if v is not None)
    read = feeds.read_pages(spark, str(tmp_path / "pages"), schema)
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    streamed = feeds.stream_pages(spark, str(tmp_path / "pages"), schema)
    query = streamed.writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("landed").count() == 3000


def test_missing_pages(spark):
    totals = spark.createDataFrame([(30000,)], "total bigint")
    landed = spark.createDataFrame([(1,), (3,)], "page bigint")
    assert sorted(r["page"] for r in feeds.missing_pages(totals, landed).collect()) == [2, 4]


def test_published_versions(spark, tmp_path):
    table_ = sinks.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table_.read()
    table_.publish(spark.range(10), max_rows_per_file=3)
    before = table_.read()
    table_.publish(before.filter("id > 4"), upto=7)
    assert table_.last() == (2, 7) and table_.read().count() == 5
    assert before.count() == 10, "a reader keeps the version it opened"
    assert not table_.ensure(spark.range(1))


def test_object_inventory(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.png").write_bytes(b"123")
    (tmp_path / "y.png").write_bytes(b"1")
    rows = tables.object_inventory(spark, str(tmp_path)).collect()
    assert sorted((r["name"], r["length"]) for r in rows) == [("a/x.png", 3), ("y.png", 1)]


def waves(spark, rng, n=10):
    return [table(spark, random_rows(rng, 12, 10 * i)) for i in range(n)]


@pytest.mark.parametrize("per_batch", [1, 4, 10])
def test_feed_in_any_number_of_batches(spark, tmp_path, per_batch):
    import random

    rng = random.Random(11)
    base = table(spark, random_rows(rng, 20, 0))
    rows = waves(spark, rng)
    want = base
    for wave in rows:
        want = merges.merge_status(want, wave)
    store = status.StatusStore(spark, str(tmp_path / "store"))
    store.tables[status.SNAPSHOT].publish(base)
    store.ensure_tables(5.0)
    assert store.control() == (1, 5.0)
    batch = 0
    for i in range(0, 10, per_batch):
        together = rows[i]
        for wave in rows[i + 1 : i + per_batch]:
            together = together.unionByName(wave)
        store.merge_batch(together, batch)
        store.merge_batch(together, batch)  # a repeated batch changes nothing
        batch += 1
        if i == 4:
            store.compact()
    pick = lambda df: {k: v[:2] for k, v in as_dict(df).items()}
    assert pick(store.read()) == pick(want)


@pytest.mark.parametrize("files", ["1", "2", "5"])
def test_landed_files_through_the_stream(spark, tmp_path, files):
    import random
    import time

    rng = random.Random(13)
    base = table(spark, random_rows(rng, 20, 0))
    store = status.StatusStore(spark, str(tmp_path / "store"))
    store.tables[status.SNAPSHOT].publish(base)
    store.ensure_tables(0.0)
    want = base
    for number, wave in enumerate(waves(spark, rng, 5)):
        want = merges.merge_status(want, wave)
        feeds.write_pages(wave.coalesce(1), str(tmp_path / "pages" / f"wave={number}"))
        time.sleep(0.01)  # files are taken in the order of their times
    feed = feeds.stream_pages(spark, str(tmp_path / "pages" / "*"), maxFilesPerTrigger=files)
    status.run_feed(store, feed, str(tmp_path / "checkpoint")).awaitTermination()
    pick = lambda df: {k: v[:2] for k, v in as_dict(df).items()}
    assert pick(store.read()) == pick(want)


def test_rebuild_while_the_feed_goes_on(spark, tmp_path):
    import random

    rng = random.Random(12)
    old, rebuilt = table(spark, random_rows(rng, 20, 0)), table(spark, random_rows(rng, 20, 1))
    rows = waves(spark, rng, 5)
    store = status.StatusStore(spark, str(tmp_path / "store"))
    store.tables[status.SNAPSHOT].publish(old)
    store.ensure_tables(0.0)
    store.merge_batch(rows[0], 0)
    store.begin_rebuild()
    assert store.control()[0] == 0
    store.merge_batch(rows[1], 1)
    store.merge_batch(rows[2], 2)
    during = store.read()
    assert as_dict(during) == as_dict(merges.merge_status(old, rows[0]))
    store.finish_rebuild(rebuilt, started=9.0)
    assert store.control() == (1, 9.0)
    store.merge_batch(rows[3], 3)
    buffer = merges.upsert_status(merges.upsert_status(table(spark, []), rows[1]), rows[2])
    want = merges.merge_status(merges.replay_buffer(rebuilt, buffer), rows[3])
    assert as_dict(store.read()) == as_dict(want)
    store.begin_rebuild()
    assert store.read(status.BUFFER).count() == 0


def rows_of(spark, *rows):
    return table(spark, [(s, c, stat, at, 0, 0) for s, c, stat, at in rows])


def small_store(spark, tmp_path, **options):
    store = status.StatusStore(spark, str(tmp_path / "store"), **options)
    store.tables[status.SNAPSHOT].publish(rows_of(spark, ("A", 1, 1, 0), ("B", 1, 1, 0), ("C", 1, 1, 0)))
    store.ensure_tables(0.0)
    return store


def stats(df):
    return {r["statid"]: r["stat"] for r in df.collect()}


def test_a_new_stream_goes_on_behind_the_old_one(spark, tmp_path):
    store = small_store(spark, tmp_path)
    store.merge_batch(rows_of(spark, ("A", 1, 2, 1)), 0, "one")
    store.merge_batch(rows_of(spark, ("A", 1, 3, 2)), 1, "one")
    store.compact()
    store.merge_batch(rows_of(spark, ("A", 1, 9, 3)), 0, "two", at=77.0)
    assert stats(store.read()) == {"A": 9, "B": 1, "C": 1}
    assert store.control() == (1, 77.0)
    store.compact()
    store.merge_batch(rows_of(spark, ("A", 1, 9, 3)), 0, "two")
    assert store.log.last() == 2 and stats(store.read())["A"] == 9


def test_each_checkpoint_is_a_run(spark, tmp_path):
    store = small_store(spark, tmp_path)
    for number, stat in enumerate([5, 6]):
        pages = str(tmp_path / f"pages{number}")
        feeds.write_pages(rows_of(spark, ("B", 1, stat, 10 + number)), pages)
        feed = feeds.stream_pages(spark, pages)
        status.run_feed(store, feed, str(tmp_path / f"checkpoint{number}"), at=1.0).awaitTermination()
        store.compact()
    assert stats(store.read())["B"] == 6


def test_a_failed_rebuild_loses_nothing(spark, tmp_path):
    store = small_store(spark, tmp_path)
    store.begin_rebuild()
    store.merge_batch(rows_of(spark, ("A", 1, 5, 5)), 0)
    rebuilt = rows_of(spark, ("A", 1, 1, 0), ("D", 1, 1, 0))

    def fail(rows):
        raise OSError("disk full")

    store.layout = fail
    with pytest.raises(OSError):
        store.finish_rebuild(rebuilt)
    assert store.control()[0] == 0 and stats(store.read())["A"] == 1
    assert stats(store.read(status.BUFFER)) == {"A": 5}
    store.layout = lambda rows: rows
    store.finish_rebuild(rebuilt)
    assert store.control()[0] == 1 and stats(store.read()) == {"A": 5, "D": 1}


def test_a_minute_between_the_steps_of_a_rebuild(spark, tmp_path, monkeypatch):
    store = small_store(spark, tmp_path)
    store.begin_rebuild()
    store.merge_batch(rows_of(spark, ("A", 1, 5, 5)), 0)
    change = store.set_control

    def late(ck=None, at=None, mark=None):
        if ck == 1:
            store.merge_batch(rows_of(spark, ("B", 1, 7, 6)), 1)
        change(ck, at, mark)

    monkeypatch.setattr(store, "set_control", late)
    store.finish_rebuild(rows_of(spark, ("A", 1, 1, 0), ("B", 1, 1, 0)))
    assert stats(store.read()) == {"A": 5, "B": 7}


def test_buffer_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(status, "COMPACT_EVERY", 2)
    store = small_store(spark, tmp_path)
    store.begin_rebuild()
    for batch in range(6):
        store.merge_batch(rows_of(spark, ("A", 1, batch, batch), ("E", 1, batch, batch)), batch)
    buffer = store.tables[status.BUFFER]
    assert store.log.read(buffer.last()[1]).select("seq").distinct().count() < 2
    assert stats(store.read(status.BUFFER)) == {"A": 5, "E": 5} and stats(store.read())["A"] == 1


def test_only_touched_parts_are_rewritten_and_old_files_go(spark, tmp_path):
    store = small_store(spark, tmp_path, parts=8)
    snapshot = store.tables[status.SNAPSHOT]
    folders = lambda: {part: folder for part, folder in snapshot.folders().items() if part >= 0}
    first = folders()
    for batch in range(4):
        store.merge_batch(rows_of(spark, ("A", 1, batch + 2, batch + 2)), batch)
        store.compact()
    changed = {part for part, folder in folders().items() if first.get(part) != folder}
    part_a = store.read().filter("statid = 'A'").select(snapshot.part_of()).first()[0]
    assert changed == {part_a} and stats(store.read()) == {"A": 5, "B": 1, "C": 1}
    last = snapshot.last()[0]
    needed = {f.split("/")[1] for n in range(last - sinks.KEEP_VERSIONS + 1, last + 1) for f in snapshot.folders(n).values()}
    assert {p.name for p in (tmp_path / "store" / "snapshot" / "data").iterdir()} == needed
    assert len(list((tmp_path / "store" / "log" / "deltas").glob("part=*"))) <= 2


GOOD = "<response><items><item><statId>A</statId><chgerId>1</chgerId><stat>2</stat></item></items></response>"
BROKEN = "<response><items><item><statId>B</statId><chgerId>1</chgerId><stat>3</chgerId></item></items></response>"
NO_KEY = GOOD.replace(">A<", ">C<").replace(">1<", ">x<")


def test_damaged_items_are_kept_aside(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    for name, page in (("a", GOOD), ("b", BROKEN), ("c", NO_KEY)):
        (tmp_path / "pages" / f"{name}.xml").write_text(page, "utf-8")
    good = feeds.read_pages(spark, str(tmp_path / "pages")).collect()
    bad = feeds.rejected_items(spark, str(tmp_path / "pages")).collect()
    assert [r["statid"] for r in good] == ["A"]
    assert len(bad) == 2 and sorted("<stat>3" in r["source"] for r in bad) == [False, True]
    assert any('"x"' in r["source"] for r in bad)
    store = small_store(spark, tmp_path)
    feed = feeds.stream_pages(spark, str(tmp_path / "pages"))
    status.run_feed(store, feed, str(tmp_path / "checkpoint")).awaitTermination()
    assert stats(store.read())["A"] == 2
    assert sorted("<stat>3" in r["source"] for r in store.rejected().collect()) == [False, True]


def test_late_rows_are_not_dropped(spark, tmp_path):
    waves_ = [
        rows_of(spark, ("A", 1, 1, 0), ("A", 1, 1, 0)),
        rows_of(spark, ("A", 1, 1, 0), ("A", 1, 2, 30)),
        rows_of(spark, ("A", 1, 2, 30), ("B", 1, 1, -2000), ("B", 1, 4, None)),
    ]
    for number, wave in enumerate(waves_):
        wave.write.parquet(str(tmp_path / "in" / f"wave={number}"))
        feed = spark.readStream.schema(wave.schema).parquet(str(tmp_path / "in" / "wave=*"))
        status.run_without_overlap(feed, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = status.overlap_log(spark, str(tmp_path / "out")).read().collect()
    assert sorted((r["statid"], r["stat"]) for r in rows) == [("A", 1), ("A", 2), ("B", 1), ("B", 4)]


def test_object_inventory_with_a_scheme(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"1")
    rows = tables.object_inventory(spark, f"file://{tmp_path}/").collect()
    assert [r["name"] for r in rows] == ["a.txt"]


def test_commands_in_batches_with_compaction(spark, tmp_path):
    log = commands(21, 400)
    fold = lambda log: user_lists.bookmark_entries(log, "name")
    store = lists.ListStore(spark, str(tmp_path / "l"), fold)
    for batch in range(4):
        part = spark.createDataFrame(log[batch * 100 : batch * 100 + 100], SCHEMA)
        store.add_batch(part, batch)
        if batch in (0, 2):
            store.compact()
    whole = user_lists.bookmark_entries(spark.createDataFrame(log, SCHEMA))
    key = lambda df: sorted((r["user_id"], r["item"], r["event_id"]) for r in df.collect())
    assert key(store.read()) == key(whole)
