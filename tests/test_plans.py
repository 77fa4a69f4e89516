"""What the plans have to look like, and that a hot key is spread out."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from voltmesh.operators import filters, regions, reviews, spatial, user_lists
from voltmesh.plans.bindings import Bindings
from voltmesh.plans.catalogue import all_queries
from voltmesh.schemas import STATUS
from voltmesh.sinks.tables import VersionedTable
from voltmesh.streaming import status


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def snapshot(spark, folder, tmp_path_factory):
    table = VersionedTable(spark, str(tmp_path_factory.mktemp("snapshot")))
    table.publish(Bindings(spark, folder)["fx_charger"])
    return table.read()


def test_box_reaches_the_scan(snapshot):
    text = plan(filters.stations_in_box(snapshot, 38, 37, 127, 126), "formatted")
    assert "LessThanOrEqual(lat,38.0)" in text and "GreaterThanOrEqual(lng,126.0)" in text
    assert "ReadSchema: struct<statid:string,chgertype:int,lat:double,lng:double,stat:int>" in text
    assert "Exchange" not in text


def test_layout_by_place_keeps_a_box_in_few_files(spark, snapshot, tmp_path):
    table = VersionedTable(spark, str(tmp_path))
    # The sample is so small that adaptive execution would write it as one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.publish(spatial.by_place(snapshot))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = table.read()
    assert rows.count() == snapshot.count()
    files = rows.groupBy(F.input_file_name()).agg(F.min("lat").alias("low"), F.max("lat").alias("high"))
    assert files.count() >= 4
    assert files.filter((F.col("low") <= 33.5) & (F.col("high") >= 33.45)).count() == 1


def test_counts_read_two_columns_and_shuffle_codes_only(snapshot):
    text = plan(regions.available_by_code(snapshot), "formatted")
    assert "ReadSchema: struct<addcd:string,stat:int>" in text and "partial_count" in text
    assert "EqualTo(stat,2)" in text


LAZY = [
    name for name in all_queries()
    if not name.startswith(("stream_", "scan_", "rebuild", "replace", "ctas", "append", "chunked",
                            "ensure", "object", "spread"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, folder, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(all_queries()[name](spark, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Python" not in text and "SinglePartition" not in text


def test_pages_are_cut_before_the_shuffle(spark, folder):
    table = Bindings(spark, folder)["fx_review"]
    assert plan(reviews.newest_reviews(table)).count("WindowGroupLimit") == 2


def test_hot_pair_is_split_in_the_join(spark):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("user_id"),
        F.lit("add").alias("op"),
        F.lit("M1").alias("item"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("ts"),
        F.col("id").alias("event_id"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        entries = user_lists.bookmark_entries(rows.repartition(8))
        assert len(entries.collect()) == 40000
        assert "skew=true" in plan(entries)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def above(text, scan):
    """The operators on the way from the first scan, a join's left side, up to the root of a plan."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if line.strip() and depth(line) < level:
            out.append(line)
            level = depth(line)
    return "\n".join(out)


def test_a_minute_does_not_move_the_snapshot(spark, tmp_path, monkeypatch):
    """Readers and compactions update the snapshot's rows where they lie; a log that is not small is shuffled."""
    store = status.StatusStore(spark, str(tmp_path / "s"), parts=4)
    rows = [(f"S{i}", 1, 1, None, None, None) for i in range(100)]
    store.tables[status.SNAPSHOT].publish(spark.createDataFrame(rows, STATUS))
    store.ensure_tables(0.0)
    for batch in range(3):
        wave = [(f"S{i}", 1, 2 + batch, None, None, None) for i in range(batch, 100, 7)]
        store.merge_batch(spark.createDataFrame(wave, STATUS), batch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = store.read()
        assert "Exchange" not in above(plan(small), "FileScan")
        published = []
        monkeypatch.setattr(store.tables[status.SNAPSHOT], "publish", lambda df, *a, **k: published.append(df) or 2)
        store.compact()
        assert "Exchange" not in above(plan(published[0]), "FileScan")
        monkeypatch.setattr(status, "SMALL_LOG", 0)
        large = store.read()
        assert "Exchange" in above(plan(large), "FileScan")
        assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_waves_are_made_from_the_published_snapshot(spark, folder, monkeypatch):
    """The chargers come from the tables once, for the snapshot, not again for each wave."""
    read, merge = [], status.StatusStore.merge_batch

    def watched(self, rows, *args):
        read.append(rows.inputFiles())
        return merge(self, rows, *args)

    monkeypatch.setattr(status.StatusStore, "merge_batch", watched)
    all_queries()["available_by_region_after"](spark, folder)
    assert len(read) == 2 and all(read)
    assert all("/snapshot/data/" in file for files in read for file in files)
