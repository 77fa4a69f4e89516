"""Snapshots in buckets: merges that do not move the snapshot's rows."""

import datetime as dt

import pytest
from pyspark.sql import DataFrame, functions as F

from tests.test_plans import plan
from voltmesh.schemas import KEYS, STATUS, STATUS_COLUMNS
from voltmesh.sinks.tables import VersionedTable
from voltmesh.streaming import status

T0 = dt.datetime(2024, 1, 1)


def chargers(spark, count, stat=1, step=1):
    """A third of all at one station."""
    rows = [(f"S{i % 50}" if i % 3 else "hot", i, stat, T0 + dt.timedelta(minutes=stat), None, None)
            for i in range(0, count, step)]
    return spark.createDataFrame(rows, STATUS)


def of(df):
    return {(r["statid"], r["chgerid"]): r["stat"] for r in df.collect()}


def store(spark, path, **options):
    out = status.StatusStore(spark, str(path / "it's"), parts=4, buckets=6, **options)
    out.tables[status.SNAPSHOT].publish(chargers(spark, 600))
    out.ensure_tables(0.0)
    return out


def above_the_scans(df: DataFrame, parts: int) -> list[str]:
    """Lines of the plan on the snapshot's side: from each scan of a part up to its join, and from the joins up."""
    lines = plan(df).splitlines()
    joins = [i for i, x in enumerate(lines) if "SortMergeJoin" in x or "ShuffledHashJoin" in x]
    scans = [i for i, x in enumerate(lines) if "Bucketed: true" in x]
    assert len(joins) == len(scans) == parts and all(j < s for j, s in zip(joins, scans))
    return lines[: joins[0]] + [x for j, s in zip(joins, scans) for x in lines[j:s]]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_log_meets_the_snapshot_where_it_lies(spark, tmp_path, no_broadcast):
    own = store(spark, tmp_path, small_log=0)
    own.merge_batch(chargers(spark, 600, 2, 7), 0)
    found = own.read()
    parts = len(own.tables[status.SNAPSHOT].aligned_parts())
    assert parts > 1 and not [x for x in above_the_scans(found, parts) if "Exchange" in x]
    want = of(chargers(spark, 600)) | of(chargers(spark, 600, 2, 7))
    assert of(found) == want
    published = []
    publish = VersionedTable.publish
    table = own.tables[status.SNAPSHOT]
    table.publish = lambda rows, *a, **k: (published.append((rows, k)), publish(table, rows, *a, **k))[1]
    own.compact()
    (rows, options), = published
    assert options["aligned"] and not [x for x in above_the_scans(rows, parts) if "Exchange" in x]
    assert of(own.read()) == want and own.log.read(own.tables[status.SNAPSHOT].last()[1]).isEmpty()


@pytest.mark.parametrize("small_log", [0, status.SMALL_LOG])
def test_waves_and_compactions(spark, tmp_path, small_log):
    own = store(spark, tmp_path, small_log=small_log)
    want = of(chargers(spark, 600))
    for batch, (stat, step) in enumerate([(2, 7), (3, 11), (4, 50)]):
        delta = chargers(spark, 900, stat, step).filter("statid = 'hot' or chgerid < 200")
        own.merge_batch(delta, batch)
        want |= {k: v for k, v in of(delta).items() if k in want}
        assert of(own.read()) == want
        if batch:
            own.compact()
            assert of(own.read()) == want
    parts = own.tables[status.SNAPSHOT].aligned_parts()
    files = [f for _, rows in parts for f in rows.inputFiles()]
    assert parts and all(f.split("/")[-3].endswith("-b6") for f in files) and len(files) <= len(parts) * 6


def test_parts_of_other_writes_are_read_as_before(spark, tmp_path):
    plain = VersionedTable(spark, str(tmp_path), 4, "statid")
    plain.publish(chargers(spark, 300))
    table = VersionedTable(spark, str(tmp_path), 4, "statid", 6, KEYS)
    assert table.aligned_parts() == []
    first = sorted(p for p in table.folders() if p >= 0)[:1]
    table.publish(table.read(only=first), only=first)
    assert table.aligned_parts() == [] and of(table.read()) == of(chargers(spark, 300))
    ((part, rows),) = table.aligned_parts(first)
    text = plan(rows.groupBy(*KEYS).count())
    assert part == first[0] and "Bucketed: true" in text and "Exchange" not in text
    assert of(rows) == of(table.read(only=first))
    table.publish(chargers(spark, 0))
    assert table.aligned_parts() == [] and table.read().columns == [*KEYS, *STATUS_COLUMNS]
