"""Codes, ranges and box searches on the curve against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from voltmesh.operators import curve
from voltmesh.sinks.tables import VersionedTable

PLACES = "id long, lat double, lng double"


def plain_code(lat, lng):
    y, x = curve._step_of(lat, *curve._LAT), curve._step_of(lng, *curve._LNG)
    return int("".join(a + b for a, b in zip(f"{y:020b}", f"{x:020b}")), 2)


@pytest.fixture(scope="module")
def places(spark):
    rng = random.Random(9)
    rows = [(rng.uniform(33, 39), rng.uniform(124, 131)) for _ in range(2_000)]
    rows += [(37.5, 127.0)] * 1_000  # a third on one place
    rows += [(90.0, 180.0), (-90.0, -180.0), (95.0, 200.0), (0.0, 0.0), (None, 127.0), (37.0, None), (float("nan"), 127.0)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PLACES)


BOXES = [(37.6, 35.3, 128.7, 126.4), (37.5, 37.5, 127.0, 127.0), (37.50001, 37.49, 127.02, 126.99), (39, 33, 131, 124),
         (90, -90, 180, -180), (100, 80, 300, 170), (35, 36, 127, 126), (0.0, 0.0, 0.0, 0.0)]


def test_codes(places):
    rows = places.filter("lat is not null and lng is not null and not isnan(lat)")
    for r in rows.select("lat", "lng", curve.code(F.col("lat"), F.col("lng")).alias("c")).limit(3_100).collect()[::7]:
        assert r["c"] == plain_code(r["lat"], r["lng"])


@pytest.mark.parametrize("most", [4, 32, 500])
def test_ranges_hold_the_box_and_little_else(most):
    rng = random.Random(most)
    for top, bottom, right, left in BOXES:
        found = curve.code_ranges(top, bottom, right, left, most)
        assert len(found) <= most and all(a <= b for a, b in found)
        assert all(x[1] + 1 < y[0] for x, y in zip(found, found[1:]))
        if bottom > top:
            assert found == []
            continue
        for _ in range(300):
            at = plain_code(rng.uniform(bottom, top), rng.uniform(left, right))
            assert any(a <= at <= b for a, b in found)
    steps = lambda most: sum(b - a + 1 for a, b in curve.code_ranges(*BOXES[0], most))
    own = (37.6 - 35.3) * curve._LAT[1] * (128.7 - 126.4) * curve._LNG[1]
    assert steps(500) < 1.1 * own and steps(32) < 1.5 * own


@pytest.mark.parametrize("box", BOXES)
def test_boxes(spark, places, tmp_path, box):
    top, bottom, right, left = box
    want = places.filter(F.col("lat").between(bottom, top) & F.col("lng").between(left, right))
    found = curve.in_box(curve.by_curve(places), *box)
    assert found.columns == places.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_ranges_reach_the_scan(spark, places, tmp_path):
    table = VersionedTable(spark, str(tmp_path))
    table.publish(curve.by_curve(places))
    text = plan(curve.in_box(table.read(), *BOXES[2]).select("id"), "formatted")
    assert "Exchange" not in text and "GreaterThanOrEqual(place," in text


def test_a_box_meets_fewer_files_than_bands(spark, tmp_path):
    """Files in which the curve has the box, against those in which bands of latitude have it."""
    from voltmesh.operators import spatial

    rng = random.Random(2)
    rows = [(f"S{i}", "01", rng.uniform(33, 39), rng.uniform(124, 131)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "statid string, chgerid string, lat double, lng double")
    box = (36.6, 35.6, 127.5, 126.5)
    top, bottom, right, left = box
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        curve.by_curve(df).write.parquet(f"{tmp_path}/curve")
        spatial.by_place(df).write.parquet(f"{tmp_path}/bands")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    def spans(kind, *columns):
        ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
        return spark.read.parquet(f"{tmp_path}/{kind}").groupBy(F.input_file_name()).agg(*ends).collect()

    ranges = curve.code_ranges(*box)
    along = [s for s in spans("curve", "place") if any(s["low_place"] <= b and a <= s["high_place"] for a, b in ranges)]
    bands = [
        s for s in spans("bands", "lat", "lng")
        if s["low_lat"] <= top and s["high_lat"] >= bottom and s["low_lng"] <= right and s["high_lng"] >= left
    ]
    assert len(along) <= 8 < len(bands)
