"""Pages by marks against a plain sort of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from voltmesh.operators import page_marks
from voltmesh.sinks.ledger import PublishConflict

ROWS = "stid string, no bigint, review string"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture(scope="module")
def numbers():
    """A third of all rows at one station; quiet stations with numbers far apart."""
    rng = random.Random(5)
    taken = rng.sample(range(400_000), 3_000)
    return [("hot" if i < 1_000 else f"S{rng.randrange(40)}", n, f"r{n}") for i, n in enumerate(taken)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(page_marks, "SIZE", 16)
    monkeypatch.setattr(page_marks, "BUCKETS", 8)


def written(spark, path, rows, parts):
    marks = page_marks.PageMarks(spark, str(path), frame(spark, []).schema)
    for part in range(parts):
        marks.append(frame(spark, rows[part::parts]))
    return marks


def plain(rows, cursors, limit, newest_first):
    out = set()
    for stid, last in cursors:
        behind = [n for s, n, _ in rows if s == stid and (n < last if newest_first else n > last)]
        for pos, n in enumerate(sorted(behind, reverse=newest_first)[:limit], 1):
            out.add((stid, last, pos, n, f"r{n}"))
    return out


def asked(spark, cursors):
    return spark.createDataFrame(cursors, "stid string, last bigint")


def got(marks, cursors, limit, newest_first):
    page = marks.page(asked(marks.spark, cursors), limit, newest_first).collect()
    found = [(r["stid"], r["last"], r["pos"], r["no"], r["review"]) for r in page]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("newest_first", [True, False])
@pytest.mark.parametrize("limit", [3, 16, 50])
def test_as_a_sort_of_all_rows(spark, tmp_path, small, numbers, newest_first, limit):
    marks = written(spark, tmp_path, numbers, 2)
    own = [(s, n) for s, n, _ in numbers[::150]] + [("hot", 0), ("hot", 10**9), ("hot", -5), ("nobody", 7)]
    want = plain(numbers, own, limit, newest_first)
    assert got(marks, own, limit, newest_first) == want
    marks.merge()
    assert len(marks.runs()) == 1 and got(marks, own, limit, newest_first) == want


def test_many_cursors_go_without_names(spark, tmp_path, small, numbers, monkeypatch):
    monkeypatch.setattr(page_marks, "FEW", 2)
    marks = written(spark, tmp_path, numbers, 1)
    own = [(s, n) for s, n, _ in numbers[::40]]
    assert got(marks, own, 5, True) == plain(numbers, own, 5, True)


def test_a_cursor_reads_a_bounded_number_of_rows(spark, tmp_path, small, numbers):
    marks = written(spark, tmp_path, numbers, 2)
    cursors = asked(spark, [("hot", 200_000)])
    rows = marks.candidates(cursors)
    assert 10 <= rows.count() <= 2 * 2 * page_marks.SIZE  # two stretches of two runs, of 1,000 rows
    text = plan(rows, "formatted")
    line = next(x for x in text.splitlines() if "PartitionFilters" in x and "bucket" in x)
    assert "run" in line and ("EqualTo(stid,hot)" in text or "In(stid" in text) and "stretch" in text
    assert len(rows.inputFiles()) >= 1


def test_writers(spark, tmp_path, small, numbers):
    marks = written(spark, tmp_path, numbers[:60], 1)
    other = page_marks.PageMarks(spark, str(tmp_path), frame(spark, []).schema)

    def late(rows):
        other.append(frame(spark, numbers[60:90]))  # comes between the read and the entry
        return rows.filter("no % 2 = 0")

    with pytest.raises(PublishConflict):
        marks.rewrite(late)
    own = [("hot", 10**9)]
    assert got(marks, own, 100, True) == plain(numbers[:90], own, 100, True)
    marks.rewrite(lambda rows: rows.filter(F.col("no") % 2 == 0))
    marks.prune()
    even = [r for r in numbers[:90] if r[1] % 2 == 0]
    assert got(marks, own, 100, True) == plain(even, own, 100, True)


def test_nothing(spark, tmp_path, small):
    marks = page_marks.PageMarks(spark, str(tmp_path), frame(spark, []).schema)
    assert got(marks, [("hot", 5)], 10, True) == set()
    marks.append(frame(spark, [("hot", None, "x"), (None, 3, "r3")]))
    assert got(marks, [("hot", 5)], 10, True) == set()
    marks.append(frame(spark, []))
    assert marks.page(asked(spark, [])).count() == 0
