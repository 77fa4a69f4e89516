"""The name index against LIKE over all names."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from voltmesh.functions.text import like_any
from voltmesh.operators import name_index

NAMES = ["서울역 광장", "서울 시청", "HOUSE 7", "HOUSEHOLD Customer#07", "a%b_c", "a\\b", "ab", "", "\U0001f600\U0001f600\U0001f600x", None]
TERMS = ["HOUSE", "HOUSE%7", "H_USE", "서울", "서울역", "울역 광", "", "%", "a\\%b", "\\_c", "ab", "usehold", "\U0001f600\U0001f600\U0001f600", "no such name"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(3)
    names = NAMES + ["".join(rng.choices("abc HOUSE", k=rng.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names * 2)], "id long, name string")
    out = name_index.NameIndex(spark, str(tmp_path_factory.mktemp("names")))
    out.write(df, "name")
    return out, df


@pytest.mark.parametrize("term", TERMS + ["abc", "HOU%SE", "c H", "b_H", "OUS%"])
def test_as_like(index, term):
    found, df = index
    want = df.filter(like_any(F.col("name"), F.lit(term)))
    rows = found.rows(df, "name", term)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r[0] for r in found.find(term).collect()) == sorted({r["name"] for r in want.collect()})


def test_only_the_folders_of_the_term_are_read(index):
    found, _ = index
    text = plan(found.find("HOUSE"), "formatted")
    buckets = {r[0] for g in name_index.required_grams("HOUSE") for r in found.spark.range(1).select(name_index._bucket(F.lit(g))).collect()}
    line = next(x for x in text.splitlines() if "PartitionFilters" in x)
    assert all(str(b) in line for b in buckets) and "bucket" in line and len(buckets) <= 3
    assert "PushedFilters: [IsNotNull" in text or "In(gram" in text
    assert name_index.required_grams("HO") == [] and name_index.required_grams("H_USE%X") == ["USE"]


def test_nothing(spark, tmp_path):
    empty = name_index.NameIndex(spark, str(tmp_path))
    empty.write(spark.createDataFrame([], "name string"), "name")
    assert empty.find("").count() == 0
