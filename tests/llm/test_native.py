"""Mixing, sharding and the URL filter."""

import random
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from voltmesh.llm import mixing, sharding, urls
from voltmesh.operators import skew


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin Inner") if w in plan]


# ---- mixing -----------------------------------------------------------------


def test_distribution_is_poisson(spark):
    import math

    rows = spark.createDataFrame([(0.0,), (0.3,), (8.0,)], "rate double")
    for r in rows.select("rate", mixing.distribution(F.col("rate")).alias("p")).collect():
        p, total = math.exp(-r["rate"]), 0.0
        for k, got in enumerate(r["p"]):
            total += p
            assert abs(got - total) < 1e-12
            p *= r["rate"] / (k + 1)
        assert 1 - r["p"][-1] < 2**-50


def test_mixing_reaches_the_weights(spark):
    rng = random.Random(3)
    rows = [(i, "w" * rng.randint(50, 150), "big" if i % 3 else "small") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    out = mixing.mix(docs, weights, total=1_000_000)
    assert not python_nodes(out)
    sizes = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert abs(sizes["big"] / 250_000 - 1) < 0.06 and abs(sizes["small"] / 750_000 - 1) < 0.06
    found = out.collect()
    counts = Counter(r["doc_id"] for r in found)
    assert all({r["copy"] for r in found if r["doc_id"] == d} == set(range(counts[d])) for d in list(counts)[:20])
    assert [r["mix_key"] for r in found] == sorted(r["mix_key"] for r in found)
    small = [r["source"] == "small" for r in found]
    half = len(small) // 2
    assert abs(sum(small[:half]) / half - sum(small[half:]) / (len(small) - half)) < 0.05


def test_high_rates_are_sums_of_draws(spark):
    docs = spark.createDataFrame([(i, "x", "s") for i in range(300)], "doc_id long, text string, source string")
    out = mixing.mix(docs, total=300 * 40.0)
    counts = list(Counter(r["doc_id"] for r in out.collect()).values())
    mean = sum(counts) / 300
    assert abs(mean - 40) < 2 and 25 < sum((c - mean) ** 2 for c in counts) / 300 < 60


def test_mixing_joins_when_sources_are_many(spark, monkeypatch):
    docs = odd.docs(spark, clashes=False)
    one = sorted(map(repr, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(repr, mixing.mix(docs).collect())) == one


def test_mixing_odd_documents(spark):
    docs = odd.docs(spark)
    out = mixing.mix(docs, total=4_000_000)
    assert out.columns == [c for c in docs.columns if c not in ("copy", "mix_key")] + ["copy", "mix_key"]
    copies = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert copies[(2, None)] > 0 and copies[(6, "twice the same row")] % 2 == 0
    assert mixing.mix(odd.nothing(spark)).count() == 0
    none = spark.createDataFrame([], "source string, weight double")
    assert mixing.mix(docs, none).count() == 0


# ---- sharding ---------------------------------------------------------------


def test_a_new_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.shard_list(docs, [1.0] * 16).collect()
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows)
    moved = sum(r["grown_shard"] == 16 for r in rows)
    assert abs(moved / 5000 - 1 / 17) < 0.015
    again = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, [1.0] * 17).collect()}
    assert again == {r["doc_id"]: r["grown_shard"] for r in rows}
    slots = Counter(r["shard"] for r in rows)
    for shard, count in slots.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(count))


def test_shards_follow_their_weights(spark):
    docs = spark.range(8000).select(F.col("id").alias("doc_id"))
    counts = Counter(r["shard"] for r in sharding.assign(docs, [1.0, 2.0, 5.0]).collect())
    assert [abs(counts[i] / 8000 - w / 8) < 0.02 for i, w in enumerate((1, 2, 5))] == [True] * 3
    with pytest.raises(ValueError):
        sharding.assign(docs, [1.0, 0.0])


def test_sharding_odd_documents(spark):
    docs = odd.docs(spark)
    out = sharding.shard_list(docs, [1.0] * 4)
    assert not python_nodes(out)
    rows = out.collect()
    assert len(rows) == len(odd.TEXTS)
    want = Counter((i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t, _, _ in odd.TEXTS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    for shard in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))
    assert len({r["shard"] for r in rows if r["doc_id"] == 6}) == 1
    assert sharding.assign(docs, [1.0] * 4).columns[-1] == "shard"
    assert sharding.shard_list(odd.nothing(spark), [1.0]).count() == 0


def test_shards_read_by_any_columns(spark, tmp_path):
    """Whatever columns of a landed table are read, the plan holds; one id in a third of the rows is cut."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    )
    rows.repartition(5).write.parquet(str(tmp_path / "docs"))
    out = sharding.shard_list(spark.read.parquet(str(tmp_path / "docs")), [1.0] * 16)
    whole = sorted((r["shard"], r["slot"]) for r in out.collect())
    assert out.count() == 3000
    assert sorted(map(tuple, out.select("shard", "slot").collect())) == whole
    assert sorted(r[0] for r in out.select("slot").collect()) == sorted(s for _, s in whole)
    assert sum(r["count"] for r in out.groupBy("shard").count().collect()) == 3000
    assert out.groupBy(F.spark_partition_id()).count().collect()
    assert out.select("law", "grown_shard").count() == 3000 and out.filter("shard = 3").count() > 0


def test_a_hot_id_is_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 200)
    rows = spark.range(3000).select(F.lit(7).alias("doc_id"), F.col("id").cast("string").alias("text"))
    cuts = []
    real = skew.sliced
    monkeypatch.setattr(sharding, "sliced", lambda *a: cuts.append(real(*a)) or cuts[-1])
    out = sharding.shard_list(rows, [1.0] * 4).collect()
    assert sorted(r["slot"] for r in out) == list(range(3000))
    assert max(r["count"] for r in cuts[0].groupBy("_cut").count().collect()) < 1000


# ---- URLs -------------------------------------------------------------------

ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "https://example.net/en/", "x://net/", "x://net",
    "http://sub.example.com/de/?a=1&b=2#f", "http://badexample.com/de/x", "http://org/fr/", "ftp://a.org/fr",
    "a://b://c/d", "http://example.net:80/en/", "http://ÄB.org/fr/é?x", "http://h\n.org/fr/", "http://a.net?/en/",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    rest = rest[at:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fits, key=lambda r: len(r.text)) if fits else None


def test_rules_against_plain_python(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD_URLS)], "page_id long, url string, host string")
    rows = urls.judge(df).collect()
    assert len(rows) == len(ODD_URLS)
    for r in rows:
        host, path, rule = plain(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.text)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == rule.verdict)


def spam(rng):
    good = rng.random() < 0.5
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    if good:
        return f"https://www.{word(6)}.example/{word(5)}/{word(7)}.html", 0.0
    digits = "".join(rng.choice("0123456789") for _ in range(8))
    query = "&".join(f"{word(2)}={rng.randint(0, 9999)}" for _ in range(4))
    return f"http://{word(4)}-{digits}.{word(5)}-{word(5)}.example/{digits}?{query}", 1.0


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(8)
    train = spark.createDataFrame([spam(rng) for _ in range(400)], "url string, label double")
    test = [(*spam(rng), i) for i in range(200)]
    df = spark.createDataFrame(test, "url string, truth double, page_id long")
    out = urls.judge(df, rules=(), labelled=train)
    assert not python_nodes(out)
    rows = out.collect()
    right = sum((r["verdict"] == "block") == (r["truth"] == 1.0) for r in rows)
    assert right >= 195


def test_urls_without_labels_or_rows(spark):
    df = spark.createDataFrame([("http://a.example/x",), (None,)], "url string")
    assert {r["verdict"] for r in urls.judge(df, rules=()).collect()} == {"allow"}
    block = spark.createDataFrame([("http://b.example/", 1.0)], "url string, label double")
    assert {r["verdict"] for r in urls.judge(df, rules=(), labelled=block).collect()} == {"block"}
    assert urls.judge(df.limit(0)).count() == 0


def test_many_suffixes_are_joined(spark, monkeypatch):
    df = spark.createDataFrame([(f"http://h{i}.net/{i}" if i % 2 else f"http://a.org/fr/{i}",) for i in range(60)], "url string")
    one = sorted(map(repr, urls.judge(df).select("url", "verdict").collect()))
    monkeypatch.setattr(urls, "BROADCAST_SUFFIXES", 0)
    assert sorted(map(repr, urls.judge(df).select("url", "verdict").collect())) == one


def test_repeats_of_one_url_leave_room_for_others(spark):
    """The sample is of different URLs, so copies neither fill it nor empty it."""
    pages = [(i, "http://a.example.com/de/hot") for i in range(3000)]
    pages += [(4000 + i, f"http://x{i}.example.net/en/{i}") for i in range(5)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    for train in (3, 1, 100):
        out = urls.judge(df, train_rows=train)
        assert out.count() == 3005
    labelled = spark.createDataFrame([("http://a.com/x", 1)] * 500 + [("http://b.org/y", 0)], "url string, label int")
    seen = []
    real = urls._without_itself
    urls._without_itself = lambda d: seen.append(d) or real(d)
    try:
        urls.judge(df, labelled=labelled).count()
    finally:
        urls._without_itself = real
    assert sorted((r["url"], r["label"]) for r in seen[0].collect()) == [("http://a.com/x", 1.0), ("http://b.org/y", 0.0)]


def test_a_label_is_not_among_what_explains_it(spark):
    rows = spark.createDataFrame(
        [("s", 1.0, 3.0, 10.0, 4.0), ("s", 0.0, 1.0, 10.0, 4.0)], "suffix string, label double, _copies double, _known double, _blocked double"
    )
    got = [r["suffix_block"] for r in urls._without_itself(rows).collect()]
    assert got == [pytest.approx((4 - 3 + 1) / (10 - 3 + 2)), pytest.approx((4 + 1) / (10 - 1 + 2))]
