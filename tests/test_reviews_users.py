import datetime as dt

from pyspark.sql import functions as F

from voltmesh.operators import filters, reviews, user_lists, users
from voltmesh.schemas import REVIEW

T0 = dt.datetime(2024, 1, 1)


def review(no, who, stid, rid, level="1", text="t", reply=None):
    return (no, who, f"A{who}", f"N{who}", stid, rid, text, f"P{no}" if reply else None, reply, level,
            T0 + dt.timedelta(minutes=no))


def table(spark, rows):
    return spark.createDataFrame(rows, REVIEW)


def test_pages_join_up_to_the_whole_list(spark):
    rows = [review(i * 3 + 1, i % 4, "CV000754", f"R{i}") for i in range(37)]
    df = table(spark, rows)
    seen, last = [r["no"] for r in reviews.newest_reviews(df).orderBy("pos").collect()], None
    while True:
        last = seen[-1]
        cursor = spark.createDataFrame([("CV000754", last)], "stid string, last bigint")
        page = [r["no"] for r in reviews.keyset_page(cursor, df).orderBy("pos").collect()]
        if not page:
            break
        seen += page
    assert seen == sorted((r[0] for r in rows), reverse=True)
    pages = reviews.review_pages(df).filter(F.col("page") == 2).orderBy("pos").collect()
    assert [r["no"] for r in pages] == seen[10:20]


def test_own_reviews_are_marked(spark):
    df = table(spark, [review(1, 1, "S", "R1"), review(2, 2, "S", "R2"), review(3, 2, "S", "R1", "2", reply="x")])
    asked = spark.createDataFrame([(1, "A1", "S")], "snsid bigint, appid string, stid string")
    rows = {r["no"]: (r["my"], r["n_replies"]) for r in reviews.review_page(asked, df).collect()}
    assert rows == {1: (1, 1), 2: (0, 0)}


def test_station_without_reviews(spark):
    df = table(spark, [review(1, 1, "S", "R1")])
    stations = spark.createDataFrame([("S",), ("T",)], "stid string")
    rows = {r["stid"]: (r["n"], r["review"]) for r in reviews.summary_for(stations, df).collect()}
    assert rows == {"S": (1, "t"), "T": (0, None)}


def test_delete(spark):
    df = table(spark, [review(1, 1, "S", "R1"), review(2, 1, "S", "R2"), review(3, 2, "S", "R1", "2", reply="x")])
    asked = df.filter(F.col("level") == "1").select(*reviews.REVIEW_KEY)
    left = {r["no"]: (r["nickname"], r["review"]) for r in reviews.delete_reviews(df, asked).collect()}
    assert left == {1: ("***", "삭제되었습니다."), 3: ("N2", "t")}
    wrong_owner = asked.withColumn("appid", F.lit("other"))
    assert reviews.delete_reviews(df, wrong_owner).count() == 3
    replies = df.filter(F.col("level") == "2").select(*reviews.REPLY_KEY)
    assert reviews.delete_replies(df, replies).count() == 2


def test_edit_needs_every_id(spark):
    df = table(spark, [review(1, 1, "S", "R1"), review(2, 2, "S", "R2")])
    asked = spark.createDataFrame(
        [(1, "A1", "S", "R1", "1", "nn", "new"), (2, "A1", "S", "R2", "1", "nn", "new")],
        "snsid bigint, appid string, stid string, reviewid string, level string, nickname string, review string",
    )
    rows = {r["no"]: r["review"] for r in reviews.edit(df, asked, reviews.REVIEW_KEY, "review").collect()}
    assert rows == {1: "new", 2: "t"}
    two = asked.filter("snsid = 1 and reviewid = 'R1'").withColumn("seq", F.lit(1))
    two = two.unionByName(two.withColumns({"seq": F.lit(2), "review": F.lit("newer")}))
    last = reviews.edit(df, two, reviews.REVIEW_KEY, "review", [F.col("seq").desc()])
    assert {r["no"]: r["review"] for r in last.collect()} == {1: "newer", 2: "t"}


USER = "sns string, snsid bigint, email string, name string, nickname string, appid string"


def test_sign_in(spark):
    known = spark.createDataFrame([("k", 1, "old", "old", "nick", "app")], USER)
    incoming = spark.createDataFrame(
        [("k", 1, "e1", "n1"), ("k", 2, "e2", "n2")], "sns string, snsid bigint, email string, name string"
    )
    rows = {r["snsid"]: r for r in users.upsert_users(known, incoming, "x").collect()}
    assert tuple(rows[1]) == ("k", 1, "e1", "n1", "nick", "app")
    assert tuple(rows[2])[:5] == ("k", 2, "e2", "n2", "n2") and len(rows[2]["appid"]) == 20
    twice = spark.createDataFrame(
        [("k", 3, "first", "zz", 1), ("k", 3, "second", "aa", 2)],
        "sns string, snsid bigint, email string, name string, seq int",
    )
    row = users.upsert_users(known, twice, "x", F.col("seq")).filter("snsid = 3").first()
    assert tuple(row)[2:5] == ("second", "aa", "zz")
    again = users.upsert_users(known, incoming, "x")
    answer = {r["snsid"]: r["appid"] for r in users.signed_in(again, incoming).collect()}
    assert answer == {1: "app", 2: rows[2]["appid"]}


def test_nickname(spark):
    known = spark.createDataFrame([("k", 1, "", "", "a", "A"), ("k", 2, "", "", "b", "B")], USER)
    asked = spark.createDataFrame(
        [(1, "A", "a"), (2, "B", "a")], "snsid bigint, appid string, nickname string"
    )
    got = {r["snsid"]: r["answer"] for r in users.nickname_answers(known, asked).collect()}
    assert got == {1: "1", 2: "a"}
    assert [r["snsid"] for r in users.taken_elsewhere(known, asked).collect()] == [2]
    names = {r["snsid"]: r["nickname"] for r in users.set_nicknames(known, asked).collect()}
    assert names == {1: "a", 2: "a"}


def test_authorised(spark):
    known = spark.createDataFrame([(1, "A"), (2, "B"), (2, "B")], "snsid bigint, appid string")
    asked = spark.createDataFrame([(1, "A"), (2, "B"), (1, "B")], "snsid bigint, appid string")
    assert [r["snsid"] for r in filters.authorised(asked, known).collect()] == [1]
    assert filters.authorised(asked, known, exactly_one=False).count() == 2


def test_list_contains_exact_and_raw(spark):
    known = spark.createDataFrame(
        [(1, "A", '[["x", "M3333"]]')], "snsid bigint, appid string, bookmark string"
    )
    asked = spark.createDataFrame(
        [(1, "A", "M333"), (1, "A", "M3333"), (2, "B", "M1")], "snsid bigint, appid string, item string"
    )
    got = {(r["snsid"], r["item"]): (r["exact"], r["raw"]) for r in filters.list_contains(asked, known, "bookmark", 1).collect()}
    assert got == {(1, "M333"): (0, 1), (1, "M3333"): (1, 1), (2, "M1"): (0, 0)}


def test_flags_default_to_zero(spark):
    known = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    flags = spark.createDataFrame([(1, "[0, 0, 0, 0, 1, 0]")], "user_id bigint, flags string")
    rows = {r["user_id"]: r["flags"] for r in user_lists.flags_or_zero(known, flags).collect()}
    assert rows == {1: "[0, 0, 0, 0, 1, 0]", 2: "[0, 0, 0, 0, 0, 0]"}


def test_search_terms_of_the_map(spark):
    regions = spark.createDataFrame(
        [("2", "경기도 수원시 권선구", 1.0, 1.0), ("1", "경기도 수원시 권선구 호매실동", 2.0, 2.0), ("3", "경기도 화성시", 3.0, 3.0)],
        "bcode string, arr string, lat double, lng double",
    )
    found = filters.regions_by_terms(regions, ["경기", "수원", "권선", "", ""])
    assert [r["lat"] for r in found.collect()] == [2.0, 1.0]
