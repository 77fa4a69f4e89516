"""Reviews and replies of stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import REMOVED_NICKNAME, REMOVED_TEXT
from .merges import keyed_update
from .skew import join_apart, ranked, running_sums, top_per_key

REVIEW, REPLY = "1", "2"
PAGE = 10

# Review numbers are unique, so a slice of this many numbers holds no more rows.
NUMBERS_PER_SLICE = 65536

REVIEW_KEY = ["snsid", "appid", "stid", "reviewid", "level"]
REPLY_KEY = ["snsid", "appid", "stid", "reviewid", "replyid", "level"]


def at_level(table: DataFrame, level: str) -> DataFrame:
    return table.filter(F.col("level") == level)


def reply_counts(table: DataFrame) -> DataFrame:
    return at_level(table, REPLY).groupBy("stid", "reviewid").agg(F.count("*").alias("n_replies"))


def with_reply_counts(reviews: DataFrame, table: DataFrame, few: bool = False) -> DataFrame:
    """`few` says that the reviews are a small part: only their replies are counted."""
    if few:
        listed = reviews.select("stid", "reviewid").distinct()
        table = join_apart(table, listed, ["stid", "reviewid"], "left_semi")
    counted = reviews.join(reply_counts(table), ["stid", "reviewid"], "left")
    return counted.withColumn("n_replies", F.coalesce("n_replies", F.lit(0)))


def mine(snsid: Column, appid: Column) -> Column:
    same = (F.col("snsid") == snsid) & (F.col("appid") == appid)
    return F.when(same, 1).otherwise(0)


def summary(table: DataFrame) -> DataFrame:
    """Count and newest entry of each station and level; equal times go to the higher number."""
    newest = F.max(F.struct("time", "no", "nickname", "review"))
    return (
        table.groupBy("stid", "level")
        .agg(F.count("*").alias("n"), newest.alias("_new"))
        .select(
            "stid", "level", "n",
            F.col("_new.nickname").alias("nickname"),
            F.col("_new.review").alias("review"),
            F.col("_new.time").alias("time"),
        )
    )


def summary_for(stations: DataFrame, table: DataFrame, level: str = REVIEW) -> DataFrame:
    """summary for the given stations (column stid); one without reviews has count 0."""
    found = summary(at_level(table, level)).drop("level")
    return stations.select("stid").distinct().join(found, "stid", "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def newest_reviews(table: DataFrame, limit: int = PAGE) -> DataFrame:
    """The first page of every station, newest number first."""
    reviews = at_level(table, REVIEW)
    return top_per_key(reviews, ["stid"], [F.col("no").desc()], limit, "pos")


def _asked(table: DataFrame, requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of what the requests name."""
    return join_apart(table, requests.select(*keys).distinct(), keys, "left_semi")


def _marked(requests: DataFrame, shown: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each request with the rows of its page, the caller's own marked."""
    named = shown.withColumnsRenamed({"snsid": "_sns", "appid": "_app"})
    joined = join_apart(requests.select("snsid", "appid", *keys), named, keys)
    return joined.withColumn("my", mine(F.col("_sns"), F.col("_app"))).drop("_sns", "_app")


SHOWN = ["snsid", "appid", "nickname", "stid", "reviewid", "review", "level", "time", "no", "n_replies"]


def review_page(requests: DataFrame, table: DataFrame) -> DataFrame:
    """First page for each request (snsid, appid, stid), with the caller's own marked."""
    page = newest_reviews(_asked(at_level(table, REVIEW), requests, ["stid"]))
    return _marked(requests, with_reply_counts(page, table, few=True).select(*SHOWN), ["stid"])


def numbers_after(
    cursors: DataFrame, rows: DataFrame, keys: Sequence[str], newest_first: bool, limit: int
) -> DataFrame:
    """(keys, last, pos, no): the next `limit` numbers behind each cursor (keys, last).

    Cursors are ranked among the rows of their key, so that the page is found by
    rank: each cursor meets its own rows only, not all that follow. Rows that no
    cursor of their key reaches are left out first.
    """
    edge = F.max("last") if newest_first else F.min("last")
    edges = cursors.groupBy(*keys).agg(edge.alias("_edge"))
    sign = -1 if newest_first else 1
    behind = F.col("no") * sign > F.col("_edge") * sign
    reached = join_apart(rows.select(*keys, "no"), edges, keys).filter(behind).drop("_edge")
    marks = cursors.select(*keys, F.col("last").alias("no")).distinct()
    both = reached.withColumn("_one", F.lit(1).cast("bigint")).unionByName(
        marks.withColumn("_one", F.lit(0).cast("bigint"))
    )
    # A row with the cursor's own number comes before the cursor.
    ranks = running_sums(
        both,
        keys,
        F.floor(F.col("no") / NUMBERS_PER_SLICE) * sign,
        [(F.col("no") * sign).asc(), F.col("_one").desc()],
        {"rank": F.col("_one")},
    )
    wanted = (
        ranks.filter(F.col("_one") == 0)
        .withColumn("pos", F.explode(F.sequence(F.lit(1), F.lit(limit))))
        .select(*keys, F.col("no").alias("last"), (F.col("rank") + F.col("pos")).alias("rank"), "pos")
    )
    numbered = ranks.filter(F.col("_one") == 1).select(*keys, "rank", "no")
    return wanted.join(numbered, [*keys, "rank"]).select(*keys, "last", "pos", "no")


def keyset_page(cursors: DataFrame, table: DataFrame, limit: int = PAGE) -> DataFrame:
    """Next page for each cursor (stid, last): the newest reviews with a lower number."""
    return numbers_after(cursors, at_level(table, REVIEW), ["stid"], True, limit)


def next_review_page(requests: DataFrame, table: DataFrame, limit: int = PAGE) -> DataFrame:
    """The next page with its content for each request (snsid, appid, stid, last)."""
    reviews = _asked(at_level(table, REVIEW), requests, ["stid"])
    page = keyset_page(requests.select("stid", "last").distinct(), reviews, limit)
    listed = with_reply_counts(_asked(reviews, page, ["stid", "no"]), table, few=True)
    shown = page.join(listed.select(*SHOWN), ["stid", "no"])
    return _marked(requests.select("snsid", "appid", "stid", "last"), shown, ["stid", "last"])


REPLIES_SHOWN = ["snsid", "appid", "nickname", "stid", "reviewid", "replyid", "reply", "level", "time", "no"]


def first_reply_page(requests: DataFrame, table: DataFrame, limit: int = PAGE) -> DataFrame:
    """The oldest replies for each request (snsid, appid, stid, reviewid), own ones marked."""
    keys = ["stid", "reviewid"]
    page = reply_page(_asked(at_level(table, REPLY), requests, keys), limit)
    return _marked(requests, page.select(*REPLIES_SHOWN, "pos"), keys)


def next_reply_page(requests: DataFrame, table: DataFrame, limit: int = PAGE) -> DataFrame:
    """The replies after each request's cursor (snsid, appid, stid, reviewid, last), oldest first."""
    keys = ["stid", "reviewid"]
    replies = _asked(at_level(table, REPLY), requests, keys)
    page = numbers_after(requests.select(*keys, "last").distinct(), replies, keys, False, limit)
    shown = page.join(replies.select(*REPLIES_SHOWN), [*keys, "no"])
    return _marked(requests.select("snsid", "appid", *keys, "last"), shown, [*keys, "last"])


def review_pages(table: DataFrame, size: int = PAGE) -> DataFrame:
    """Page and place of every review of every station."""
    by_number = ranked(
        at_level(table, REVIEW),
        ["stid"],
        -F.floor(F.col("no") / NUMBERS_PER_SLICE),
        [F.col("no").desc()],
    )
    return by_number.withColumns(
        {
            "page": F.floor((F.col("rank") - 1) / size) + 1,
            "pos": F.pmod(F.col("rank") - 1, F.lit(size)) + 1,
        }
    ).drop("rank")


def reply_page(table: DataFrame, limit: int = PAGE) -> DataFrame:
    """The oldest replies of every review."""
    replies = at_level(table, REPLY)
    return top_per_key(replies, ["stid", "reviewid"], [F.col("no")], limit, "pos")


def edit(
    table: DataFrame,
    requests: DataFrame,
    key: Sequence[str],
    text: str,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Set nickname and text of the rows whose id columns all match a request.

    With several requests for one row, `order` puts the one that counts first.
    """
    return keyed_update(table, requests, key, ["nickname", text], order)


def delete_reviews(table: DataFrame, requests: DataFrame) -> DataFrame:
    """Remove the requested rows; a review with replies stays, without its name and text."""
    asked = requests.select(*REVIEW_KEY).distinct()
    fate = with_reply_counts(asked, table, few=True).withColumnRenamed("n_replies", "_replies")
    kept = join_apart(table, fate, REVIEW_KEY, "left").filter(
        F.col("_replies").isNull() | (F.col("_replies") > 0)
    )
    blank = {"nickname": REMOVED_NICKNAME, "review": REMOVED_TEXT}
    value = lambda c: F.when(F.col("_replies") > 0, blank[c]).otherwise(F.col(c)).alias(c)
    return kept.select(*[value(c) if c in blank else F.col(c) for c in table.columns])


def delete_replies(table: DataFrame, requests: DataFrame) -> DataFrame:
    asked = requests.select(*REPLY_KEY).distinct()
    return join_apart(table, asked, REPLY_KEY, "left_anti").select(*table.columns)
