"""Predicates over stations, regions and users."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes, geo, text, times
from ..functions.lists import ROWS, parse_list, row_ids
from ..schemas import KEYS
from .skew import join_apart


def stations_in_box(chargers: DataFrame, top, bottom, right, left) -> DataFrame:
    """One row per charger, not per station."""
    box = geo.in_box(F.col("lat"), F.col("lng"), top, bottom, right, left)
    return chargers.filter(box).select("statid", "lat", "lng", "stat", "chgertype")


def regions_in_box(regions: DataFrame, top, bottom, right, left, level: int) -> DataFrame:
    box = geo.in_box(F.col("lat"), F.col("lng"), top, bottom, right, left)
    return regions.filter(box & (F.col("level") == level)).select("bcode", "arrt", "lat", "lng")


def station_detail(chargers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every column of every charger of the wanted stations (column statid)."""
    return join_apart(chargers, wanted.select("statid").distinct(), ["statid"], "left_semi")


def regions_by_terms(regions: DataFrame, terms: Sequence[str], limit: int = 3) -> DataFrame:
    """Regions whose name holds every term; an empty term holds for any name."""
    tests = [text.like_any(F.col("arr"), F.lit(term)) for term in terms]
    found = regions.filter(reduce(lambda a, b: a & b, tests))
    return found.orderBy("bcode").limit(limit).select("arr", "lat", "lng")


def stations_by_text(chargers: DataFrame, txt: str) -> DataFrame:
    return chargers.filter(text.like_any(F.col("statnm"), F.lit(txt)))


def without_region(chargers: DataFrame) -> DataFrame:
    """Region lookup failed or never made."""
    return chargers.filter(codes.needs_region(F.col("addcd")))


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Any column differs; a null on either side is no difference."""
    tests = [F.col(f"{left}.{c}") != F.col(f"{right}.{c}") for c in columns]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def changed_rows(base: DataFrame, delta: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Delta rows that would change their base row."""
    joined = base.alias("a").join(delta.alias("b"), KEYS)
    return joined.filter(differs("a", "b", columns)).select(*KEYS, *[f"b.{c}" for c in columns])


def within_lookback(feed: DataFrame, now: Column, last_run: Column) -> DataFrame:
    """Feed rows since the last run plus the overlap; times are epoch seconds."""
    minutes = times.lookback_minutes(now, last_run)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    newest = epoch + F.make_dt_interval(secs=now.cast("decimal(18,6)"))
    since = newest - F.make_dt_interval(mins=minutes.cast("int"))
    return feed.filter(F.col("statupddt") >= since)


def authorised(requests: DataFrame, users: DataFrame, exactly_one: bool = True) -> DataFrame:
    """Requests whose (snsid, appid) matches one user row, or at least one.

    Put it before every edit, delete, filter or flag command that a caller asks for.
    """
    asked = requests.select("snsid", "appid").distinct()
    counts = users.join(asked, ["snsid", "appid"], "left_semi").groupBy("snsid", "appid").agg(F.count("*").alias("_n"))
    allowed = counts.filter(F.col("_n") == 1 if exactly_one else F.col("_n") > 0)
    return join_apart(requests, allowed, ["snsid", "appid"], "left_semi")


def user_field(requests: DataFrame, users: DataFrame, *fields: str) -> DataFrame:
    """Stored columns of the users the requests name."""
    wanted = requests.select("snsid", "appid").distinct()
    return users.join(wanted, ["snsid", "appid"], "left_semi").select("snsid", "appid", *fields)


def list_contains(requests: DataFrame, users: DataFrame, field: str, id_at: int) -> DataFrame:
    """Number of user rows (0 or more) whose stored list holds the requested id.

    `exact` tests the ids in the list; `raw` is LIKE '%id%' on the stored text,
    for which M333 is also found in M3333.
    """
    asked = requests.select("snsid", "appid").distinct()
    stored = users.join(asked, ["snsid", "appid"], "left_semi").select(
        "snsid",
        "appid",
        F.col(field).alias("_text"),
        row_ids(parse_list(F.col(field), ROWS), id_at).alias("_ids"),
    )
    hit = join_apart(requests, stored, ["snsid", "appid"], "left")
    count = lambda test: F.coalesce(F.sum(test.cast("bigint")), F.lit(0))
    return hit.groupBy("snsid", "appid", "item").agg(
        count(F.array_contains("_ids", F.col("item"))).alias("exact"),
        count(text.like_any(F.col("_text"), F.col("item"))).alias("raw"),
    )
