"""Users: sign-in and nickname."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ids import stable_appid
from .merges import keyed_update
from .skew import join_apart

USER_KEY = ["sns", "snsid"]

# Answer to a request for the nickname the user already has.
TAKEN = "1"


def upsert_users(
    users: DataFrame, incoming: DataFrame, salt: str, order: Column | None = None
) -> DataFrame:
    """Known users get the new e-mail and name; new ones are added with their name as nickname.

    Of several sign-ins of one user the last by `order` (e-mail and name, if not
    given) sets e-mail and name; the first gives a new user the nickname.
    """
    entry = F.struct("email", "name")
    order = entry if order is None else order
    fresh = incoming.groupBy(*USER_KEY).agg(
        F.max_by(entry, order).alias("_in"), F.min_by("name", order).alias("_first")
    )
    held = users.withColumn("_known", F.lit(True))
    joined = held.join(fresh, USER_KEY, "full_outer")
    known = F.col("_known").isNotNull()
    newest = lambda c: F.coalesce(F.col(f"_in.{c}"), F.col(c)).alias(c)
    first = {
        "nickname": F.col("_first"),
        "appid": stable_appid(F.col("sns"), F.col("snsid"), salt),
    }
    added = lambda c: F.when(known, F.col(c)).otherwise(first[c]).alias(c)
    return joined.select(
        *[
            newest(c) if c in ("email", "name") else added(c) if c in first else F.col(c)
            for c in users.columns
        ]
    )


def signed_in(users: DataFrame, incoming: DataFrame) -> DataFrame:
    """What a sign-in returns: nickname and appid of each incoming user."""
    asked = incoming.select(*USER_KEY).distinct()
    return users.join(asked, USER_KEY, "left_semi").select(*USER_KEY, "nickname", "appid")


def nickname_answers(users: DataFrame, requests: DataFrame) -> DataFrame:
    """(snsid, appid, answer): the new nickname, or '1' when the user has it already.

    Other users are not looked at.
    """
    asked = requests.select("snsid", "appid", F.col("nickname").alias("_new"))
    same = F.col("nickname") == F.col("_new")
    return users.join(asked, ["snsid", "appid"]).select(
        "snsid", "appid", F.when(same, F.lit(TAKEN)).otherwise(F.col("_new")).alias("answer")
    )


def set_nicknames(
    users: DataFrame, requests: DataFrame, order: Sequence[Column] | None = None
) -> DataFrame:
    """Store the new nicknames; with several requests of a user `order` puts the last first."""
    return keyed_update(users, requests, ["snsid", "appid"], ["nickname"], order)


def taken_elsewhere(users: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests for a nickname that a different user holds (the stricter check)."""
    held = users.groupBy("nickname").agg(
        F.min("snsid").alias("_low"), F.max("snsid").alias("_high")
    )
    other = (F.col("_low") != F.col("snsid")) | (F.col("_high") != F.col("snsid"))
    return join_apart(requests, held, ["nickname"]).filter(other).drop("_low", "_high")
