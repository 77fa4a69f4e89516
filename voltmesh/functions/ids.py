"""Row ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

APPID_LENGTH = 20


def random_id() -> Column:
    """A new id on every run, for rows that are written once."""
    return F.uuid()


def stable_appid(sns: Column, snsid: Column, salt: str) -> Column:
    """Twenty characters that come out the same when a task is run again."""
    key = F.concat_ws("|", sns, snsid.cast("string"), F.lit(salt))
    return F.left(F.sha2(key, 256), F.lit(APPID_LENGTH))
