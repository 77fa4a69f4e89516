"""Fault notices: message text and attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text

IMAGES = ("first", "second", "third")


def render_notices(reports: DataFrame) -> DataFrame:
    """One message per report (emailto, stid, stnm, context)."""
    body = text.notice_body(F.col("stid"), F.col("stnm"), F.col("context"))
    return reports.select("emailto", "stid", text.notice_subject().alias("subject"), body.alias("body"))


def decode_attachments(reports: DataFrame, key: str) -> DataFrame:
    """The first `dist` images of each report, decoded and named by their type.

    The name is null when the type is not known.
    """
    wanted = F.slice(F.array(*IMAGES), F.lit(1), F.col("dist"))
    images = reports.select(key, F.posexplode(wanted).alias("idx", "_text"))
    decoded = images.select(key, (F.col("idx") + 1).alias("idx"), F.unbase64("_text").alias("image"))
    name = F.concat(F.col("idx").cast("string"), F.lit("."), text.image_type(F.col("image")))
    return decoded.withColumn("filename", name)
