"""Table schemas. Keys are a convention kept by the loaders, as the comments say."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def schema(spec: str) -> T.StructType:
    """Schema from 'name TYPE, ...', without the session that DDL parsing asks for."""
    pairs = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Charger snapshot; key (statid, chgerid).
CHARGER = schema(
    """statnm STRING, statid STRING, chgerid INT, chgertype INT, addr STRING, location STRING,
    lat DOUBLE, lng DOUBLE, addcd STRING, usetime STRING, busiid STRING, bnm STRING,
    businm STRING, busicall STRING, stat INT, statupddt TIMESTAMP_NTZ, lasttsdt TIMESTAMP_NTZ,
    lasttedt TIMESTAMP_NTZ, nowtsdt TIMESTAMP_NTZ, output INT, method STRING, zcode INT,
    parkingfree STRING, note STRING, limityn STRING, limitdetail STRING, delyn STRING,
    deldetail STRING"""
)

# The feed supplies every snapshot column but the region code, which enrichment adds.
CHARGER_FEED = T.StructType([f for f in CHARGER.fields if f.name != "addcd"])

# Older snapshot: one power column, no place detail and no session times.
_NEWER_ONLY = {"location", "bnm", "lasttsdt", "lasttedt", "nowtsdt"}
CHARGER_V1 = T.StructType(
    [f for f in CHARGER.fields if f.name not in _NEWER_ONLY]
    + [T.StructField("powertype", T.StringType())]
)
CHARGER_FEED_V1 = T.StructType([f for f in CHARGER_V1.fields if f.name != "addcd"])

# Buffer and delta; key (statid, chgerid).
STATUS = schema(
    """statid STRING, chgerid INT, stat INT, statupddt TIMESTAMP_NTZ,
    lasttedt TIMESTAMP_NTZ, nowtsdt TIMESTAMP_NTZ"""
)

# Control row; key id. ck 0 = rebuild running, 1 = ready; time = epoch seconds of the last run.
CONTROL = schema("id INT, ck INT, time DOUBLE")

# Region dimension; key bcode.
REGION = schema("bcode STRING, arr STRING, level INT, arrt STRING, lat DOUBLE, lng DOUBLE")
REGION_TEXT = schema("bcode STRING, arr STRING, status STRING")
REGION_CODE = schema("addcd STRING, statid STRING")

# Company dimension; key busiid.
COMPANY = schema("busiid STRING, businm STRING")

# Users; key (sns, snsid). The last four hold list text.
USER = schema(
    """sns STRING, snsid BIGINT, email STRING, name STRING, nickname STRING, appid STRING,
    bookmark STRING, rsearch STRING, filter STRING, filteron STRING"""
)

# Reviews (level '1') and replies (level '2') share a table; no increases.
REVIEW = schema(
    """no BIGINT, snsid BIGINT, appid STRING, nickname STRING, stid STRING, reviewid STRING,
    review STRING, replyid STRING, reply STRING, level STRING, time TIMESTAMP_NTZ"""
)

KEYS = ["statid", "chgerid"]
STATUS_COLUMNS = ["stat", "statupddt", "lasttedt", "nowtsdt"]
