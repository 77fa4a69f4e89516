"""Region dimension and counts under code prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.fixed_values import AVAILABLE, COMPANY_NAMES, DISTRICT_IN_FORCE
from .merges import keyed_update


def region_rows(text: DataFrame) -> DataFrame:
    """Districts in force with their level and short name; coordinates come later."""
    kept = text.filter(F.col("status") == DISTRICT_IN_FORCE)
    return kept.select(
        "bcode",
        "arr",
        codes.region_level(F.col("arr")).alias("level"),
        codes.last_word(F.col("arr")).alias("arrt"),
    )


def with_coordinates(regions: DataFrame, places: DataFrame) -> DataFrame:
    """Latitude and longitude by district name; (0, 0) where the name is unknown.

    `places` has name, lat, lng, one row per name. Regions that share a name
    all get its coordinates.
    """
    found = places.select(F.col("name").alias("arr"), "lat", "lng")
    joined = regions.drop("lat", "lng").join(found, "arr", "left")
    return joined.select(
        "bcode",
        "arr",
        "level",
        "arrt",
        F.coalesce("lat", F.lit(0.0)).alias("lat"),
        F.coalesce("lng", F.lit(0.0)).alias("lng"),
    )


def available_by_code(chargers: DataFrame) -> DataFrame:
    """Available chargers per full code: as many rows as codes, however many chargers."""
    usable = chargers.filter((F.col("stat") == AVAILABLE) & F.col("addcd").isNotNull())
    return usable.groupBy("addcd").agg(F.count("*").alias("n"))


def _count_under(regions: DataFrame, prefix: Column, per_prefix: DataFrame, name: str) -> DataFrame:
    counted = regions.withColumn("_prefix", prefix).join(per_prefix, "_prefix", "left")
    return counted.withColumn(name, F.coalesce("n", F.lit(0)).cast("bigint")).drop("_prefix", "n")


def availability_changes(folded: DataFrame) -> DataFrame:
    """(addcd, n): how many chargers became available less those that ceased to be, by code.

    `folded` has addcd, the new stat and `was`, the stat before; rows that stay what they are say nothing.
    """
    moved = folded.filter(F.col("addcd").isNotNull()).select(
        "addcd", F.coalesce((F.col("stat") == AVAILABLE).cast("bigint"), F.lit(0)).alias("_now"),
        F.coalesce((F.col("was") == AVAILABLE).cast("bigint"), F.lit(0)).alias("_was"),
    )
    return moved.filter("_now <> _was").groupBy("addcd").agg(F.sum(F.col("_now") - F.col("_was")).alias("n"))


def shifted_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts per code with signed changes added; codes that come to nothing go."""
    both = counts.select("addcd", "n").unionByName(changes.select("addcd", "n"))
    return both.groupBy("addcd").agg(F.sum("n").alias("n")).filter("n <> 0")


def available_by_region(regions: DataFrame, chargers: DataFrame) -> DataFrame:
    """`num` of every region: available chargers below it. Counts overlap between levels."""
    return available_under(regions, available_by_code(chargers))


def available_under(regions: DataFrame, by_code: DataFrame) -> DataFrame:
    """`num` of every region from counts per code (addcd, n).

    Prefixes are taken from the counted codes, so the rows made per code are
    few and no prefix comparison is left in the join.
    """
    per_prefix = (
        by_code
        .select(F.explode(codes.code_prefixes(F.col("addcd"))).alias("_prefix"), "n")
        .groupBy("_prefix")
        .agg(F.sum("n").alias("n"))
    )
    prefix = codes.region_prefix(F.col("bcode"), F.col("level"))
    return _count_under(regions, prefix, per_prefix, "num")


def available_in_box(box_regions: DataFrame, chargers: DataFrame) -> DataFrame:
    """Available chargers by the first eight digits of each region's code."""
    eight = lambda c: F.left(F.col(c), F.lit(8))
    per_prefix = (
        available_by_code(chargers)
        .filter(F.length("addcd") >= 8)
        .groupBy(eight("addcd").alias("_prefix"))
        .agg(F.sum("n").alias("n"))
    )
    counted = _count_under(box_regions, eight("bcode"), per_prefix, "n_available")
    return counted.select("bcode", "arrt", "lat", "lng", "n_available")


def store_counts(regions: DataFrame, counts: DataFrame) -> DataFrame:
    """Write `num` onto the region rows by code."""
    return keyed_update(regions, counts, ["bcode"], ["num"])


def company_dimension(chargers: DataFrame) -> DataFrame:
    """One name per operator: the lowest, so that reruns agree.

    The few different pairs are found by hash first; only they are compared.
    """
    return chargers.select("busiid", "businm").distinct().groupBy("busiid").agg(F.min("businm").alias("businm"))


def override_names(companies: DataFrame, names: DataFrame) -> DataFrame:
    """Replace names from a table of (busiid, businm), one row per id; the others stay."""
    fixed = names.select("busiid", F.col("businm").alias("_fixed"))
    return companies.join(fixed, "busiid", "left").select(
        "busiid", F.coalesce("_fixed", "businm").alias("businm")
    )


def fixed_names(companies: DataFrame) -> DataFrame:
    """override_names with the service's own table, which has a fixed 55 rows."""
    rows = list(COMPANY_NAMES.items())
    names = companies.sparkSession.createDataFrame(rows, "busiid STRING, businm STRING")
    return override_names(companies, F.broadcast(names))


def company_list(companies: DataFrame) -> DataFrame:
    return companies.orderBy("businm", "busiid")


def representatives(chargers: DataFrame, *columns: str) -> DataFrame:
    """One charger row per station: the lowest charger id."""
    lowest = chargers.groupBy("statid").agg(F.min(F.struct("chgerid", *columns)).alias("_row"))
    return lowest.select("statid", "_row.*")
