"""Tables and object listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import relative_name


def read_table(
    spark: SparkSession, path: str, *columns: str, schema: T.StructType | None = None
) -> DataFrame:
    """Without a schema the files are asked for theirs."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    return table.select(*columns) if columns else table


def read_database(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int
) -> DataFrame:
    """A database table read in `parts` ranges of an integer key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key)
        .options(lowerBound=low, upperBound=high, numPartitions=parts)
        .load()
    )


def object_inventory(spark: SparkSession, prefix: str) -> DataFrame:
    """(name, length) of the objects under a prefix; the content is not read.

    Names begin after the prefix, whatever scheme it is given with. Spark's file sources take
    names that begin with '_' or '.' for their own and leave them out.
    """
    objects = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    )
    plain = lambda path: F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")
    start = plain(F.lit(prefix.rstrip("/") + "/"))
    return objects.select(relative_name(plain(F.col("path")), start).alias("name"), "length")
