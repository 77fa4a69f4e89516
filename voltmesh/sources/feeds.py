"""Landed feed pages and district files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import page_count
from ..schemas import CHARGER_FEED, KEYS, REGION_TEXT, STATUS

ROW_TAG = "item"

# A page is read by one task.
ROWS_PER_FILE = 100_000


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _typed(field: T.StructField) -> Column:
    """Cast as the database does on insert; what cannot be read becomes null.

    Times may come as fourteen digits.
    """
    value = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return value
    if isinstance(field.dataType, T.TimestampNTZType):
        value = F.regexp_replace(
            value, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
        )
    return F.trim(value).try_cast(field.dataType).alias(field.name)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[_typed(f) for f in schema.fields])


_DAMAGED = "_corrupt_record"


def _with_source(reader, path: str, schema: T.StructType) -> DataFrame:
    """Typed rows and source: the text of a damaged item, or the fields as they came."""
    text = T.StructType([*_as_text(schema).fields, T.StructField(_DAMAGED, T.StringType())])
    rows = reader.option("rowTag", ROW_TAG).option("columnNameOfCorruptRecord", _DAMAGED)
    source = F.coalesce(F.col(_DAMAGED), F.to_json(F.struct(*schema.names)))
    return rows.schema(text).load(path).select(*[_typed(f) for f in schema.fields], source.alias("source"))


def _whole(schema: T.StructType) -> Column:
    keys = [k for k in KEYS if k in schema.names]
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))


def read_pages(spark: SparkSession, path: str, schema: T.StructType = CHARGER_FEED) -> DataFrame:
    """Every <item> of the landed pages that has its key. Field names match without regard
    to case. What is left out is in rejected_items."""
    return _with_source(spark.read.format("xml"), path, schema).filter(_whole(schema)).drop("source")


def rejected_items(
    spark: SparkSession, path: str, schema: T.StructType = CHARGER_FEED
) -> DataFrame:
    """Items that are damaged or have no readable key: what could be read, and source, the text."""
    return _with_source(spark.read.format("xml"), path, schema).filter(~_whole(schema))


def stream_pages(
    spark: SparkSession, path: str, schema: T.StructType = STATUS, **options: str
) -> DataFrame:
    """All items of all files as a stream, with source; whoever merges them sets apart
    those without a key."""
    return _with_source(spark.readStream.format("xml").options(**options), path, schema)


def write_pages(rows: DataFrame, path: str) -> None:
    """Land rows as feed pages, compressed: the tags around every field are most of a page's text."""
    writer = rows.write.format("xml").option("rowTag", ROW_TAG).option("rootTag", "items")
    writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "gzip")
    writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").save(path)


def missing_pages(totals: DataFrame, landed: DataFrame) -> DataFrame:
    """Pages that the feed's total (column total) calls for and that have not landed (column page)."""
    called = totals.select(F.explode(F.sequence(F.lit(1), page_count(F.col("total")))).alias("page"))
    return called.join(landed.select("page"), "page", "left_anti")


def read_districts(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The tab-separated district file as it is; region_rows keeps those in force.

    For a file in a Korean code page pass its Java name, MS949, and set
    spark.sql.legacy.javaCharsets.
    """
    reader = spark.read.option("sep", "\t").option("quote", "").option("encoding", encoding)
    return reader.schema(REGION_TEXT).csv(path)
