"""Reading tables, Arrow tasks and written intermediate tables for the operators here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from voltmesh.session import workspace

#: Bytes of Arrow data that one call inside a task gets; a longer single row comes alone.
PIECE_BYTES = 8 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def unit(*parts: Column | str | int) -> Column:
    """A uniform number in (0, 1) from the md5 of the parts; DuckDB gives the same one."""
    return (digits(*parts).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def digits(*parts: Column | str | int) -> Column:
    """The first 52 bits of the md5 of the parts, joined by '#'."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("#", *columns)), 1, 13), 16, 10).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `limit` bytes."""
    count = batch.num_rows
    if not count:
        return
    step = max(1, int(count * limit / max(1, batch.nbytes)))
    for start in range(0, count, step):
        yield from _halved(batch.slice(start, min(step, count - start)), limit)


def _halved(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 1 or batch.get_total_buffer_size() == 0 or batch.nbytes <= 2 * limit:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _halved(batch.slice(0, half), limit)
    yield from _halved(batch.slice(half), limit)


def map_arrow(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: StructType | str,
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """Apply `fn` to runs of rows of a bounded number of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, limit):
                yield fn(piece)

    return df.mapInArrow(run, schema)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write under the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def crc32_sql(text: str) -> str:
    """DuckDB's unsigned crc32 of a short ASCII text, bit by bit."""
    step = "lambda x, i: xor(x >> 1, (x & 1) * 3988292384::bigint)"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: unicode(substr({text}, i::int, 1))::bigint)"
    folded = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), {folded}), 4294967295::bigint)"
