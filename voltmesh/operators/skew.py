"""Running sums, ranks and groups that stay spread out when one key holds most rows.

A plain window puts a whole key into one task. Here the key is cut into slices
that follow the order of the rows: a task sees one slice, the totals per slice
(a small table) give the offsets, and both are added.

A join on a hot key is split at run time by adaptive execution, but only if both
sides come straight from a shuffle and no later step counts on the rows of a key
being together. Aggregates on the join's own keys, before or after it, are in the
way; `join_apart` joins on one column more, so neither takes over the other's layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import workspace

# Rows of a slice, about.
SLICE_ROWS = 1_000_000


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_cut"
) -> DataFrame:
    """Rows with the number of their slice: about SLICE_ROWS rows each, along keys and order, which go
    by column names.

    The slices are ranges, so a key with many rows has several and they follow its order. The rows
    are written before they are counted and cut, so what they come from runs once; the
    slices are written as well, as a range computed again can come out differently. Rows that
    fit in one slice are not cut.
    """
    spark = df.sparkSession
    root = workspace(spark, "slices")
    df.write.parquet(f"{root}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{root}/rows")
    count = -(-rows.count() // SLICE_ROWS)
    if count <= 1:
        return rows.withColumn(name, F.lit(0))
    count = max(count, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = rows.repartitionByRange(count, *keys, *order).withColumn(name, F.spark_partition_id())
    cut.write.parquet(f"{root}/cut")
    return spark.read.schema(cut.schema).parquet(f"{root}/cut")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    slice_by: Column,
    order: Sequence[Column],
    sums: dict[str, Column],
) -> DataFrame:
    """Add inclusive running sums per key. `slice_by` must not fall along `order`.

    The slices' totals, a row each, are written: taken from the same shuffle as the rows, they would be
    mistaken for it as soon as some columns are not read.
    """
    sliced = df.withColumn("_slice", slice_by).repartition(*keys, "_slice")
    inside = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in sums.items()]
    )
    path = f"{workspace(df.sparkSession, 'totals')}/rows"
    totals.write.parquet(path)
    totals = df.sparkSession.read.schema(totals.schema).parquet(path)
    offsets = totals.select(
        *keys,
        "_slice",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_before_{name}")
            for name in sums
        ],
    )
    local = sliced.withColumns({name: F.sum(value).over(inside) for name, value in sums.items()})
    joined = local.join(offsets, [*keys, "_slice"])
    return joined.withColumns(
        {name: F.col(name) + F.col(f"_before_{name}") for name in sums}
    ).drop("_slice", *[f"_before_{name}" for name in sums])


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    slice_by: Column,
    order: Sequence[Column],
    name: str = "rank",
) -> DataFrame:
    """Row number from 1 within each key; the order has to be total."""
    return running_sums(df, keys, slice_by, order, {name: F.lit(1).cast("bigint")})


def join_apart(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join rows that may have hot keys with a table of one row per key."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    same = lookup.withColumns({k: F.col(k).cast(kinds[k]) for k in keys})
    mark = F.xxhash64(*keys)
    left, right = rows.withColumn("_apart", mark), same.withColumn("_apart", mark)
    return left.join(right, ["_apart", *keys], how).drop("_apart")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Spark keeps one row per key and input partition before the shuffle."""
    return top_per_key(df, keys, order, 1)


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    limit: int,
    name: str | None = None,
) -> DataFrame:
    """The first `limit` rows of each key, cut down before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    return out.drop("_rank") if name is None else out.withColumnRenamed("_rank", name)
