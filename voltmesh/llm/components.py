"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import settle


def components(links: DataFrame) -> DataFrame:
    """For links a, b (bigint, any order, repeats and loops allowed): node and root, the least
    node of its component, for every node that is not its own root.

    Links are turned into stars, by turns around the least neighbour of each node and
    around the least of its smaller neighbours, until nothing changes: about log n rounds.
    Every round is joins and minima and is written, so a hub is one row per link.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(edges.distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionAll(edges.join(least, "a").select("a", F.col("m").alias("b"))).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = moved.unionAll(small.select("a", F.col("m").alias("b"))).distinct()
        edges = settle(stars, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(mark % (1 << 31)), F.bit_xor(mark)).first())
