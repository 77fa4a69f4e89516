"""Nearest vectors by cosine, through a forest of random-projection trees.

The trees are fitted on a sample of bounded size: a node's plane stands across two of its sample
vectors, and cuts the sample in half. All vectors are then dealt to the leaves, and the leaves to blocks, so
that a task holds a bounded number of vectors however many rows there are; a leaf that has outgrown
LEAF is divided further by trees of its own where it is searched.

A query walks all trees through one priority queue, in which a branch waits with the distance to the farthest plane that
had to be crossed. A first search takes the FIRST leaves. The last score it finds
says how far away a better vector can lie at most; the second search goes on through the queue to all leaves
within REACH of that distance, and keeps what is better. How many leaves
that is depends on the data: few for vectors that lie on some low-dimensional surface, most
of them for vectors without structure. Nothing else limits the search. All candidates are ranked
by their exact cosine in double precision, summed in one order, so equal vectors have equal scores.

Equal vectors are one entry with their smallest ids, which is all that any query can see of
them, and are searched for once. Vectors that are null, empty or zero or that hold null or non-finite
components take no part, nor rows without vec_id, nor vectors of another length than most (no angle is
defined). A row is a candidate for every other row, also one with the same id or the same vector. Empty
tables give no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from voltmesh.operators.skew import join_apart

from .common import settle

TREES = 3
#: Vectors of a leaf, about; a leaf of the sample has at least LEAST of them.
LEAF, LEAST = 512, 16
#: The sample that the trees are fitted on: vectors, and bytes at most.
SAMPLE, SAMPLE_BYTES = 32_768, 32 << 20
#: Leaves of a block, and vectors that a task holds of one.
BLOCK, PART = 16, 32_768
#: Leaves of the first search, and the share of the known distance at which planes are still crossed.
FIRST, REACH = 6, 0.2
NEIGHBOURS, EVERY = 5, 50
#: Bytes of scores that a task computes at a time.
PIECE = 16 << 20
#: Rounding of products of unit vectors, with room.
NEAR = 1e-9

_PLACED = pa.schema(
    [("place", pa.int64()), ("kind", pa.int32()), ("key", pa.binary()), ("vector", pa.binary())]
    + [("ids", pa.list_(pa.int64())), ("leaves", pa.list_(pa.int32())), ("bound", pa.float64())]
)
PLACED = "place bigint, kind int, key binary, vector binary, ids array<bigint>, leaves array<int>, bound double"
_FOUND = pa.schema(
    [("query", pa.binary()), ("key", pa.binary()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())]
)
FOUND = "query binary, key binary, ids array<bigint>, score double"


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows that belong together, in double precision, each row summed by itself."""
    a, b = np.ascontiguousarray(a), np.ascontiguousarray(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


class Tree:
    """A complete binary tree of planes; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        self.depth = depth
        count, width = 2**depth - 1, sample.shape[1]
        self.planes, self.cuts = np.zeros((count, width)), np.zeros(count)
        draw = np.random.default_rng(seed)
        rows = {0: np.arange(len(sample))}
        for node in range(count):
            held = rows.pop(node)
            plane = draw.normal(size=width)
            if len(held) > 1:
                a, b = sample[draw.choice(held, 2, replace=False)]
                plane = a - b if np.any(a != b) else plane
            plane /= np.sqrt((plane * plane).sum())
            at = sample[held] @ plane
            self.planes[node], self.cuts[node] = plane, np.median(at) if len(held) else 0.0
            right = at >= self.cuts[node]
            rows[2 * node + 1], rows[2 * node + 2] = held[~right], held[right]

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), dtype=np.int64)
        for _ in range(self.depth):
            margin = np.einsum("ij,ij->i", vectors, self.planes[node]) - self.cuts[node]
            node = 2 * node + 1 + (margin >= 0)
        return node - (2**self.depth - 1)


def in_order(margins: list[list[float]], depths: list[int]) -> Iterator[tuple[float, int, int]]:
    """(distance crossed, tree, leaf), nearest first, from one queue for all trees."""
    queue = [(0.0, tree, 0) for tree in range(len(margins))]
    while queue:
        crossed, tree, node = heapq.heappop(queue)
        at, inner = margins[tree], 2 ** depths[tree] - 1
        while node < inner:
            right = at[node] >= 0
            other = abs(at[node])
            heapq.heappush(queue, (max(crossed, other), tree, 2 * node + (1 if right else 2)))
            node = 2 * node + (2 if right else 1)
        yield crossed, tree, node - inner


def asked_leaves(trees: list[Tree], vectors: np.ndarray, bounds: np.ndarray | None) -> Iterator[list[tuple[int, int]]]:
    """(tree, leaf) of each query: the FIRST leaves, or the later ones within REACH of its bound."""
    depths = [t.depth for t in trees]
    step = max(1, PIECE // (8 * sum(len(t.cuts) for t in trees) + 8))
    for start in range(0, len(vectors), step):
        piece = vectors[start : start + step]
        margins = [(piece @ t.planes.T - t.cuts).tolist() for t in trees]
        for row in range(len(piece)):
            queue = enumerate(in_order([m[row] for m in margins], depths))
            out = []
            if bounds is None:
                for number, (_, tree, leaf) in queue:
                    out.append((tree, leaf))
                    if number + 1 == FIRST:
                        break
            else:
                reach = REACH * np.sqrt(max(0.0, 2 - 2 * bounds[start + row]))
                for number, (crossed, tree, leaf) in queue:
                    if crossed > reach:
                        break
                    if number >= FIRST:
                        out.append((tree, leaf))
            yield out


def _array(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).astype("<f8").reshape(len(column), -1)


def kind_of(embeddings: DataFrame) -> str:
    """How components are kept: floats as they are, all others as doubles."""
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    return "<f4" if element == "float" else "<f8"


def entries(embeddings: DataFrame) -> DataFrame:
    """(vec_id, key, vector) of the rows that take part; vectors as the bytes of their components.

    A vector of doubles is moved by a power of two so that its largest component is near one: that
    leaves every cosine as it is and keeps squares finite.
    """
    kind = kind_of(embeddings)
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).dropna()

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                flat = values.values
                v = flat.to_numpy(zero_copy_only=False).astype("<f8") if not flat.null_count else np.empty(0)
                if not len(v) or not np.isfinite(v).all() or not v.any():
                    continue
                if kind == "<f8":
                    v = np.ldexp(v, -int(np.frexp(np.abs(v).max())[1]))
                raw = (v + 0.0).astype(kind).tobytes()  # plus zero: no negative zeros
                out.append((vec_id, blake2b(raw, digest_size=16).digest(), raw))
            columns = zip(*out) if out else ([], [], [])
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["vec_id", "key", "vector"])

    return rows.mapInArrow(fit, "vec_id bigint, key binary, vector binary")


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(key, vector, ids): each vector once, with its `most` smallest ids.

    A vector that many rows share is cut down to so many rows in every input partition.
    """
    rank = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    few = rows.withColumn("_rank", rank).filter(F.col("_rank") <= most)
    return few.groupBy("key").agg(
        F.min("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )


def fit_forest(vectors: DataFrame, count: int, size: int, kind: str) -> list[Tree]:
    """Trees on a sample by the hash of the vector, as deep as the number of vectors asks for.

    `size` is the bytes of a vector.
    """
    most = max(1, min(SAMPLE, SAMPLE_BYTES // size))
    rate = min(1.0, 0.9 * most / max(1, count))
    mark = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    chosen = vectors.filter(mark < rate).select("key", "vector").limit(most).toArrow()
    chosen = chosen.sort_by("key")
    sample = units(_array(chosen["vector"], kind))
    depth = 0
    while (count >> depth) > LEAF and (len(sample) >> (depth + 1)) >= LEAST:
        depth += 1
    return [Tree(sample, depth, seed) for seed in range(TREES)]


def _places(trees: list[Tree]) -> int:
    """Blocks of a tree."""
    return -(-(2 ** trees[0].depth) // BLOCK)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _dealt(vectors: DataFrame, trees: list[Tree], kind: str, parts: dict[int, int] | None) -> DataFrame:
    """Every vector at its block in every tree: place, or the number of the block without `parts`."""
    blocks = _places(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = units(_array(batch.column("vector"), kind))
            keys, raws, ids = (batch.column(c).to_pylist() for c in ("key", "vector", "ids"))
            for number, tree in enumerate(trees):
                leaves = tree.leaves_of(table).tolist()
                rows = []
                for leaf, key, raw, held in zip(leaves, keys, raws, ids):
                    block = number * blocks + leaf // BLOCK
                    part = int.from_bytes(key[:8], "big") % parts[block] if parts else 0
                    rows.append((block << 32 | part, 0, key, raw, held, [leaf], None))
                yield _batch(rows, _PLACED)

    return vectors.select("key", "vector", "ids").mapInArrow(deal, PLACED)


def _asked(queries: DataFrame, trees: list[Tree], kind: str, parts: dict[int, int], again: bool) -> DataFrame:
    """Every query at the blocks that hold leaves it asks for."""
    blocks = _places(trees)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, raws, bounds = (batch.column(c).to_pylist() for c in ("key", "vector", "bound"))
            known = np.array([-2.0 if b is None else b for b in bounds]) if again else None
            rows = []
            asked = asked_leaves(trees, units(_array(batch.column("vector"), kind)), known)
            for key, raw, bound, wanted in zip(keys, raws, bounds, asked):
                by_block: dict[int, list[int]] = {}
                for tree, leaf in wanted:
                    by_block.setdefault(tree * blocks + leaf // BLOCK, []).append(leaf)
                for block, leaves in by_block.items():
                    for part in range(parts.get(block, 0)):
                        rows.append((block << 32 | part, 1, key, raw, None, leaves, bound))
                if len(rows) > 20_000:
                    yield _batch(rows, _PLACED)
                    rows = []
            if rows:
                yield _batch(rows, _PLACED)

    return queries.select("key", "vector", "bound").mapInArrow(ask, PLACED)


class Held:
    """The vectors of a part of a block, by leaf; a leaf over LEAF has a tree of its own."""

    def __init__(self, keys: list[bytes], table: np.ndarray, ids: list[list[int]], leaves: list[int], again: bool):
        self.keys, self.table, self.units, self.ids, self.again = keys, table, units(table), ids, again
        self.rows: dict[int, np.ndarray] = {}
        self.inner: dict[int, tuple[Tree, np.ndarray]] = {}
        at = np.array(leaves)
        for leaf in set(leaves):
            rows = np.flatnonzero(at == leaf)
            self.rows[leaf] = rows
            depth = 0
            while (len(rows) >> depth) > 2 * LEAF:
                depth += 1
            if depth:
                tree = Tree(self.units[rows], depth, leaf)
                self.inner[leaf] = tree, tree.leaves_of(self.units[rows])

    def search(self, keys: list[bytes], table: np.ndarray, leaves: list[list[int]], bounds: list[float | None], most: int) -> list[tuple]:
        """The `most` nearest of each asked leaf for each query, as (query, key, ids, score)."""
        asked: dict[tuple[int, int], list[int]] = {}
        normal = units(table)
        least = np.array([-2.0 if b is None else b for b in bounds])
        for row, wanted in enumerate(leaves):
            for leaf in wanted:
                if leaf in self.inner:
                    tree = self.inner[leaf][0]
                    reach = REACH * np.sqrt(max(0.0, 2 - 2 * least[row]))
                    margins = (tree.planes @ normal[row] - tree.cuts).tolist()
                    for number, (crossed, _, inner) in enumerate(in_order([margins], [tree.depth])):
                        if number and (not self.again or crossed > reach):
                            break
                        asked.setdefault((leaf, inner), []).append(row)
                elif leaf in self.rows:
                    asked.setdefault((leaf, -1), []).append(row)
        out = []
        for (leaf, inner), rows in asked.items():
            held = self.rows[leaf]
            if inner >= 0:
                held = held[self.inner[leaf][1] == inner]
            if not len(held):
                continue
            step = max(1, PIECE // (8 * len(held)))
            for start in range(0, len(rows), step):
                out += self._ranked(held, np.array(rows[start : start + step]), keys, table, normal, least, most)
        return out

    def _ranked(self, held, rows, keys, table, normal, least, most) -> list[tuple]:
        near = self.units[held] @ normal[rows].T
        limit = least[rows]
        if len(held) > most:
            limit = np.maximum(limit, np.partition(near, len(held) - most, axis=0)[len(held) - most])
        at, column = np.nonzero(near >= limit - NEAR)
        exact = cosines(self.table[held[at]], table[rows[column]])
        first = np.array([self.ids[held[a]][0] for a in at])
        order = np.lexsort((first, -exact, column))
        out, count, before = [], 0, -1
        for i in order:
            count = count + 1 if column[i] == before else 0
            before = column[i]
            if count < most and exact[i] >= least[rows[before]]:
                row = held[at[i]]
                out.append((keys[rows[before]], self.keys[row], self.ids[row], float(exact[i])))
        return out


def _searched(members: DataFrame, asked: DataFrame, kind: str, most: int, again: bool) -> DataFrame:
    """(query, key, ids, score) of the nearest in each leaf, where vectors and queries meet.

    A place's vectors sort before its queries: a task holds the former, at most PART or so, and the latter pass by.
    """
    ordered = members.unionAll(asked).repartition("place").sortWithinPartitions("place", "kind", "key")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, made = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = batch.column("place").to_numpy() * 2 + batch.column("kind").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for start, end in zip(starts, starts[1:]):
                run = batch.slice(start, end - start)
                if int(marks[start]) // 2 != place:
                    place, held, made = int(marks[start]) // 2, [], None
                if marks[start] % 2 == 0:
                    held.append(run)
                    continue
                if made is None and held:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    made = Held(
                        whole["key"].to_pylist(), _array(whole["vector"], kind), whole["ids"].to_pylist(),
                        [x[0] for x in whole["leaves"].to_pylist()], again,
                    )
                    held = []
                if made is not None:
                    keys, leaves, bounds = (run.column(c).to_pylist() for c in ("key", "leaves", "bound"))
                    rows = made.search(keys, _array(run.column("vector"), kind), leaves, bounds, most)
                    if rows:
                        yield _batch(rows, _FOUND)

    return ordered.mapInArrow(scan, FOUND)


def _best(found: DataFrame, most: int) -> DataFrame:
    """(query, key, vec_id, score), the `most` nearest rows of each query vector."""
    once = found.groupBy("query", "key").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    rows = once.select("query", "key", "score", F.explode("ids").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "key"))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def search(vectors: DataFrame, queries: DataFrame, most: int, kind: str) -> DataFrame:
    """(query, key, vec_id, score): the `most` nearest rows for every key of `queries`, itself included.

    `vectors` has key, vector, ids; `queries` has key and vector; `kind` is that of the components.
    """
    spark = vectors.sparkSession
    count, size = vectors.agg(F.count("*"), F.max(F.length("vector"))).first()
    if not count:
        return spark.createDataFrame([], "query binary, key binary, vec_id bigint, score double")
    trees = fit_forest(vectors, count, size, kind)
    # As many rows as there are blocks, which the sample bounds.
    sizes = _dealt(vectors, trees, kind, None).groupBy("place").count().collect()
    parts = {r["place"] >> 32: -(-r["count"] // PART) for r in sizes}
    members = _dealt(vectors, trees, kind, parts)
    first = _asked(queries.withColumn("bound", F.lit(None).cast("double")), trees, kind, parts, False)
    near = settle(_searched(members, first, kind, most, False), "near")
    # Fewer than `most` so far: no bound, all leaves are asked.
    last = F.when(F.count("*") >= most, F.min("score")).alias("bound")
    bounds = _best(near, most).groupBy("query").agg(last).withColumnRenamed("query", "key")
    bounded = settle(queries.join(bounds, "key", "left").select("key", "vector", "bound"), "bounded")
    later = _searched(members, _asked(bounded, trees, kind, parts, True), kind, most, True)
    return _best(near.unionAll(later), most)


def nearest_list(embeddings: DataFrame, every: int = EVERY, most: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest other rows of each row whose id `every` divides."""
    rows = settle(entries(embeddings), "entries")
    lengths = rows.groupBy(F.length("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).head(1)
    if lengths:
        rows = rows.filter(F.length("vector") == lengths[0]["n"])
    vectors = settle(distinct_vectors(rows, most + 1), "vectors")
    asking = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "key")
    queries = vectors.join(asking.select("key").distinct(), "key", "left_semi").select("key", "vector")
    found = search(vectors, settle(queries, "queries"), most + 1, kind_of(embeddings))
    near = found.groupBy(F.col("query").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", F.col("key").alias("of")))).alias("near")
    )
    answered = join_apart(asking.withColumnRenamed("vec_id", "query_id"), near, ["key"])
    # The row itself, once, is no candidate of its own.
    own = F.array_position(F.transform("near", lambda n: F.struct(n["vec_id"].alias("id"), n["of"].alias("of"))), F.struct(F.col("query_id").alias("id"), F.col("key").alias("of")))
    others = F.filter("near", lambda n, i: i + 1 != own)
    listed = answered.select("query_id", F.posexplode(F.slice(others, 1, most)).alias("_at", "n"))
    return listed.select(
        "query_id", (F.col("_at") + 1).alias("rank"), "n.vec_id", (-F.col("n.far")).alias("score")
    )
