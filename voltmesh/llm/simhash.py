"""SimHash near-duplicates by a self-join of the binary trie of all fingerprints.

The trie is walked with itself: a pair of nodes of one depth stands for the fingerprints
under both, the bits in which their paths differ are added up, and a pair goes as soon as
the sum is over the error budget. Of two fingerprints that differ in at most `bits`
bits, the upper halves differ in at most bits // 2 or the lower ones in fewer than
half; so the walk is made twice, once from each half, with the smaller budget for
the first 32 levels. That leaves far fewer pairs and loses none.

The topmost levels are walked by Spark: a fingerprint goes to the pairs of nodes at a depth
that follows the number of fingerprints, and a node with many of them is cut into parts,
so each task gets a bounded number. Below, a task walks its pair of subtries in arrays.
A task puts out a spanning forest of the links it finds, never all pairs of a group.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, chain, combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voltmesh.operators.skew import join_apart

from .common import UPPER, LOWER, map_arrow, settle, texts_of
from .components import components

SEED, SHINGLE, MAX_BITS = 42, 4, 4
#: Fingerprints under a node of the depth where tasks begin, and in a part of a fuller one.
NODE_ROWS, PART_ROWS = 4_096, 16_384
#: Node pairs walked at once; pairs of subtries with fewer combinations are compared outright.
FRONTIER, LEAF = 1 << 18, 16
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


# ---- Fingerprints -----------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each the majority of that bit over the XXH64 of all shingles of words.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a text
    of fewer words is one shingle, one without words has fingerprint 0.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    size = min(shingle, len(words))
    parts = [joined[a : b - 1] for a, b in zip(starts, starts[size:])]
    hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(seed)), np.uint64, len(parts))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", name: str = "fp") -> DataFrame:
    """Columns of the input but the text, and the fingerprint as a signed long."""
    kept = docs.drop(name)
    rest = [c for c in kept.columns if c != text]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in texts_of(batch, text)], dtype=np.uint64)
        columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*rest, name])

    fields = [kept.schema[c] for c in rest]
    return map_arrow(kept, run, T.StructType([*fields, T.StructField(name, T.LongType())]))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---- Walk of two subtries inside a task -------------------------------------------------


def _split(keys: np.ndarray, low: np.ndarray, shift: int) -> np.ndarray:
    """First key of each node whose next bit is set."""
    one = np.uint64(1)
    path = keys[low] >> np.uint64(shift) >> one
    return np.searchsorted(keys, ((path << one) | one) << np.uint64(shift))


def _all_pairs(a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """Every combination of a key under one node and a key under the other."""
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    which = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return a0[which] + nth // wide[which], b0[which] + nth % wide[which]


def walk(left: np.ndarray, right: np.ndarray, depth: int, budgets: tuple[int, int], same: bool):
    """Yield arrays of positions of linked keys in two sorted arrays of distinct keys.

    All keys of a side have the same first `depth` bits. `budgets` are those of the first
    32 bits and of all 64; `same` says that both sides are one.
    """
    if not len(left) or not len(right):
        return
    acc = int(np.bitwise_count((left[0] ^ right[0]) >> np.uint64(64 - depth))) if depth else 0
    first = np.array([[0], [len(left)], [0], [len(right)], [acc]], dtype=np.int64)
    stack = [(depth, first)]
    while stack:
        depth, nodes = stack.pop()
        if nodes.shape[1] > FRONTIER:
            stack += [(depth, nodes[:, i : i + FRONTIER]) for i in range(0, nodes.shape[1], FRONTIER)]
            continue
        a0, a1, b0, b1, acc = nodes
        small = (a1 - a0) * (b1 - b0) <= LEAF
        if small.any():
            i, j = _all_pairs(a0[small], a1[small], b0[small], b1[small])
            linked = np.bitwise_count(left[i] ^ right[j]) <= budgets[1]
            if same:
                linked &= i < j
            yield i[linked], j[linked]
            a0, a1, b0, b1, acc = nodes[:, ~small]
        if not len(a0):
            continue
        shift, limit = 63 - depth, budgets[0] if depth < 32 else budgets[1]
        am, bm = _split(left, a0, shift), _split(right, b0, shift)
        turned = acc + 1
        child = [
            np.stack([a0, am, b0, bm, acc]),
            np.stack([am, a1, bm, b1, acc]),
            np.stack([a0, am, bm, b1, turned]),
        ]
        crossed = np.stack([am, a1, b0, bm, turned])
        child.append(crossed[:, (a0 != b0) | (a1 != b1)] if same else crossed)
        after = np.concatenate(child, axis=1)
        after = after[:, (after[0] < after[1]) & (after[2] < after[3]) & (after[4] <= limit)]
        if after.shape[1]:
            stack.append((depth + 1, after))


def forest(count: int, links) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the least node of their component, for those that are not the least."""
    root = np.arange(count)
    for i, j in links:
        while len(i):
            i, j = root[i], root[j]
            low, high = np.minimum(i, j), np.maximum(i, j)
            open_ = low < high
            i, j, low, high = i[open_], j[open_], low[open_], high[open_]
            np.minimum.at(root, high, low)
            while True:
                further = root[root]
                if (further == root).all():
                    break
                root = further
    nodes = np.flatnonzero(root != np.arange(count))
    return nodes, root[nodes]


def _linked(left: np.ndarray, right: np.ndarray | None, depth: int, budgets: tuple[int, int]):
    """Links of a spanning forest between the keys of one or of two parts."""
    if right is None:
        every = left
        pairs = walk(left, left, depth, budgets, True)
    else:
        every = np.concatenate([left, right])
        pairs = ((i, j + len(left)) for i, j in walk(left, right, depth, budgets, False))
    nodes, roots = forest(len(every), pairs)
    return every[nodes], every[roots]


# ---- The walk of the upper levels in Spark ----------------------------------------------


def _turned(fp: Column, half: int) -> Column:
    """The fingerprint with the lower half first if `half` is 1."""
    if half == 0:
        return fp
    return F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))


#: Most turned nodes that one node is paired with; the depth where tasks begin follows.
TURNS = 4_096


def _turns(depth: int, budget: int) -> list[int]:
    """All masks of `depth` bits with at most `budget` bits set."""
    chosen = chain.from_iterable(combinations(range(depth), n) for n in range(min(budget, depth) + 1))
    return [sum(1 << i for i in c) for c in chosen]


def links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Links a, b that connect all fingerprints within `bits` bits, for a table of distinct fp.

    Not every pair is among them, but what pairs connect they connect.
    """
    count = fps.count()
    budgets = (bits // 2, bits - bits // 2 - 1)
    depth = max(1, min(24, (count // NODE_ROWS).bit_length()))
    while depth > 1 and sum(comb(depth, n) for n in range(budgets[0] + 1)) > TURNS:
        depth -= 1
    halves = [_half_links(fps, h, (b, bits), depth) for h, b in enumerate(budgets) if b >= 0]
    return reduce(DataFrame.unionAll, halves)


def _half_links(fps: DataFrame, half: int, budgets: tuple[int, int], depth: int) -> DataFrame:
    key = _turned(F.col("fp"), half)
    rows = fps.select(key.alias("key"), F.shiftrightunsigned(key, 64 - depth).alias("node"))
    parts = rows.groupBy("node").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    own = rows.join(parts, "node").select("key", "node", _place(F.col("node"), part).alias("own"))
    turned = own.withColumn(
        "turn", F.explode(F.array(*[F.lit(t).cast("bigint") for t in _turns(depth, budgets[0])]))
    )
    others = parts.select(F.col("node").alias("met"), F.col("parts").alias("others"))
    paired = turned.withColumn("met", F.col("node").bitwiseXOR(F.col("turn"))).join(others, "met")
    each = paired.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("others") - 1)))
    met = _place(F.col("met"), F.col("other"))
    sides = each.select(
        "key", "own", F.least("own", met).alias("low"), F.greatest("own", met).alias("high")
    )

    def join(group: pa.Table) -> pa.Table:
        keys, owner = (group.column(c).to_numpy() for c in ("key", "own"))
        low, high = (group.column(c)[0].as_py() for c in ("low", "high"))
        left = np.sort(keys[owner == low].view(np.uint64))
        right = None if low == high else np.sort(keys[owner == high].view(np.uint64))
        a, b = _linked(left, right, depth, budgets)
        if half:
            a, b = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return sides.groupBy("low", "high").applyInArrow(join, "a long, b long")


def _place(node: Column, part: Column) -> Column:
    return F.shiftleft(node, 32) + part


# ---- The operator -----------------------------------------------------------------------


def classes(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """fp and root, the least fingerprint of its component, for a table of distinct fp."""
    linked = components(links(fps, bits)).withColumnRenamed("node", "fp")
    return fps.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id, the least doc_id within reach, of every document.

    Texts without words, null or empty, share fingerprint 0. Rows without id get the component
    of their text; a component without any id has null. Repeated rows stay repeated.
    """
    rows = settle(with_fingerprint(docs.select("doc_id", "text"), shingle), "fingerprints")
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = settle(classes(first.select("fp"), bits), "classes")
    named = first.join(roots, "fp")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    owners = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return join_apart(rows, owners, ["fp"]).select(
        "doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns of the input: the one of the least id
    (rows without id last), of equal ids the one of the least hash. Of equal rows one stays."""
    mark = F.xxhash64(*docs.columns)
    keyed = docs.select("doc_id", "text", mark.alias("mark"))
    rows = settle(with_fingerprint(keyed, shingle), "fingerprints")
    roots = settle(classes(rows.select("fp").distinct(), bits), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = first.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    chosen = chosen.select("first.doc_id", "first.mark")
    # equal rows meet here before the shuffle
    packed = docs.select("doc_id", mark.alias("mark"), F.struct("*").alias("row"))
    one = packed.groupBy("doc_id", "mark").agg(F.first("row").alias("row"))
    same = one["doc_id"].eqNullSafe(chosen["doc_id"]) & (one["mark"] == chosen["mark"])
    return one.join(chosen, same, "left_semi").select("row.*")
