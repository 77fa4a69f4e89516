"""A trie of conversations by common beginnings, built from sorted shards and a skeleton.

A conversation's path is a string of 24 bytes a turn: a digest of role and text, and the
size of the text. Paths are sorted by ranges. Each range is a shard, and the first path of a
shard is the splitter that parts it from the one before. A node lies in more than one
shard only if it is a prefix of both paths at a splitter, so the shared prefixes of all
splitters are the skeleton of the trie. It is told to all shards as two depths for each splitter: what the
shard's first path shares with the shard before, and its last with the one behind. A shard finishes every
other node by itself and gives one partial row for each skeleton node it has; those are reduced by sums and minima.

In memory a shard has its open path and the finished children of that path's nodes, at most the nodes
of a shard. A path is one value, 24 bytes a turn; texts are never gathered.

Rows without conv_id belong to no conversation and are left out. Null turns come first, a null role or
text is empty. Rows of one turn go by the digest of role and text. Empty tables
give no nodes; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from voltmesh.operators.skew import join_apart

from .common import crc32_sql, settle

#: Bytes of a turn in a path: the digest and the size of the text.
DIGEST, SIZE = 16, 8
STEP = DIGEST + SIZE
#: Conversations of a shard, about.
SHARD_ROWS = 100_000
#: Of nine: crc32 of the id modulo this says how many turns come from the base.
HEADS, FAMILY = 9, 5
DONE, HANGING, PARTIAL, ENDS = range(4)

NODE = (
    "kind int, id string, parent_id string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("id", pa.string()), ("parent_id", pa.string())]
    + [
        (c, pa.int64())
        for c in "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()
    ]
    + [("ends", pa.string())]
)


def own_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, steps): the turns in order as text of 48 hexadecimal digits a turn."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", known("role"), known("text")
    )
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    size = F.lpad(F.hex(F.octet_length("text").cast("bigint")), 2 * SIZE, "0")
    step = F.concat(F.substring(F.sha2(whole, 256), 1, 2 * DIGEST), size)
    in_order = F.sort_array(F.collect_list(F.struct("turn", "step")))
    steps = F.array_join(F.transform(in_order, lambda s: s["step"]), "")
    narrow = rows.select("conv_id", "turn", step.alias("step"))
    return narrow.groupBy("conv_id").agg(steps.alias("steps"))


def rebuilt_paths(own: DataFrame) -> DataFrame:
    """(conv_id, path): the first h turns of the family's base, then the own turns after the first h."""
    width = 2 * STEP
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    head = F.substring("steps", 1, width * (HEADS - 1))
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_base"), head.alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    taken = F.substring(F.coalesce("_head", F.lit("")), F.lit(1), h * width)
    kept = F.substring(F.col("steps"), h * width + 1, F.length("steps"))
    joined = own.withColumn("_base", base).join(heads, "_base", "left")
    return joined.select("conv_id", F.unhex(F.concat(taken, kept)).alias("path"))


class Node:
    __slots__ = ("bare", "conv", "depth", "ends", "kids", "leaves", "left", "n", "n_kids", "saved", "size")

    def __init__(self, depth: int, size: int, left: bool):
        self.depth, self.size, self.left, self.bare = depth, size, left, True
        self.conv, self.n, self.n_kids, self.leaves, self.saved = None, 0, 0, 0, 0
        self.kids: list[tuple] = []
        self.ends: list[int] = []


def _id(path: bytes, depth: int) -> str:
    """The name of a skeleton node, the same in every shard."""
    return f"{depth}:{hashlib.sha256(path[: depth * STEP]).hexdigest()[:32]}"


def _sha(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


class Shard:
    """The trie of one range of sorted paths, with `left` and `right` the depths of the skeleton there."""

    def __init__(self, left: int, right: int):
        self.left, self.right = left, right
        self.path, self.open = b"", []
        self.out: list[tuple] = []

    def add(self, path: bytes, conv: int) -> None:
        depth = len(path) // STEP
        if not self.open:
            shared, first = -1, True
        else:
            shared, first = 0, False
            most = min(depth, len(self.open) - 1)
            while shared < most and path[shared * STEP : (shared + 1) * STEP] == self.path[shared * STEP : (shared + 1) * STEP]:
                shared += 1
            while len(self.open) > shared + 1:
                self._close(False)
        self.path = path
        for d in range(shared + 1, depth + 1):
            size = int.from_bytes(path[d * STEP - SIZE : d * STEP], "big") if d else 0
            self.open.append(Node(d, size, first and d <= self.left))
        end = self.open[-1]
        end.ends.append(conv)
        end.n += 1
        end.conv = conv if end.conv is None else min(end.conv, conv)

    def finish(self) -> None:
        while self.open:
            self._close(len(self.open) - 1 <= self.right)

    def _close(self, right: bool) -> None:
        """The deepest open node gets no more conversations here; `right`: but in the next shard."""
        node = self.open.pop()
        above = self.open[-1] if self.open else None
        if node.bare and not right:  # children come last, so a node's last shard knows of them
            node.leaves += 1
        node.saved += node.n * node.size - (0 if node.left else node.size)
        n_kids = node.n_kids + len(node.kids)
        if above is not None:
            above.bare = False
            above.n += node.n
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
            above.leaves += node.leaves
            above.saved += node.saved
        values = (node.n, n_kids, node.leaves, node.saved)
        if not (node.left or right):
            self.out += [(DONE, None, None, conv, depth, node.conv, *rest) for conv, depth, *rest in node.kids]
            row = (node.conv, node.depth, *values, _sha(node.ends))
            if above is not None:
                above.kids.append(row)
            else:
                self.out.append((DONE, None, None, row[0], row[1], None, *row[2:]))
            return
        name = _id(self.path, node.depth)
        self.out += [(HANGING, None, name, conv, depth, None, *rest) for conv, depth, *rest in node.kids]
        # A child that began in an earlier shard was counted there.
        if above is not None and not node.left:
            above.n_kids += 1
        parent = _id(self.path, node.depth - 1) if node.depth else None
        self.out.append((PARTIAL, name, parent, node.conv, node.depth, None, *values, None))
        if node.ends:
            text = ",".join(map(str, node.ends))
            self.out.append((ENDS, name, None, node.ends[0], node.depth, None, 0, 0, 0, 0, text))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)


def _shared(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths begin with in common; -1 without a neighbour."""
    if a is None or b is None:
        return -1
    depth = 0
    most = min(len(a), len(b)) // STEP
    while depth < most and a[depth * STEP : (depth + 1) * STEP] == b[depth * STEP : (depth + 1) * STEP]:
        depth += 1
    return depth


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut, first, last, before, behind = (c.to_pylist() for c in batch.columns)
        left = [_shared(a, b) for a, b in zip(before, first)]
        right = [_shared(a, b) for a, b in zip(last, behind)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cut, pa.int32()), pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["cut", "left", "right"]
        )


def prefix_trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, path): the root and one for each distinct beginning."""
    spark = paths.sparkSession
    paths = settle(paths, "paths")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(least, -(-paths.count() // SHARD_ROWS))
    cut = settle(
        paths.repartitionByRange(count, "path", "conv_id").withColumn("_cut", F.spark_partition_id()), "shards"
    )
    # One row for each shard: ordering them is a small task at any size of the table.
    ends = cut.groupBy("_cut").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    along = Window.orderBy("_cut")
    ends = ends.select(
        "_cut", "first", "last", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("behind")
    )
    measured = ends.mapInArrow(_measured, "cut int, left bigint, right bigint").collect()
    skeleton = {r["cut"]: (r["left"], r["right"]) for r in measured}

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            for at, path, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != number:
                    if shard is not None:
                        shard.finish()
                        yield _batch(shard.out)
                    number, shard = at, Shard(*skeleton[at])
                shard.add(path, conv)
            if shard is not None and shard.out:
                yield _batch(shard.out)
                shard.out = []
        if shard is not None:
            shard.finish()
            if shard.out:
                yield _batch(shard.out)

    order = ["_cut", "path", "conv_id"]
    dealt = cut.repartition(count, "_cut").sortWithinPartitions(*order).select(*order)
    found = settle(dealt.mapInArrow(grow, NODE), "nodes")
    return _joined(found)


def _joined(found: DataFrame) -> DataFrame:
    """Skeleton nodes from their partial rows, and the parents of what hangs on them."""
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = found.filter(F.col("kind") == PARTIAL).groupBy("id", "parent_id", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums]
    )
    # Ids that end at a skeleton node pass in order, a stretch of a shard at a time.
    pieces = found.filter(F.col("kind") == ENDS).select("id", "conv_id", "ends")
    ended = pieces.repartition("id").sortWithinPartitions("id", "conv_id").mapInArrow(_ended, "id string, ends string")
    nothing = hashlib.sha256().hexdigest()
    bones = whole.join(ended, "id", "left").withColumn("ends", F.coalesce("ends", F.lit(nothing)))
    bones = settle(bones, "skeleton")
    names = bones.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    hanging = join_apart(found.filter(F.col("kind") == HANGING).drop("parent_conv_id"), names, ["parent_id"])
    inner = join_apart(bones, names, ["parent_id"], "left")
    columns = ["conv_id", "depth", "parent_conv_id", *sums, F.col("ends").alias("ends_sha256")]
    done = found.filter(F.col("kind") == DONE)
    return done.select(*columns).unionAll(hanging.select(*columns)).unionAll(inner.select(*columns))


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, sha = None, None
    make = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["id", "ends"])
    for batch in batches:
        out = []
        for at, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != name:
                if sha is not None:
                    out.append((name, sha.hexdigest()))
                name, sha = at, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(text.encode())
        if out:
            yield make(out)
    if sha is not None:
        yield make([(name, sha.hexdigest())])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each rebuilt on the beginning of its family's base."""
    own = settle(own_paths(conversations), "own")
    return prefix_trie(rebuilt_paths(own))


def trie_sql() -> str:
    """The same nodes by grouping whole prefixes."""
    return f"""with rows as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, role, text) as n
        from conversations where conv_id is not null),
    lengths as (select conv_id, max(n) as n from rows group by conv_id),
    ids as (select conv_id, n, conv_id - conv_id % {FAMILY} as base,
        {crc32_sql('conv_id::varchar')} % {HEADS} as h from lengths),
    turns as (
        select i.conv_id, r.n as d, r.role, r.text from ids i join rows r on r.conv_id = i.base and r.n <= i.h
        union all
        select i.conv_id, r.n - i.h + least(i.h, coalesce(b.n, 0)), r.role, r.text
        from ids i join rows r on r.conv_id = i.conv_id and r.n > i.h left join lengths b on b.conv_id = i.base),
    paths as (
        select i.conv_id, list_filter(list({{'role': t.role, 'text': t.text}} order by t.d),
            lambda x: x.role is not null) as path
        from ids i left join turns t on t.conv_id = i.conv_id group by i.conv_id),
    members as (
        select conv_id, path, unnest(range(0, len(path) + 1)) as depth from paths),
    nodes as (
        select path[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
            coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(path) = depth), '') as ended
        from members group by all),
    families as (select prefix[1:depth - 1] as prefix, count(*) as n from nodes where depth > 0 group by all),
    sized as (
        select a.*, coalesce(f.n, 0) as n_children,
            case when a.depth = 0 then 0 else (a.n_convs - 1) * strlen(a.prefix[a.depth].text) end as saved
        from nodes a left join families f on f.prefix = a.prefix),
    above as (
        select unnest(range(0, depth + 1)) as k, prefix, (n_children = 0)::int as leaf, saved from sized),
    sums as (
        select prefix[1:k] as prefix, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
        from above group by all)
    select a.conv_id, a.depth, p.conv_id as parent_conv_id, a.n_convs, a.n_children, s.n_leaves, s.saved_tokens,
        sha256(a.ended) as ends_sha256
    from sized a join sums s on s.prefix = a.prefix
    left join nodes p on a.depth > 0 and p.prefix = a.prefix[1:a.depth - 1] and p.depth = a.depth - 1"""
