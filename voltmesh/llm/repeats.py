"""Exact repeats of `least` bytes and more, by run-length BWT indexes over candidate regions.

A byte is removed if some string of `least` bytes that covers it also starts elsewhere.

Candidates. In every string of `least` bytes the gram (a quarter as long) of the least hash is
an anchor, so equal strings hold equal anchors at equal places. An anchor's key is
the hash of its gram; around it lies its snippet, all bytes that a string with this
anchor can reach. No repeat goes through a key that occurs once; counts per key, combined before
the shuffle, take these out. Of each other key all different snippets are indexed, and those that
occur again a second time, from another place. Further copies of a snippet, which no index
needs, are found by the 128-bit digest of their bytes and go as the first two do.

Index. A task takes the snippets of some keys, at most a bounded number of bytes, joins
those that overlap in their text, and builds the Burrows-Wheeler transform of all of them
in runs: heads, lengths, and at the ends of runs the suffix and its match with the
neighbour across the border. This is what is kept; it is as long as the runs are many, not as the
text. Between samples a match shortens by one per byte, so the longest
match of every position with any other is streamed from the samples in text order.
Places where it reaches `least` are marked.

All snippets of a key go to one index. Keys that share texts are put together, so that
snippets overlap and each byte is indexed about once. Keys with very many
snippets are split by more context, left and right of the gram, until the parts
are small or the string itself is the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmesh.operators.skew import join_apart
from voltmesh.session import workspace

from .common import map_arrow, pieces, settle

LEAST = 400
#: Bytes of a gram, for each `least`.
GRAMS = 4
#: Snippets of one key that are indexed together; more are split first.
GROUP_ROWS = 2_000
#: Ranges that a full key's range is cut into at a time.
SPLITS = 4
#: Bytes indexed together; with one more group they must stay under 2^21.
INDEX_BYTES = 600_000
#: Bytes of text looked at together when anchors are chosen.
STRIDE = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


# ---- Anchors ----------------------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over each run of `width` values."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all strings of `least` bytes in texts that lie
    one after the other, each at least that long; `ends` has the end of each."""
    gram = least // GRAMS
    width, count = least - gram + 1, len(data)
    sums = np.zeros(count + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, count), out=sums[1:])
    # each byte of a gram came with the power of its place; this takes the gram's place out again
    hashes = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, count - gram + 1)
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    rank = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    lowest = _sliding(rank, width, np.minimum)
    valid = np.ones(len(lowest), dtype=bool)  # strings that lie within one text
    for end in ends[:-1]:
        valid[max(0, end - least + 1) : end] = False
    lowest[~valid] = 0
    edge = np.zeros(width - 1, dtype=np.uint32)
    reached = _sliding(np.concatenate([edge, lowest, edge]), width, np.maximum)
    at = np.flatnonzero(reached == rank)
    return at, hashes[at]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _cut(data: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """A long text in parts that overlap so that each string of `least` bytes lies in one."""
    for begin in range(0, max(1, len(data) - least + 1), STRIDE):
        yield begin, data[begin : begin + STRIDE + least - 1]


# ---- The run-length index ---------------------------------------------------------------


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes of all texts in order. `text` has the texts one after the other, without ends;
    a text that ends is before one that goes on, equal suffixes are in the order of texts."""
    count, place = len(text), np.arange(len(text))
    left = np.repeat(ends, np.diff(ends, prepend=0)) - place  # bytes up to the end of the text
    longest = int(left.max(initial=0))
    present = np.zeros(256, dtype=bool)
    present[text] = True
    codes = np.cumsum(present)
    bits = int(codes[-1]).bit_length()
    size = 63 // bits
    coded = np.concatenate([codes[text], np.zeros(size, dtype=np.int64)])
    rank = coded[:count].copy()
    for i in range(1, size):
        rank = (rank << bits) | np.where(left > i, coded[i : i + count], 0)
    width = count.bit_length()
    while True:
        order = np.argsort(rank)
        ordered = rank[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        if fresh.all():
            return order
        dense = np.empty(count, dtype=np.int64)
        dense[order] = np.cumsum(fresh)
        if size >= longest:
            return np.sort((dense << width) | place) & ((1 << width) - 1)
        rank = dense.copy()
        for step in range(size, size * (63 // width), size):
            rank <<= width
            if step < count:
                rank[: count - step] |= np.where(left[: count - step] > step, dense[step:], 0)
        size *= 63 // width


class RunIndex(NamedTuple):
    """The transform of some texts in runs. Runs end at the beginning of a text as well."""

    heads: np.ndarray  # byte of each run, -1 for the beginning of a text
    lengths: np.ndarray
    first: np.ndarray  # place of the suffix at the first and at the last row of each run
    last: np.ndarray
    shared: np.ndarray  # bytes that the last suffix of a run shares with the first of the next
    size: int  # bytes indexed

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the suffixes on both sides of the borders, and the bytes shared across."""
        return np.concatenate([self.last[:-1], self.first[1:]]), np.concatenate([self.shared] * 2)


def run_index(text: np.ndarray, ends: np.ndarray) -> RunIndex:
    """The index of texts that lie one after the other."""
    order = suffix_order(text, ends)
    head = np.zeros(len(text), dtype=bool)
    head[np.concatenate([[0], ends[:-1]])] = True
    before = np.where(head[order], -1, text[order - 1].astype(np.int16)).astype(np.int16)
    starts = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] < 0)]))
    heads, lengths = before[starts], np.diff(starts, append=len(text))
    first, last = order[starts], order[starts + lengths - 1]
    del order, before, head
    one, two = last[:-1], first[1:]
    shared = _shared(text, one, two, np.minimum(_left(one, ends), _left(two, ends)))
    return RunIndex(heads, lengths, first, last, shared, len(text))


def _left(place: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes from each place to the end of its text."""
    return ends[np.searchsorted(ends, place, side="right")] - place


def _shared(text: np.ndarray, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal bytes from each place of `one` and `two` on, at most `most`."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    words = np.zeros(len(text), dtype=np.uint64)
    for i in range(8):
        words |= padded[i : i + len(text)].astype(np.uint64) << np.uint64(8 * i)
    out = np.zeros(len(one), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        at = out[live]
        differ = words[one[live] + at] ^ words[two[live] + at]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        out[live] = np.minimum(at + equal, most[live])
        live = live[(equal == 8) & (out[live] < most[live])]
    return out


def longest_matches(index: RunIndex) -> np.ndarray:
    """For each place the longest match with any other place, streamed from the samples."""
    place, shared = index.samples()
    reach = np.zeros(index.size, dtype=np.int64)
    np.maximum.at(reach, place, place + shared)
    return np.maximum.accumulate(reach) - np.arange(index.size)


def repeated_strings(slices: list[tuple], least: int) -> list[tuple]:
    """What repeats in slices (text, start, bytes) of texts: (text, start, end) of runs covered by
    strings that another place, of the same or of another slice, has as well. Slices that
    overlap are joined first, so no place is there twice."""
    segments: list[tuple] = []
    for owner, start, data in sorted(slices, key=lambda s: s[:2]):
        if segments and segments[-1][0] == owner and segments[-1][1] + len(segments[-1][2]) >= start:
            had = segments[-1][2]
            had += data[max(0, segments[-1][1] + len(had) - start) :]
        else:
            segments.append((owner, start, bytearray(data)))
    segments = [s for s in segments if len(s[2]) >= least]
    if not segments:
        return []
    text = np.frombuffer(b"".join(s[2] for s in segments), dtype=np.uint8)
    ends = np.cumsum([len(s[2]) for s in segments])
    at = np.flatnonzero(longest_matches(run_index(text, ends)) >= least)
    if not len(at):
        return []
    owner = np.searchsorted(ends, at, side="right")
    fresh = np.concatenate([[True], (at[1:] > at[:-1] + least) | (owner[1:] != owner[:-1])])
    low = at[fresh]
    high = np.append(at[:-1][fresh[1:]], at[-1]) + least
    out = []
    for a, b, k in zip(low.tolist(), high.tolist(), owner[fresh].tolist()):
        name, start, data = segments[k]
        shift = start - (int(ends[k]) - len(data))
        out.append((name, a + shift, b + shift))
    return out


# ---- Candidates in Spark ----------------------------------------------------------------

#: Bytes of a text whose keys are put together.
SPAN = 4_096


def distinct_texts(docs: DataFrame, least: int) -> DataFrame:
    """digest, text, size and copies of all different texts of at least `least` bytes, as a table
    in buckets by digest, so that the joins to come do not move the texts again."""
    spark = docs.sparkSession
    long = docs.filter(F.octet_length("text") >= least).select(digest_of().alias("digest"), "text")
    one = long.groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    one = one.withColumn("size", F.octet_length("text").cast("bigint"))
    path = workspace(spark, "texts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = one.write.bucketBy(buckets, "digest").option("path", path).option("compression", "zstd")
    writer.saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files are the caller's
    return out


def digest_of() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def _bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    found = batch.column(batch.schema.get_field_index(column))
    return found.cast(pa.large_binary() if pa.types.is_large_string(found.type) else pa.binary()).to_pylist()


def _anchor_places(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and key of all anchors."""
    parts = [
        (i, begin, part)
        for i, t in enumerate(texts)
        for begin, part in _cut(np.frombuffer(t, np.uint8), least)
    ]
    found, group, held = [], [], 0
    for n, part in enumerate(parts):
        group.append(part)
        held += len(part[2])
        if held >= STRIDE or n == len(parts) - 1:
            sizes = np.array([len(p[2]) for p in group])
            ends = np.cumsum(sizes)
            at, keys = anchors(np.concatenate([p[2] for p in group]), ends, least)
            which = np.searchsorted(ends, at, side="right")
            place = at - (ends - sizes)[which] + np.array([p[1] for p in group])[which]
            found.append((np.array([p[0] for p in group])[which], place, keys.view(np.int64)))
            group, held = [], 0
    if not found:
        return (np.empty(0, np.int64),) * 3
    owner, place, keys = (np.concatenate(x) for x in zip(*found))
    _, first = np.unique(owner * (int(place.max(initial=0)) + 1) + place, return_index=True)
    return owner[first], place[first], keys[first]


def occurrences(texts: DataFrame, least: int) -> DataFrame:
    """key, snip (128-bit digest of the snippet), digest, pos and size of the text, of all anchors."""
    before = least - least // GRAMS

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        from xxhash import xxh3_128_digest

        rows = _bytes(batch, "text")
        owner, place, keys = _anchor_places(rows, least)
        snips = [
            # with the place of the gram: two grams of a short text can have all of it around them
            xxh3_128_digest(rows[i][max(0, p - before) : p + least], min(p, before))
            for i, p in zip(owner.tolist(), place.tolist())
        ]
        digests = batch.column(batch.schema.get_field_index("digest")).take(pa.array(owner))
        sizes = np.array([len(t) for t in rows], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(snips, pa.binary()), digests, pa.array(place), pa.array(sizes[owner])],
            names=["key", "snip", "digest", "pos", "size"],
        )

    return map_arrow(
        texts.select("digest", "text"), run, "key long, snip binary, digest binary, pos long, size long", limit=STRIDE
    )


def _around(least: int) -> list[Column]:
    """Start and end of the snippet of an anchor."""
    before = least - least // GRAMS
    return [
        F.greatest(F.col("pos") - before, F.lit(0)).cast("bigint").alias("start"),
        F.least(F.col("pos") + least, F.col("size")).alias("end"),
    ]


def repeated_runs(texts: DataFrame, least: int) -> DataFrame:
    """digest, start, end of runs of repeated bytes in the different texts; they may overlap."""
    copied = texts.filter("copies > 1").select("digest", F.lit(0).cast("bigint").alias("start"), F.col("size").alias("end"))
    found = settle(occurrences(texts, least), "anchors")
    again = settle(found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "keys")
    # One plan at every size: a broadcast of few keys would only hide what this shuffle costs.
    repeated = settle(found.join(again.hint("merge"), "key"), "repeated")
    place = F.struct("digest", "pos", "size")
    snips = repeated.groupBy("key", "snip").agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("second")
    )
    snips = settle(snips, "snippets")
    more = snips.filter("n > 2").select("key", "snip")
    further = join_apart(repeated, more, ["key", "snip"], "left_semi").select("digest", *_around(least))
    firsts = snips.select("key", "n", "first.*")
    pairs = firsts.unionAll(snips.filter("n > 1").select("key", "n", "second.*"))
    keys = _keys(pairs)
    full = keys.filter(F.col("rows") > GROUP_ROWS).select("key")
    slices = _together(pairs.drop("n"), keys.filter(F.col("rows") <= GROUP_ROWS), texts, least)
    runs = copied.unionAll(further)
    if not full.isEmpty():
        # a split starts from one of each snippet, so what is there twice goes as a whole
        pair = pairs.filter("n = 2").join(full, "key", "left_semi").select("digest", *_around(least))
        split, equal = _split(firsts.drop("n").join(full, "key", "left_semi"), texts, least)
        slices, runs = slices.unionAll(split), runs.unionAll(pair).unionAll(equal)
    return runs.unionAll(indexed(slices, least))


def _keys(snippets: DataFrame) -> DataFrame:
    """key, rows (snippets to be indexed), and a mark that keys of the same copies share.

    The mark follows from the least key of the texts that a key occurs in and from its least
    place there. The window is over the anchors of one text.
    """
    other = F.min("key").over(Window.partitionBy("digest"))
    of_key = snippets.withColumn("other", other).groupBy("key").agg(
        F.count("*").alias("rows"), F.min("other").alias("other"), F.min("pos").alias("at")
    )
    mark = F.xxhash64("other", F.floor(F.col("at") / SPAN))
    return settle(of_key.select("key", "rows", mark.alias("mark")), "marks")


def _together(snippets: DataFrame, keys: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """group, digest, start, data: what is to be indexed of each text, by groups of keys.

    Keys with one mark are a group; one with many rows is cut by key.
    """
    parts = F.ceil(F.sum("rows").over(Window.partitionBy("mark")) / GROUP_ROWS)
    group = F.xxhash64("mark", F.pmod(F.xxhash64("key"), parts)).alias("group")
    wanted = snippets.join(keys.select("key", group), "key")
    return _slices(wanted.select("digest", F.struct("group", *_around(least)).alias("want")), texts)


def _slices(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The bytes of the wanted parts (group, start, end), joined where they overlap in a group."""
    listed = wanted.groupBy("digest").agg(F.collect_set("want").alias("wants"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        wants = batch.column(batch.schema.get_field_index("wants")).to_pylist()
        names = batch.column(batch.schema.get_field_index("digest")).to_pylist()
        for digest, text, parts in zip(names, _bytes(batch, "text"), wants):
            open_: tuple | None = None
            for group, start, end in sorted((w["group"], w["start"], w["end"]) for w in parts):
                if open_ and open_[0] == group and open_[2] >= start:
                    open_ = (group, open_[1], max(end, open_[2]))
                    continue
                if open_:
                    out.append((open_[0], digest, open_[1], text[open_[1] : open_[2]]))
                open_ = (group, start, end)
            if open_:
                out.append((open_[0], digest, open_[1], text[open_[1] : open_[2]]))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        columns = [pa.array([r[i] for r in out], kinds[i]) for i in range(4)]
        return pa.RecordBatch.from_arrays(columns, names=["group", "digest", "start", "data"])

    joined = texts.join(listed, "digest").select("digest", "text", "wants")
    return map_arrow(joined, run, "group long, digest binary, start long, data binary")


def indexed(slices: DataFrame, least: int) -> DataFrame:
    """digest, start, end of what repeats within the groups, several small groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for piece in pieces(batch):
                for row in zip(*(c.to_pylist() for c in piece.columns)):
                    if size >= INDEX_BYTES and row[0] != last:
                        yield _runs(repeated_strings(held, least))
                        held, size = [], 0
                    last = row[0]
                    held.append(row[1:])
                    size += len(row[3])
        yield _runs(repeated_strings(held, least))

    ordered = slices.repartition("group").sortWithinPartitions("group")
    ordered = ordered.select("group", "digest", "start", "data")
    return ordered.mapInArrow(run, "digest binary, start long, end long")


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[i]) for i in range(3)], names=["digest", "start", "end"]
    )


def _split(firsts: DataFrame, texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Snippets of full keys: slices in groups small enough to index, and runs that are certain.

    A string of `least` bytes around a gram has r more bytes to its right, r from 0 to
    `before`, the rest to its left. A row stands for a range of r. Its group shares the gram,
    the fewest bytes to the right and the fewest to the left that the range allows, so equal
    strings are in one group; its slice is all that strings of the range reach. Equal
    slices are removed as a whole and go on as one row. Groups that still have many rows
    have their range cut again, at last to one string.
    """
    gram = least // GRAMS
    before = least - gram
    wanted = firsts.select("digest", F.struct(F.col("pos").alias("group"), *_around(least)).alias("want"))
    slices = _slices(wanted, texts).withColumnRenamed("group", "pos")  # one place, so none joined
    rows = slices.join(firsts.select("digest", "pos", "key"), ["digest", "pos"]).select(
        "key", "digest", "pos", "start", "data", F.lit(0).alias("low"), F.lit(before + 1).alias("high")
    )
    levels, kinds, groups = [], [], []
    while True:
        wide = F.col("high") - F.col("low")
        cuts = [(F.col("low") + F.floor(wide * i / SPLITS)).cast("int") for i in range(SPLITS + 1)]
        ranges = F.array(*[F.struct(x.alias("a"), y.alias("b")) for x, y in zip(cuts, cuts[1:])])
        cut = rows.withColumn("range", F.explode(ranges)).select("*", "range.*").filter("a < b")
        at = (F.col("pos") - F.col("start")).cast("int")  # of the gram in the slice
        left, right = F.lit(before + 1) - F.col("b"), F.col("a")  # bytes that a group shares
        begin = F.greatest(at - (F.lit(before) - F.col("a")), F.lit(0))
        end = F.least(at + gram + F.col("b") - 1, F.octet_length("data"))
        fits = (at >= left) & (at + gram + right <= F.octet_length("data")) & (end - begin >= least)
        shared = F.substring("data", at - left + 1, left + gram + right)
        own = F.substring("data", begin + 1, end - begin)
        level = cut.filter(fits).select(
            F.xxhash64("key", "a", "b", shared).alias("group"),
            F.concat_ws(":", F.md5(own), at - begin).alias("full"),
            "key", "digest", "pos", (F.col("start") + begin).alias("start"), own.alias("data"),
            F.col("a").alias("low"), F.col("b").alias("high"),
        )
        levels.append(settle(level, "split"))
        row = F.struct("digest", "pos", "start", "data", "key", "low", "high")
        one = levels[-1].groupBy("group", "full").agg(F.count("*").alias("n"), F.min(row).alias("row"))
        kinds.append(settle(one, "slices"))
        sizes = kinds[-1].groupBy("group").agg(F.count("*").alias("rows")).filter("rows > 1")
        groups.append(settle(sizes, "sizes"))
        many = groups[-1].filter(F.col("rows") > GROUP_ROWS)
        if many.isEmpty():
            break
        rows = kinds[-1].join(many, "group").select("row.*")
    level, kind, size = (reduce(DataFrame.unionAll, tables) for tables in (levels, kinds, groups))
    equal = level.join(kind.filter("n > 1").select("group", "full"), ["group", "full"])
    few = kind.join(size.filter(F.col("rows") <= GROUP_ROWS), "group")
    end = F.col("start") + F.octet_length("data")
    return (
        few.select("group", "row.digest", "row.start", "row.data"),
        equal.select("digest", "start", end.alias("end")),
    )


# ---- The operator -----------------------------------------------------------------------


def without_repeats(docs: DataFrame, least: int = LEAST, with_bytes: bool = False) -> DataFrame:
    """digest, n_removed, n_spans and kept_sha256 (and kept, the bytes left) of every different
    text from which something is removed. The digest is the md5 of the text as binary."""
    texts = distinct_texts(docs, least)
    runs = repeated_runs(texts, least)
    listed = runs.groupBy("digest").agg(F.collect_set(F.struct("start", "end")).alias("runs"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        from hashlib import sha256

        rows = []
        found = batch.column(batch.schema.get_field_index("runs")).to_pylist()
        for text, own in zip(_bytes(batch, "text"), found):
            kept, at, spans, removed = [], 0, 0, 0
            for start, end in _joined((r["start"], r["end"]) for r in own):
                kept.append(text[at:start])
                spans, removed, at = spans + 1, removed + end - start, end
            left = b"".join([*kept, text[at:]])
            rows.append((removed, spans, sha256(left).hexdigest(), left))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(3 + with_bytes)]
        digests = batch.column(batch.schema.get_field_index("digest"))
        return pa.RecordBatch.from_arrays([digests, *columns], names=names)

    names = ["digest", "n_removed", "n_spans", "kept_sha256", "kept"][: 4 + with_bytes]
    kinds = ["binary", "long", "long", "string", "binary"]
    joined = texts.join(listed, "digest").select("digest", "text", "runs")
    return map_arrow(joined, run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _joined(runs) -> list[tuple[int, int]]:
    """Runs that touch or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeat_list(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    Null texts count as empty. A text that is there twice goes whole if it has `least`
    bytes; shorter texts stay whole. Repeated rows are copies like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        digest_of().alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.sha2(text, 256).alias("own"),
    )
    rows = settle(rows, "documents")
    found = without_repeats(docs, least)
    out = join_apart(rows, found, ["digest"], "left")
    return out.select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"),
    )


def repeat_sql(least: int = LEAST) -> str:
    """The same list in DuckDB, by the md5 of every string of `least` bytes, written as hex."""
    return f"""
        with docs as (
            select row_number() over () as rid, doc_id, hex(coalesce(text, '')) as h from documents),
        strings as (
            select rid, s, md5(substr(h, 2 * s + 1, {2 * least})) as w
            from (select rid, h, unnest(range(0, length(h) // 2 - {least} + 1)) as s from docs)),
        marked as (
            select rid, s from (select rid, s, count(*) over (partition by w) as n from strings) where n > 1),
        fresh as (
            select rid, s, coalesce(s > lag(s) over (partition by rid order by s) + {least}, true) as first
            from marked),
        numbered as (
            select rid, s, sum(first::int) over (partition by rid order by s) as run from fresh),
        runs as (
            select rid, run, min(s) as a, max(s) + {least} as b from numbered group by rid, run),
        gaps as (
            select r.rid, r.a, r.b,
                substr(h, 2 * coalesce(lag(r.b) over w, 0) + 1, 2 * (r.a - coalesce(lag(r.b) over w, 0))) as before
            from runs r join docs using (rid) window w as (partition by r.rid order by r.a)),
        cut as (
            select rid, string_agg(before, '' order by a) as front, max(b) as tail,
                sum(b - a)::bigint as n_removed, count(*) as n_spans
            from gaps group by rid)
        select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
            coalesce(n_spans, 0)::bigint as n_spans,
            sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(tail, 0) + 1))) as kept_sha256
        from docs left join cut using (rid)"""
