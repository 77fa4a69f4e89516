"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are read as letters and digits, lower-cased, with one blank for all that lies between.
Benchmark items are cut into overlapping windows. A part of a document that matches a
window of m characters with at most e edits shares at least m - q + 1 - q * e of its
q-grams with it, on diagonals (place in the document minus place in the window) at most e
apart. So shared q-grams are counted in bands of diagonals that overlap by e; bands with
fewer are dropped and the rest are aligned, within the band, to the true number of edits.

Windows start at every STEP-th character only. So in what they leave, every stretch of an
item of EXCERPT characters or more is looked for as well, from whatever character it starts.
A stretch of twice that length within the rate of edits has a half within it, so lengths up
to there are enough. The same count of shared q-grams says which starts to align.

Items too short for q-grams to tell are looked for as they are, from one word to the next.

The windows of a bounded number of benchmark characters go to every task as one index; a
larger benchmark is cut into several such blocks. The different texts meet one block after the other, what
each finds is written, and the driver and the tasks hold one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from voltmesh.operators.skew import join_apart

from .common import digits, map_arrow, settle, texts_of

#: Characters of a q-gram, of a window, between window starts, of the shortest item that has windows.
Q, WINDOW, STEP, SHORTEST = 8, 96, 48, 32
#: Characters of the shortest stretch found from any start of a longer item, and of the longest aligned.
EXCERPT, LONGEST = 64, 127
#: Edits allowed per character of a window.
EDIT_RATE = 0.1
#: Benchmark characters in one block of the index, about 24 bytes each in memory.
BLOCK_CHARS = 2_000_000
#: Bits of the table that most q-grams of documents are turned away by.
FILTER_BITS = 22
#: Diagonals in a coarse band, over twice the most edits; bits of the table they are counted in.
COARSE, COUNTER_BITS = 32, 21
#: Band cells aligned at once, characters of a document's text looked at together.
CELLS, STRIDE = 1 << 20, 1 << 20
_GAP, _WALL = 32, 0
_FAR = 256  # more than any edits; a row of the band of these stays below 2**15


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points as compared, and the place of each in the text. NUL characters stay, as walls."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, dtype=bool)
    seen[codes] = True
    table = np.full(0x110000, _GAP, dtype=np.uint32)
    for code in np.flatnonzero(seen):
        low = chr(code).lower()
        if chr(code).isalnum():
            table[code] = ord(low) if len(low) == 1 else code
    table[0] = _WALL
    out = table[codes]
    keep = out != _GAP
    keep[1:] |= (out[:-1] != _GAP) & (out[:-1] != _WALL)
    at = np.flatnonzero(keep)
    return out[at], at


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All of the ranges low to high, one after the other."""
    counts = high - low
    return np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)


def _trimmed(codes: np.ndarray) -> np.ndarray:
    return codes[:-1] if len(codes) and codes[-1] == _GAP else codes


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of each Q characters, Q being a power of two."""
    value, size, power = codes.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while size < Q:
        value = value[:-size] * np.uint64(power) + value[size:]
        size, power = 2 * size, power * power % 2**64
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(29))


@cache
def automaton(words: tuple[str, ...]):
    """Finds all words in one pass over a text; a task makes it once."""
    from ahocorasick import Automaton

    out = Automaton()
    for word in words:
        out.add_word(word, word)
    out.make_automaton()
    return out


@dataclass(frozen=True)
class Index:
    """Windows of some benchmark items and where each q-gram occurs in the items."""

    owner: np.ndarray  # item of a window
    start: np.ndarray  # place of a window in `codes`
    size: np.ndarray  # characters of a window
    edits: np.ndarray  # most edits
    codes: np.ndarray  # all items, one after the other
    item: np.ndarray  # item of each place in `codes`
    hashes: np.ndarray  # distinct q-grams, ascending
    first: np.ndarray  # first entry of each q-gram in `place`, and their end
    place: np.ndarray  # where in `codes` it occurs
    filter: np.ndarray
    window_first: np.ndarray  # first entry in `windows` of each place in `codes`, and their end
    windows: np.ndarray  # windows that hold the whole q-gram of a place
    allowed: np.ndarray  # most edits of a stretch of each length up to LONGEST
    short: dict  # items under SHORTEST characters, by what they say

    def whole(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Item, first and last place of the short items that stand in a text from word to word."""
        if not self.short:
            return []
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        edge = (chr(_GAP), chr(_WALL))
        out = []
        for last, said in automaton(tuple(self.short)).iter(text):
            first = last - len(said) + 1
            if (first == 0 or text[first - 1] in edge) and (last + 1 == len(text) or text[last + 1] in edge):
                out += [(item, first, last, 0) for item in self.short[said]]
        return out

    @property
    def least(self) -> np.ndarray:
        """q-grams that a match of each window shares at least."""
        return self.size - Q + 1 - Q * self.edits

    @property
    def least_of_stretch(self) -> np.ndarray:
        """q-grams that a match of a stretch shares at least, by its length."""
        return np.arange(LONGEST + 1) - Q + 1 - Q * self.allowed

    def shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `codes` and in the items of the q-grams that both have, except those on
        diagonals with too few around them.

        A match shares at least `fewest` q-grams of its item on diagonals less than COARSE / 2 apart,
        so they lie together in one of two rows of coarse bands, shifted by half a band.
        Bands are counted by hash, so a count may be too high, never too low.
        """
        ours, theirs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for begin in range(0, len(codes) - Q + 1 if len(self.hashes) else 0, STRIDE):
            hashes = gram_hashes(codes[begin : begin + STRIDE + Q - 1])
            at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
            found = hashes[at]
            entry = np.searchsorted(self.hashes, found)
            entry[entry == len(self.hashes)] = 0
            same = self.hashes[entry] == found
            at, entry = at[same], entry[same]
            row = _ranges(self.first[entry], self.first[entry + 1])
            ours.append(np.repeat(at + begin, self.first[entry + 1] - self.first[entry]))
            theirs.append(self.place[row])
        ours, theirs = np.concatenate(ours), np.concatenate(theirs)
        if not len(ours):
            return ours, theirs
        diagonal = ours - theirs + len(self.codes)
        fewest = min(self.least.min(), self.least_of_stretch[EXCERPT:].min())
        keep = np.zeros(len(ours), dtype=bool)
        for shift in (0, COARSE // 2):
            band = ((diagonal + shift) // COARSE * len(self.size) + self.item[theirs]).view(np.uint64)
            band = (band * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - COUNTER_BITS)).view(np.int64)
            keep |= np.bincount(band, minlength=1 << COUNTER_BITS)[band] >= fewest
        return ours[keep], theirs[keep]

    def candidates(self, codes: np.ndarray, ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and first diagonal of the bands that hold enough shared q-grams."""
        low, high = self.window_first[theirs], self.window_first[theirs + 1]
        window = self.windows[_ranges(low, high)]
        offset = np.repeat(theirs, high - low) - self.start[window]
        diagonal = np.repeat(ours, high - low) - offset
        edits = self.edits[window]
        band = diagonal // (edits + 1)
        also = diagonal - band * (edits + 1) < edits  # these are in the band before as well
        window = np.concatenate([window, window[also]])
        offset = np.concatenate([offset, offset[also]])
        band = np.concatenate([band, band[also] - 1])
        wide = len(codes) + 2 * WINDOW + 2
        keys = np.unique((window * wide + (band + WINDOW + 1)) * WINDOW + offset) // WINDOW
        keys, counts = np.unique(keys, return_counts=True)
        window, band = keys // wide, keys % wide - WINDOW - 1
        keep = counts >= self.least[window]
        window, band = window[keep], band[keep]
        return window, band * (self.edits[window] + 1)

    def matches(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Item, first and last place in `codes`, edits of each band that aligns with a window."""
        return self._windows(Walled(codes), *self.shared(codes))

    def search(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """As `matches`, and stretches from any start of the items of which a text has no window."""
        ours, theirs = self.shared(codes)
        if not len(ours):
            return []
        text = Walled(codes)
        found = self._windows(text, ours, theirs)
        return found + self._stretches(text, ours, theirs, found)

    def _windows(self, text: Walled, ours, theirs) -> list[tuple[int, int, int, int]]:
        window, low = self.candidates(text.codes, ours, theirs)
        out = []
        for shape in np.unique(self.size[window] * (WINDOW + 1) + self.edits[window]):
            size, edits = int(shape) // (WINDOW + 1), int(shape) % (WINDOW + 1)
            own = np.flatnonzero((self.size[window] == size) & (self.edits[window] == edits))
            group = max(1, CELLS // (4 * edits + 2))
            for i in range(0, len(own), group):
                part = own[i : i + group]
                out += self._aligned(text, window[part], low[part], size, edits)
        return out

    def _aligned(self, text: Walled, window, low, size: int, edits: int) -> list[tuple[int, int, int, int]]:
        """Edits between a window and the best part of the text within the band's diagonals."""
        width = 4 * edits + 1  # the band, 2 * edits + 1 wide, and edits on either side
        base = low - edits
        cost = np.zeros((len(window), width), dtype=np.int16)
        rows, walled = text.rows(width), bool(text.near_wall(base, size + width).any())
        for i in range(size):
            cost = text.next(rows, cost, base + i, self.codes[self.start[window] + i], walled)
        found = cost.min(axis=1)
        end = cost.argmin(axis=1)
        return [
            (int(self.owner[w]), max(0, int(b + k)), min(len(text.codes), int(b + k + size)) - 1, int(c))
            for w, b, k, c in zip(window, base, end, found)
            if c <= edits
        ]

    def _stretches(self, text: Walled, ours, theirs, found) -> list[tuple[int, int, int, int]]:
        """Item, first and last place, edits of the stretches that align, but for items `found` in a text."""
        texts = np.cumsum(text.codes == _WALL)
        owners = self.owner[self.windows[self.window_first[theirs]]]
        seen = [int(texts[(first + last) // 2]) * (len(self.codes) + 1) + item for item, first, last, _ in found]
        keep = ~np.isin(texts[ours] * (len(self.codes) + 1) + owners, seen)
        ours, theirs = ours[keep], theirs[keep]
        if not len(ours):
            return []
        diagonal = ours - theirs + len(self.codes)
        rows = [self._starts((diagonal + shift) // COARSE, theirs, shift) for shift in (0, COARSE // 2)]
        start, low, size = (np.concatenate(x) for x in zip(*rows))
        most = int(self.allowed.max())
        width = COARSE + 2 * most
        out, group = [], max(1, CELLS // width)
        for i in range(0, len(start), group):
            out += self._longest(text, start[i : i + group], low[i : i + group] - most, size[i : i + group], width)
        return out

    def _starts(self, band, theirs, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the items from which a stretch may match, the first diagonal of its coarse band
        and its length: where as many places of the item lie near enough to each other as that asks for.

        Lengths at which one more edit is allowed are enough, as those between hold a stretch of
        such a length with as many. What is left without a first part of too many edits is within
        the rate as well, so a stretch longer than EXCERPT by Q or more starts with a shared q-gram.
        """
        wide = len(self.codes) + LONGEST
        hits = np.unique(band * wide + theirs)
        theirs = hits % wide
        begin = np.searchsorted(self.item, self.item[theirs])
        end = np.searchsorted(self.item, self.item[theirs], side="right")
        sizes = [EXCERPT, *(n for n in range(EXCERPT + 1, LONGEST + 1) if self.allowed[n] > self.allowed[n - 1])]
        keys = []
        for size in sizes:
            ahead = int(self.least_of_stretch[size]) - 1
            near = np.flatnonzero(hits[ahead:] - hits[: max(0, len(hits) - ahead)] <= size - Q)
            high = np.minimum(theirs[near], end[near] - size)
            low = np.maximum(theirs[near + ahead] + Q - size, begin[near])
            if size >= EXCERPT + Q:
                low = np.maximum(low, theirs[near])
            near, low, high = near[low <= high], low[low <= high], high[low <= high]
            keys.append(np.repeat(hits[near] // wide, high - low + 1) * wide + _ranges(low, high + 1))
        key, at = np.unique(np.concatenate(keys), return_index=True)  # the first, so the shortest
        size = np.repeat(sizes, [len(k) for k in keys])[at]
        return key % wide, key // wide * COARSE - shift - len(self.codes), size

    def _longest(self, text: Walled, start, base, size, width: int) -> list[tuple[int, int, int, int]]:
        """The stretch of at least `size` from each start with the fewest edits within the rate, the
        longest of them. If EXCERPT or more follows a first part of too many edits, the start of
        what follows is tried instead.
        """
        room = np.searchsorted(self.item, self.item[start], side="right") - start
        row, rows = np.arange(len(start)), text.rows(width)
        near = text.near_wall(base + start, LONGEST + width)
        cost = np.zeros((len(start), width), dtype=np.int16)
        most = np.full(len(start), self.allowed.max())
        edits, length, cell = (np.full(len(start), x, dtype=np.int64) for x in (_FAR, 0, 0))
        for i in range(LONGEST):
            pattern = self.codes[start[row] + i]
            cost = text.next(rows, cost, (base + start)[row] + i, pattern, bool(near[row].any()))
            least = cost.min(axis=1)
            if i + 1 >= EXCERPT:
                good = (least <= self.allowed[i + 1]) & (least <= edits[row])
                edits[row[good]], length[row[good]] = least[good], i + 1
                cell[row[good]] = cost.argmin(axis=1)[good]
            late = least > self.allowed[i + 1]
            most[row[late]] = np.minimum(most[row[late]], self.allowed[min(LONGEST, EXCERPT + i)])
            stay = (least <= np.minimum(most, edits)[row]) & (room[row] > i + 1)
            stay &= ~late | (size[row] <= EXCERPT + i)
            if not stay.all():
                row, cost = row[stay], cost[stay]
            if not len(row):
                break
        owner = self.owner[self.windows[self.window_first[start]]]
        first = base + start + cell
        return [
            (int(owner[w]), max(0, int(first[w])), min(len(text.codes), int(first[w] + length[w])) - 1, int(edits[w]))
            for w in np.flatnonzero(length)
        ]


class Walled:
    """A text with walls around it, read in bands of cells."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.margin = COARSE + 2 * WINDOW  # wider than any band
        edge = np.full(self.margin, _WALL, dtype=codes.dtype)
        self.padded = np.concatenate([edge, codes, edge])
        self.walls = np.flatnonzero(self.padded == _WALL)

    def _at(self, place: np.ndarray) -> np.ndarray:
        return np.clip(place + self.margin, 0, len(self.padded) - self.margin)

    def near_wall(self, place: np.ndarray, size: int) -> np.ndarray:
        """Whether there is a wall in the `size` characters from each place on."""
        at = self._at(place)
        return np.searchsorted(self.walls, at + size) > np.searchsorted(self.walls, at)

    def rows(self, width: int) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self.padded, width)

    def next(self, rows: np.ndarray, cost: np.ndarray, place: np.ndarray, pattern: np.ndarray, walled: bool) -> np.ndarray:
        """Edits in the cells, the first of them at `place` in the text, after one more character of the pattern."""
        text = rows[self._at(place)]
        best = cost + (text != pattern[:, None])
        if walled:
            wall = text == _WALL
            best += np.where(wall, np.int16(_FAR), np.int16(0))
            step = np.where(wall, np.int16(_FAR), np.int16(1))
            passed = np.cumsum(step, axis=1, dtype=np.int16)  # text passed over along the row
        else:
            passed = np.arange(1, cost.shape[1] + 1, dtype=np.int16)
        np.minimum(best[:, :-1], cost[:, 1:] + np.int16(1), out=best[:, :-1])
        best -= passed
        np.minimum.accumulate(best, axis=1, out=best)
        best += passed
        return np.minimum(best, np.int16(_FAR), out=best)


def build(texts: list[str], edit_rate: float = EDIT_RATE) -> Index:
    """Index of the windows of some items, and those under SHORTEST characters, which have none."""
    if LONGEST * edit_rate >= COARSE // 2:
        raise ValueError("so many edits need wider coarse bands")
    owner, start, size, parts, at = [], [], [], [], 0
    short: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        codes = _trimmed(normal(text.replace("\0", " "))[0])
        if len(codes) < SHORTEST:
            if len(codes):
                short.setdefault("".join(map(chr, codes)), []).append(i)
            continue
        last = max(0, len(codes) - WINDOW)
        for begin in dict.fromkeys([*range(0, last, STEP), last]):
            owner.append(i)
            start.append(at + begin)
            size.append(min(WINDOW, len(codes)))
        parts.append(codes)
        at += len(codes)
    codes = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    item = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    size, start = np.array(size, dtype=np.int64), np.array(start, dtype=np.int64)
    edits = np.minimum((size * edit_rate).astype(np.int64), (size - Q) // Q)
    lengths = np.arange(LONGEST + 1)
    allowed = (lengths * min(edit_rate, (EXCERPT - Q) / Q / EXCERPT)).astype(np.int64)
    count = size - Q + 1
    window, place = np.repeat(np.arange(len(size)), count), _ranges(start, start + count)
    held = np.bincount(place, minlength=len(codes))
    places = np.flatnonzero(held)  # of q-grams that lie within one item
    every = gram_hashes(codes)[places] if len(places) else np.empty(0, np.uint64)
    order = np.argsort(every, kind="stable")
    distinct, first = np.unique(every[order], return_index=True)
    table = np.zeros(1 << FILTER_BITS, dtype=bool)
    table[distinct >> np.uint64(64 - FILTER_BITS)] = True
    return Index(
        np.array(owner, dtype=np.int64), start, size, edits, codes, item, distinct,
        np.append(first, len(every)), places[order], table,
        np.concatenate([[0], np.cumsum(held)]), window[np.argsort(place, kind="stable")],
        allowed, short,
    )


def _blocks(benchmark: DataFrame, item: str) -> tuple[int, Iterator[tuple[list, Index]]]:
    """How many blocks of items there are, and the ids and index of each, one at a time.

    A block is collected; its size is bounded.
    """
    rows = benchmark.filter(F.col("text").isNotNull()).select(F.col(item).alias("item"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_CHARS))
    block = F.pmod(digits("block", F.coalesce(F.col("item").cast("string"), F.lit("")), F.md5("text")), F.lit(count))

    def each() -> Iterator[tuple[list, Index]]:
        for i in range(count):
            found = sorted(rows.filter(block == i).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            yield [r[0] for r in found], build([r[1] for r in found])

    return count, each()


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", name: str = "leaks"
) -> DataFrame:
    """Columns of the input and `name`: an array of item_id, start, end, edits, one for each
    item found, where a window of it was found with the fewest edits, or if none was, a stretch
    of EXCERPT characters or more from any start. Places are in code points, to within the edits.

    An item under SHORTEST characters is found where all of it stands, as compared, between other words; one
    without letters and digits says nothing and is not looked for. Null and empty texts have none, null items
    are left out. Repeated items are found once per id. A column of that name is replaced.
    """
    kind = benchmark.schema[item].dataType
    leak = T.StructType(
        [T.StructField("item_id", kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "end", "edits")]
    )
    kept = docs.drop(name)
    found = T.StructField(name, T.ArrayType(leak))
    arrow = pa.list_(
        pa.struct([("item_id", to_arrow_type(kind)), *[(n, pa.int64()) for n in ("start", "end", "edits")]])
    )
    count, blocks = _blocks(benchmark, item)
    if count == 1:
        ids, index = next(blocks)
        return map_arrow(kept, _searcher(ids, index, text, name, arrow), T.StructType([*kept.schema.fields, found]))
    mark = F.unhex(F.md5(F.col(text)))
    texts = kept.filter(F.col(text) != "").select(mark.alias("_text_mark"), F.col(text).alias("text"))
    texts = settle(texts.groupBy("_text_mark").agg(F.first("text").alias("text")), "texts")
    schema = T.StructType([*texts.schema.fields, found])
    parts = []
    for ids, index in blocks:
        met = map_arrow(texts, _searcher(ids, index, "text", name, arrow), schema).filter(F.size(name) > 0)
        parts.append(settle(met.select("_text_mark", name), "leaks"))
    every = reduce(DataFrame.unionAll, parts).groupBy("_text_mark").agg(
        F.array_sort(F.flatten(F.collect_list(name)), _in_text).alias("_found")
    )
    marked = kept.withColumn("_text_mark", mark)
    out = join_apart(marked, every, ["_text_mark"], "left")
    none = F.array().cast(T.ArrayType(leak))
    return out.select(*kept.columns, F.coalesce("_found", none).alias(name))


def _in_text(a: Column, b: Column) -> Column:
    """Order of leaks by place, then by the id as text."""
    one, two = (F.struct(x["start"], x["end"], x["item_id"].cast("string")) for x in (a, b))
    return F.when(one < two, -1).when(one > two, 1).otherwise(0)


def _searcher(ids: list, index: Index, text: str, name: str, arrow: pa.DataType):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or "").replace("\0", " ") for t in texts_of(batch, text)]
        codes, places = normal("\0".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        best: list[dict] = [{} for _ in texts]
        for item, first, last, edits in [*index.search(codes), *index.whole(codes)]:
            while first < last and codes[first] == _WALL:
                first += 1
            row = int(np.searchsorted(ends, places[(first + last) // 2], side="right"))
            begin = int(ends[row]) - len(texts[row]) - 1
            low, high = int(places[first]) - begin, int(places[last]) + 1 - begin
            found = (edits, max(0, low), min(high, len(texts[row])))
            key = ids[item]
            if key not in best[row] or found < best[row][key]:
                best[row][key] = found
        leaks = [
            [{"item_id": k, "start": a, "end": b, "edits": e} for k, (e, a, b) in d.items()] for d in best
        ]
        for row in leaks:
            row.sort(key=lambda x: (x["start"], x["end"], str(x["item_id"])))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(leaks, arrow)], names=[*batch.schema.names, name]
        )

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows, with the columns of the input, in whose text no benchmark item was found."""
    packed = docs.select(F.struct("*").alias("row"), "text")
    return find_leaks(packed, benchmark).filter(F.size("leaks") == 0).select("row.*")


def leak_list(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end and edits of every benchmark item found in a document."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
