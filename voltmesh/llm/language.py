"""Language identification by a bit-sliced Bloom filter over character n-grams.

Each slot of the filter is a mask with one bit per language. The slots of an n-gram,
and-ed together, give at once all languages whose profile has it, and some false
ones. A document's n-grams are looked up, hits are counted per language, eight
languages by one count of byte values, and each count is freed from the false positives
that the language's share of set bits makes expected. The most hits decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from voltmesh.operators.skew import top_per_key

from .common import digits, held_out, map_arrow, texts_of

#: Distinct texts per language that a model is fitted on, about; picked by the hash of the text.
TRAIN_ROWS = 2_000
#: Most frequent n-grams in a language's profile.
PROFILE = 4_000
LENGTHS = (2, 3, 4)
HASHES, SLOTS_PER_GRAM = 3, 4
UNKNOWN = "und"
#: Characters looked at together; bounds the memory that one long text takes.
STRIDE = 1 << 20


def _letters(codes: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter."""
    table = np.zeros(0x110000, dtype=bool)
    table[codes] = True
    for code in np.flatnonzero(table):
        table[code] = chr(code).isalpha()
    return table[codes]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def letter_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts as code points, 0 for what is no letter and between
    texts; and the end of each text."""
    lowered = [" " + t.lower() + "   " for t in texts]
    ends = np.cumsum([len(t) for t in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    codes[~_letters(codes)] = 0
    return codes, ends


def grams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and hashes of all n-grams: letters, with a border of the word at either end."""
    reach = max(LENGTHS) - 1
    for start in range(0, len(codes) - reach, STRIDE):
        part = codes[start : start + STRIDE + reach]
        count = len(part) - reach
        letter = part > 0
        value = part[:count].astype(np.uint64)
        inner = np.ones(count, dtype=bool)
        for size in range(2, reach + 2):
            if size > 2:
                inner &= letter[size - 2 : size - 2 + count]
            value = value * np.uint64(0x100000001B3) + part[size - 1 : size - 1 + count]
            if size in LENGTHS:
                keep = inner if size > 2 else letter[:count] | letter[1 : count + 1]
                at = np.flatnonzero(keep)
                yield at + start, _mixed(value[at] + np.uint64(size << 56))


@dataclass(frozen=True)
class Model:
    """Masks per slot (one column of bytes for eight languages) and false positive rates."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_rate: np.ndarray

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        size = len(self.slots)
        out = self.slots[slot_of(hashes, 0, size)]
        for k in range(1, HASHES):
            out &= self.slots[slot_of(hashes, k, size)]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, its share of all corrected hits, and its share of the n-grams."""
        codes, ends = letter_codes([t or "" for t in texts])
        counts = np.zeros(len(texts), dtype=np.int64)
        width = self.slots.shape[1]
        values = np.zeros((width, len(texts) * 256), dtype=np.int64)
        for at, hashes in grams(codes):
            owner = np.searchsorted(ends, at, side="right")
            counts += np.bincount(owner, minlength=len(texts))
            masks = self.lookup(hashes)
            for i in range(width):
                values[i] += np.bincount(owner * 256 + masks[:, i], minlength=len(texts) * 256)
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        hits = np.hstack([v.reshape(len(texts), 256) @ bits.astype(np.int64) for v in values])
        hits = hits[:, : len(self.languages)]
        true = np.maximum(hits - counts[:, None] * self.false_rate, 0) / (1 - self.false_rate)
        best = true.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), int)
        out = []
        for i, text in enumerate(texts):
            if not counts[i] or not self.languages:
                out.append((UNKNOWN, 0.0, 0.0))
                continue
            top, every = float(true[i, best[i]]), float(true[i].sum())
            score = top / every if every else 0.0
            out.append((self.languages[best[i]], score, min(1.0, top / float(counts[i]))))
        return out


def slot_of(hashes: np.ndarray, k: int, size: int) -> np.ndarray:
    """The k-th slot; `size` is a power of two."""
    turned = (hashes >> np.uint64(16 * k)) ^ (hashes << np.uint64(7 * k))
    return (turned & np.uint64(size - 1)).astype(np.int64)


def build(languages: list[str], profiles: list[tuple[str, int]]) -> Model:
    """The filter of (language, n-gram hash) pairs."""
    size = 1 << max(6, int(len(profiles) * SLOTS_PER_GRAM - 1).bit_length())
    slots = np.zeros((size, max(1, -(-len(languages) // 8))), dtype=np.uint8)
    number = {name: i for i, name in enumerate(languages)}
    owner = np.array([number[name] for name, _ in profiles], dtype=np.int64)
    hashes = np.array([h & (2**64 - 1) for _, h in profiles], dtype=np.uint64)
    for k in range(HASHES):
        np.bitwise_or.at(
            slots, (slot_of(hashes, k, size), owner // 8), (1 << (owner % 8)).astype(np.uint8)
        )
    filled = np.array([(slots[:, i // 8] >> (i % 8) & 1).mean() for i in range(len(languages))])
    return Model(tuple(languages), slots, filled**HASHES)


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, profile: int = PROFILE) -> Model:
    """A model of the non-null values of lang, from text and lang alone.

    About `rows` texts of each language are read, all if there are fewer, copies of a text
    once; they do not count for the share that is read either. What comes to the driver is a row per language and `profile` n-grams of each.
    Equally frequent n-grams are taken by hash.
    """
    known = docs.filter("text is not null and lang is not null").select("text", "lang")
    distinct = known.groupBy("lang").agg(F.countDistinct(F.xxhash64("text")))
    counts = {r[0]: r[1] for r in distinct.collect()}
    if not counts:
        return build([], [])
    rates = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, rows / n))])
    picked = known.filter(digits("train", F.col("text")) < rates[F.col("lang")] * float(1 << 52))
    picked = picked.dropDuplicates(["lang", "text"])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(texts_of(batch), texts_of(batch, "lang")):
            by_lang.setdefault(lang, []).append(text)
        langs, found, sums = [], [], []
        for lang, texts in by_lang.items():
            seen = [np.unique(h, return_counts=True) for _, h in grams(letter_codes(texts)[0])]
            for values, numbers in seen:
                langs += [lang] * len(values)
                found.append(values.view(np.int64))
                sums.append(numbers)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(np.concatenate(found) if found else [], pa.int64()),
                pa.array(np.concatenate(sums) if sums else [], pa.int64()),
            ],
            names=["lang", "gram", "n"],
        )

    counted = map_arrow(picked, count, "lang string, gram long, n long")
    frequent = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = top_per_key(frequent, ["lang"], [F.desc("n"), F.col("gram")], profile)
    return build(sorted(counts), sorted((r[0], r[1]) for r in top.select("lang", "gram").collect()))


_ADDED = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("coverage", T.DoubleType())]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Columns of the input, then lang_pred, score and coverage.

    score is the language's share of all languages' corrected hits, coverage its share of the
    text's n-grams. Null texts and texts without a letter are 'und' with both 0, and so
    is all if nothing was learned. Of languages with as many hits the first by name is taken.
    Input columns with the names of results are replaced.
    """
    kept = docs.drop(*[n for n, _ in _ADDED])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = model.predict(texts_of(batch, text))
        kinds = [pa.string(), pa.float64(), pa.float64()]
        added = [pa.array([r[i] for r in rows], kinds[i]) for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *added], names=[*batch.schema.names, *[n for n, _ in _ADDED]]
        )

    fields = [T.StructField(n, k) for n, k in _ADDED]
    return map_arrow(kept, run, T.StructType([*kept.schema.fields, *fields]))


#: A document of which less is known in its language is rejected.
MIN_COVERAGE = 0.2


def reject_unknown(docs: DataFrame, model: Model, least: float = MIN_COVERAGE) -> DataFrame:
    """Rows, with the columns of the input, whose text is mostly in a learned language."""
    rows = identify(docs.select(F.struct("*").alias("row"), "text"), model)
    return rows.filter((F.col("lang_pred") != UNKNOWN) & (F.col("coverage") >= least)).select("row.*")


def language_list(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and coverage, learned from rows not held out."""
    held = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(held.filter("not held_out"))
    return identify(held.select("doc_id", "held_out", "text"), model).drop("text")
