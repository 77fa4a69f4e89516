"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms are hashed character trigrams and word shapes (lengths, letter case, symbols, words
and lines that come again). Their weighted counts in a bounded number of labelled
documents give the space, by a truncated singular value decomposition on the driver.
The labelled vectors go to every task; a document's cosines with all of them are exact, one
block of documents at a time, and the nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import digits, held_out, map_arrow, texts_of

#: Labelled documents the model keeps, at most about so many: `DIMENSIONS` floats each.
TRAIN_ROWS = 3_000
DIMENSIONS, NEIGHBOURS = 64, 15
#: Hashed terms; the first SHAPES of them are for word shapes.
TERMS, SHAPES = 4_096, 64
#: Weight of the shapes beside the trigrams, and power of a similarity as a vote.
SHAPE_WEIGHT, POWER = 0.7, 4
THRESHOLD = 0.3
#: Documents in a block of cosines, bytes of text looked at together.
BLOCK, STRIDE = 256, 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_AGAIN, _SAME_LINE, _CLASSES = 16, 20, 21


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes."""
    powers = np.cumprod(np.full(len(data) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * powers[:-1])])
    hashed = (sums[ends] - sums[starts]) * powers[len(data) - starts]
    hashed = (hashed ^ (hashed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashed ^ (hashed >> np.uint64(32))


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _part_counts(data: np.ndarray) -> np.ndarray:
    """Counts of all terms in bytes of one text."""
    counts = np.zeros(TERMS, dtype=np.int64)
    if len(data) >= 3:
        wide = data.astype(np.uint32)
        value = (wide[:-2] * np.uint32(65599) + wide[1:-1]) * np.uint32(65599) + wide[2:]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount(SHAPES + (value >> np.uint32(8)) % (TERMS - SHAPES), minlength=TERMS)
    starts, ends = _runs(~_SPACE[data])
    if not len(starts):
        return counts
    counts[:16] += np.bincount(np.minimum(ends - starts, 15), minlength=16)
    words = _hash_words(data.astype(np.uint64), starts, ends)
    for gap in range(1, 5):
        counts[_AGAIN + gap - 1] += int((words[gap:] == words[:-gap]).sum())
    lines, line_ends = _runs(data != 10)
    hashed = _hash_words(data.astype(np.uint64), lines, line_ends)
    counts[_SAME_LINE] += len(hashed) - len(np.unique(hashed))
    kinds = [
        (data >= 65) & (data <= 90),
        (data >= 97) & (data <= 122) | (data >= 128),
        (data >= 48) & (data <= 57),
        np.isin(data, np.frombuffer(b"#*$%&|<>@_=+~^\\", np.uint8)),
        np.isin(data, np.frombuffer(b".,;:!?", np.uint8)),
    ]
    held = [np.add.reduceat(k.astype(np.int64), starts) for k in kinds]
    shape = sum((np.minimum(h, 1) << i) for i, h in enumerate(held))
    counts[_CLASSES : _CLASSES + 32] += np.bincount(shape, minlength=32)
    counts[_CLASSES + 32] += int(((held[0] == ends - starts) & (ends - starts > 1)).sum())
    counts[_CLASSES + 33] += int((held[4] > 1).sum())
    return counts


def term_counts(text: str | None) -> np.ndarray:
    """log(1 + count) of all terms; long texts are counted a part at a time."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    total = np.zeros(TERMS, dtype=np.int64)
    for start in range(0, len(data), STRIDE):
        total += _part_counts(data[start : start + STRIDE])
    return np.log1p(total).astype(np.float32)


def _normed(rows: np.ndarray) -> np.ndarray:
    sizes = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(sizes > 0, sizes, 1)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = counts * idf
    return np.hstack(
        [SHAPE_WEIGHT * _normed(rows[:, :SHAPES]), (1 - SHAPE_WEIGHT) * _normed(rows[:, SHAPES:])]
    )


@dataclass(frozen=True)
class Model:
    """The space, the labelled vectors in it, their labels and the share of label 1."""

    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, texts: list[str | None]) -> Iterator[float]:
        """Share of label 1 among the nearest, by similarity; without any, among all."""
        for start in range(0, len(texts), BLOCK):
            part = texts[start : start + BLOCK]
            # Every product has one shape, so that a text's score does not depend on its company.
            counts = np.zeros((BLOCK, TERMS), np.float32)
            for row, text in enumerate(part):
                counts[row] = term_counts(text)
            rows = _normed(_weighted(counts, self.idf) @ self.space)
            cosines = (rows @ self.vectors.T)[: len(part)]
            near = min(NEIGHBOURS, cosines.shape[1])
            if not near:
                yield from [self.prior] * len(part)
                continue
            at = nearest(cosines, near)
            votes = np.maximum(np.take_along_axis(cosines, at, axis=1), 0).astype(np.float64) ** POWER
            grain = 1e-6
            yield from (
                ((votes * self.labels[at]).sum(axis=1) + grain * self.prior)
                / (votes.sum(axis=1) + grain)
            ).tolist()


def nearest(cosines: np.ndarray, near: int) -> np.ndarray:
    """The columns of the `near` greatest of each row; of equal ones at the border the first."""
    last = np.partition(cosines, cosines.shape[1] - near, axis=1)[:, [cosines.shape[1] - near]]
    over, equal = cosines > last, cosines == last
    room = near - over.sum(axis=1, keepdims=True)
    taken = over | (equal & (np.cumsum(equal, axis=1) <= room))
    return np.nonzero(taken)[1].reshape(len(cosines), near)


def learn(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Truncated decomposition of the weighted counts, by subspace iteration from a fixed start."""
    rows = len(counts)
    seen = (counts > 0).sum(axis=0)
    idf = (np.log((1 + rows) / (1 + seen)) + 0.1).astype(np.float32)
    matrix = _weighted(counts, idf)
    wide = min(DIMENSIONS + 16, max(1, rows))
    basis = np.random.default_rng(11).standard_normal((TERMS, wide)).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    space = (basis @ right.T)[:, :DIMENSIONS].astype(np.float32)
    prior = float(labels.mean()) if rows else 0.5
    return Model(idf, space, _normed(matrix @ space), labels.astype(np.float64), prior)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """A model of about `rows` labelled documents, picked by the hash of the id, all if fewer.

    Rows without id or label are not used; of several labels of one id the mean counts, of
    several documents of one id the least text. The picked ids are broadcast: their number is
    checked, and beyond twice the aim they are joined instead.
    """
    named = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    one = named.groupBy("doc_id").agg(F.avg(label).alias("label"))
    total = one.count()
    if not total:
        return learn(np.zeros((0, TERMS), np.float32), np.zeros(0))
    cut = int(min(1.0, rows / total) * (1 << 52))
    picked = one.filter(digits("vote", F.col("doc_id").cast("string")) < cut)
    few = picked.limit(2 * rows + 1).count() <= 2 * rows
    known = docs.select("doc_id", "text").join(F.broadcast(picked) if few else picked, "doc_id")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        blobs = [term_counts(t).tobytes() for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(blobs, pa.binary())],
            names=["doc_id", "label", "terms"],
        )

    kind = docs.schema["doc_id"].dataType
    fields = [("doc_id", kind), ("label", T.DoubleType()), ("terms", T.BinaryType())]
    counted = map_arrow(
        known.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")),
        count,
        T.StructType([T.StructField(*f) for f in fields]),
    )
    found = sorted((r[0], r[1], bytes(r[2])) for r in counted.collect())
    if not found:
        return learn(np.zeros((0, TERMS), np.float32), np.zeros(0))
    counts = np.stack([np.frombuffer(r[2], np.float32) for r in found])
    return learn(counts, np.array([r[1] for r in found]))


def classify(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Columns of the input, then score (0 to 1) and predicted (1 from `threshold` on).

    Null and empty texts have no terms and get the share of label 1 among the labelled;
    without labels everything gets 0.5. Input columns of these names are replaced.
    """
    kept = docs.drop("score", "predicted")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = list(model.scores(texts_of(batch, text)))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(scores, pa.float64()),
             pa.array([int(s >= threshold) for s in scores], pa.int32())],
            names=[*batch.schema.names, "score", "predicted"],
        )

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_arrow(kept, run, T.StructType([*kept.schema.fields, *fields]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, learned from labels of rows not held out."""
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return classify(rows, model).drop("text")
