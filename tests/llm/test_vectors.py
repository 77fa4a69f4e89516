"""The forest search against all pairs."""

import numpy as np
import pytest

from voltmesh.llm import common, queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, key string, rank string"


def plain_nearest(rows, every=50, most=5):
    """Every query row with its nearest other rows, each score by itself."""
    valid = [
        (i, np.array(v, dtype=np.float64))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for at, (q, a) in enumerate(valid):
        if q % every:
            continue
        others = [(i, b) for n, (i, b) in enumerate(valid) if n != at]
        if not others:
            continue
        table = np.array([b for _, b in others])
        scores = (table * a).sum(axis=1) / (np.sqrt((table * table).sum(axis=1)) * np.sqrt((a * a).sum()))
        best = sorted((-s, i) for s, (i, _) in zip(scores.tolist(), others))[:most]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def agree(got, wanted):
    """The same rows; scores but for the rounding of a division."""
    assert [r[:3] for r in got] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in got], [r[3] for r in wanted], rtol=0, atol=1e-14)


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x") for i, v in rows], SCHEMA).repartition(4)


def test_few_rows_are_all_searched(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=8).round(3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [(50, rows[50][1]), (50, rows[50][1]), (100, rows[3][1])]
    rows += [(400, None), (450, []), (500, [0.0] * 8), (None, rows[1][1]), (550, [None] + [1.0] * 7)]
    rows += [(600, [float("nan")] + [1.0] * 7), (650, [float("inf")] + [1.0] * 7), (700, [1.0] * 3)]
    clean = [(i, np.array(v, dtype=np.float32).tolist() if v and None not in v else v) for i, v in rows if i != 700]
    agree(found(vectors.nearest_list(table_of(spark, rows))), plain_nearest(clean))


@pytest.mark.parametrize("leaf, block, part", [(16, 4, 60), (8, 1, 32768)])
def test_recall_and_scores(spark, monkeypatch, leaf, block, part):
    """Small leaves, blocks and parts: what is found is ranked exactly, and most is found."""
    for name, value in (("LEAF", leaf), ("BLOCK", block), ("PART", part), ("LEAST", 4)):
        monkeypatch.setattr(vectors, name, value)
    draw = np.random.default_rng(2)
    flat = np.tanh(draw.normal(size=(3000, 4)) @ draw.normal(size=(4, 24)))
    rows = [(i, v) for i, v in enumerate(flat.astype(np.float32).tolist())]
    got, wanted = found(vectors.nearest_list(table_of(spark, rows))), plain_nearest(rows)
    assert [r[:2] for r in got] == [r[:2] for r in wanted]
    pairs = {(r[0], r[2]): r[3] for r in wanted}
    same = [r for r in got if (r[0], r[2]) in pairs]
    assert len(same) >= 0.9 * len(wanted)
    assert all(abs(r[3] - pairs[r[0], r[2]]) < 1e-14 for r in same)
    by_query = {}
    for q, _, i, s in got:
        by_query.setdefault(q, []).append((-s, i))
    assert all(b == sorted(b) and len({i for _, i in b}) == 5 for b in by_query.values())


def test_leaves_that_outgrow_the_sample(spark, monkeypatch):
    """With a tiny sample the leaves are divided where they are searched."""
    for name, value in (("LEAF", 32), ("SAMPLE", 64), ("LEAST", 16)):
        monkeypatch.setattr(vectors, name, value)
    draw = np.random.default_rng(3)
    flat = np.tanh(draw.normal(size=(2000, 3)) @ draw.normal(size=(3, 16)))
    rows = [(i, v) for i, v in enumerate(flat.astype(np.float32).tolist())]
    got, wanted = found(vectors.nearest_list(table_of(spark, rows))), plain_nearest(rows)
    assert [r[:2] for r in got] == [r[:2] for r in wanted]
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in wanted}) >= 0.9 * len(wanted)


def test_one_vector_in_a_third_of_all_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.normal(size=6) if i % 3 else np.ones(6)).astype(np.float32).tolist()) for i in range(900)]
    agree(found(vectors.nearest_list(table_of(spark, rows))), plain_nearest(rows))


def test_doubles_of_any_size(spark):
    draw = np.random.default_rng(5)
    flat = draw.normal(size=(200, 5)) * 10.0 ** draw.integers(-250, 250, size=(200, 1))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(flat.tolist())], "vec_id long, embedding array<double>")
    got = found(vectors.nearest_list(df))
    scaled = [(i, (v / np.abs(v).max()).tolist()) for i, v in enumerate(flat)]
    assert [r[:3] for r in got] == [r[:3] for r in plain_nearest(scaled)]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vectors.nearest_list(empty).count() == 0
    assert vectors.nearest_list(table_of(spark, [(50, [1.0, 2.0])])).count() == 0
    assert vectors.nearest_list(table_of(spark, [(51, [1.0, 2.0]), (52, [1.0, 2.0])])).count() == 0


def test_given_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in common.table(spark, folder, "embeddings").collect()]
    got, wanted = found(queries.QUERIES["op12_nearest_vectors"](spark, folder)), plain_nearest(rows)
    assert [r[:2] for r in got] == [r[:2] for r in wanted]
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in wanted}) >= 0.95 * len(wanted)
