"""SimHash near-duplicates, components and repeated strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import odd
from voltmesh.llm import components, repeats, simhash


def root_of(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- components -------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    pairs += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2200)] + [(-5, -5)]
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = root_of(pairs, {n for p in pairs for n in p})
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in want.items() if n != r}


def test_no_links(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- SimHash ----------------------------------------------------------------


def test_shingles_hash_as_spark_does(spark):
    words = "Ünï the Quick brown".split()
    text = " ".join(words)
    lowered = text.replace("Q", "q")
    hashed = spark.createDataFrame([(lowered,)], "t string").select(F.xxhash64("t")).first()[0]
    assert xxhash.xxh64_intdigest(lowered.encode(), 42) == hashed % 2**64
    assert simhash.fingerprint(text) == hashed % 2**64
    assert simhash.fingerprint(" \n ") == simhash.fingerprint(None) == 0


def clusters(rng, count):
    """Keys in groups at all distances, around the limit too."""
    keys = set()
    for _ in range(count):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            key = centre
            for bit in rng.sample(range(64), rng.randint(0, 7)):
                key ^= 1 << bit
            keys.add(key)
    return sorted(keys)


def near_pairs(keys, bits):
    a = np.array(keys, dtype=np.uint64)
    return [
        (keys[i], keys[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits) if i < j
    ]


@pytest.mark.parametrize("bits,part_rows,node_rows", [(4, 16384, 64), (4, 20, 32), (3, 100, 4096), (0, 50, 16), (7, 40, 64)])
def test_classes_against_all_pairs(spark, monkeypatch, bits, part_rows, node_rows):
    monkeypatch.setattr(simhash, "PART_ROWS", part_rows)
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    keys = clusters(random.Random(bits + part_rows), 150)
    signed = [int(np.uint64(k).astype(np.int64)) for k in keys]
    got = simhash.classes(spark.createDataFrame([(k,) for k in signed], "fp long"), bits).collect()
    to_signed = dict(zip(keys, signed))
    pairs = [(to_signed[a], to_signed[b]) for a, b in near_pairs(keys, bits)]
    assert {r["fp"]: r["root"] for r in got} == root_of(pairs, signed)


def test_walk_finds_each_pair_in_small_steps(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 8)
    keys = np.array(clusters(random.Random(5), 60), dtype=np.uint64)
    found = [set(), set()]
    for half, budget in enumerate((2, 1)):
        turned = np.sort(keys if half == 0 else (keys << np.uint64(32)) | (keys >> np.uint64(32)))
        for i, j in simhash.walk(turned, turned, 0, (budget, 4), True):
            a, b = turned[i], turned[j]
            if half:
                a, b = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (a, b))
            found[half] |= {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    assert found[0] | found[1] == {tuple(sorted(p)) for p in near_pairs(keys.tolist(), 4)}


def test_near_duplicates_of_odd_documents(spark):
    docs = odd.docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(odd.TEXTS)
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert of[2] == of[3] == of[4] == {("0" * 16, 2)} and of[6] == {(next(iter(of[6]))[0], 6)}
    assert ("0" * 16, 2) in of[None] and any(c is None for _, c in of[None])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1, None: 1})
    assert simhash.near_duplicates(odd.nothing(spark)).count() == 0 and simhash.keep_one(odd.nothing(spark)).count() == 0


# ---- repeated strings -------------------------------------------------------


def plain_removal(texts, least):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - least + 1):
            if counts[d[i : i + least]] > 1:
                gone[i : i + least] = True
        left = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def passages(seed, least):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    shared = [word(3 * least) for _ in range(5)]
    texts = []
    for _ in range(150):
        text = word(rng.randint(0, 2 * least))
        for _ in range(rng.randint(0, 2)):
            start = rng.randint(0, least)
            text += rng.choice(shared)[start : start + rng.randint(least // 2, 2 * least)] + word(rng.randint(0, least))
        texts.append(text)
    texts += [t[: least // 2] + "X" + t[least // 2 + 1 :] for t in texts[:30]]
    return texts + [None, "", texts[3], texts[3], "ab" * 3 * least, "z" * 4 * least, "z" * least, "z" * (least - 1),
                    "é" * least + texts[5], "\0" * 2 * least,
                    "abab" * (least // 4) + "ba", "xyxy" * (least // 3), word(least // 4) * 6]


@pytest.mark.parametrize("least,group_rows,stride", [(40, 2000, 1 << 21), (40, 4, 300), (17, 3, 1 << 21), (23, 6, 97)])
def test_repeats_against_plain_search(spark, monkeypatch, least, group_rows, stride):
    monkeypatch.setattr(repeats, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(repeats, "STRIDE", stride)
    texts = passages(least + group_rows, least)
    rows = repeats.repeat_list(odd.of(spark, texts), least).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, least)


def test_hot_passage_with_different_neighbours(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_ROWS", 10)
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(90)
    texts = [word(60) + passage + word(60) for _ in range(60)] + [passage[: 30 + i] + word(50) for i in range(40)]
    rows = repeats.repeat_list(odd.of(spark, texts), 40).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, 40)


@pytest.mark.parametrize("seed", range(6))
def test_longest_matches_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(97, 99 + 60 * (seed % 2), rng.integers(1, 70)).astype(np.uint8) for _ in range(4)]
    texts += [texts[0].copy()] if seed % 3 == 0 else []
    suffixes = [t[i:].tobytes() for t in texts for i in range(len(t))]

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    want = [max((shared(a, b) for j, b in enumerate(suffixes) if j != i), default=0) for i, a in enumerate(suffixes)]
    ends = np.cumsum([len(t) for t in texts])
    assert repeats.longest_matches(repeats.run_index(np.concatenate(texts), ends)).tolist() == want


@pytest.mark.parametrize("data", [[b"banana$bananas" * 3], [b"abracadabra", b"abra", b"a", b"abracadabra"], [b"z" * 50]])
def test_transform_is_stored_in_runs(data):
    text, ends = np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(d) for d in data])
    index = repeats.run_index(text, ends)
    own = [(d[i:], n, i) for n, d in enumerate(data) for i in range(len(d))]  # ties by text
    rows = [(data[n][i - 1] if i else -1, int(ends[n]) - len(data[n]) + i) for _, n, i in sorted(own)]
    assert np.repeat(index.heads, index.lengths).tolist() == [head for head, _ in rows]
    starts = np.cumsum(index.lengths) - index.lengths
    assert index.first.tolist() == [rows[i][1] for i in starts]
    assert index.last.tolist() == [rows[i][1] for i in starts + index.lengths - 1]
    assert len(index.shared) == len(index.heads) - 1


def test_runs_follow_what_differs():
    rng = np.random.default_rng(4)
    base = rng.integers(97, 123, 2_000).astype(np.uint8)
    copies = [base.copy() for _ in range(30)]
    for i, copy in enumerate(copies):
        copy[40 * i + 7] = 65
    index = repeats.run_index(np.concatenate(copies), np.cumsum([len(c) for c in copies]))
    assert index.size == 60_000 and len(index.heads) < 3_000


def test_every_repeat_goes_through_an_index(spark, monkeypatch):
    """Without the index nothing is found but copies of whole texts and third places."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(60)
    texts = [passage + word(50), passage + word(50), word(45) + passage]
    assert [r["n_spans"] for r in repeats.repeat_list(odd.of(spark, texts), 40).collect()] == [1, 1, 1]
    nothing = spark.createDataFrame([], "digest binary, start long, end long")
    monkeypatch.setattr(repeats, "indexed", lambda slices, least: nothing)
    rows = repeats.repeat_list(odd.of(spark, texts[:2]), 40).collect()
    assert [r["n_spans"] for r in rows] == [0, 0]


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    text[2000:2400] = text[100:500]
    at, keys = repeats.anchors(text, np.array([3000]), 80)
    for start in range(0, 3000 - 80):
        assert ((at >= start) & (at <= start + 60)).any()
    cut, cut_keys = repeats.anchors(text[700:2600], np.array([1900]), 80)  # the same in any buffer
    assert set(zip((cut + 700).tolist(), cut_keys.tolist())) <= set(zip(at.tolist(), keys.tolist()))
    inside = lambda base: {(int(p) - base, int(k)) for p, k in zip(at, keys) if base + 60 <= p < base + 400 - 80}
    assert inside(100) == inside(2000)


def test_repeats_of_odd_documents(spark):
    docs = odd.docs(spark)
    rows = repeats.repeat_list(docs).collect()
    want = plain_removal([t if t != odd.LONG else None for _, t, _, _ in odd.TEXTS], 400)
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows if r["doc_id"] != 5)
    assert got == Counter(w for w, (i, *_) in zip(want, odd.TEXTS) if i != 5)
    long = next(r for r in rows if r["doc_id"] == 5)
    assert long["n_removed"] == len(odd.LONG) and long["n_spans"] == 1
    assert repeats.repeat_list(odd.nothing(spark)).count() == 0
    kept = repeats.without_repeats(docs, 400, with_bytes=True).collect()
    assert [r["kept"] for r in kept] == [b""]
