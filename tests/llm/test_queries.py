"""The registered queries: SQL counterparts, columns, the pipeline."""

import math
from collections import Counter
from hashlib import md5

import __spark_entry__ as contract
import corpus_pipeline
import pytest

from tests.compare import connect, difference
from tests.llm import odd
from tests.llm.test_copies import near_pairs, root_of
from voltmesh.llm import common, decontamination, mixing, queries, simhash

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op5_simhash_dedup": "doc_id fingerprint component_id",
    "op6_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_remove_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_shard_records": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_filter_urls": "page_id host path rule verdict",
    "op10_quality_neighbours": "doc_id held_out score predicted",
    "op11_repair_conversations": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_nearest_vectors": "query_id rank vec_id score",
    "op13_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


def test_all_are_registered():
    names = set(contract.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in names if q in queries.QUERIES}
    assert "pipeline" in names and set(queries.SQL) <= names


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    wanted = COLUMNS[name].split()
    assert df.columns[: len(wanted)] == wanted
    if int(name[2:].split("_")[0]) <= 10:
        table = "pages" if name.startswith("op9") else "documents"
        assert df.count() == common.table(spark, SMALL, table).count()


def plain_dedup(rows):
    """The least id of each group of documents whose fingerprints are linked."""
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in rows}
    keys = sorted(set(prints.values()))
    root = root_of(near_pairs(keys, 4), keys)
    least = {}
    for doc, key in prints.items():
        least[root[key]] = min(doc, least.get(root[key], doc))
    return set(least.values())


def plain_copies(rows):
    """How often each document is there after mixing to equal sizes."""
    size = Counter()
    for r in rows:
        size[r["source"]] += max(1, len(r["text"].encode()))
    out = Counter()
    for r in rows:
        rate = sum(size.values()) / len(size) / size[r["source"]]
        draws = max(1, math.ceil(rate / mixing.MAX_RATE))
        for draw in range(1, draws + 1):
            key = f"mix#{draw}#{r['doc_id']}#{md5(r['text'].encode()).hexdigest()}"
            at = (int(md5(key.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            k, p, total = 0, math.exp(-rate / draws), math.exp(-rate / draws)
            while total <= at:
                k += 1
                p *= rate / draws / k
                total += p
            out[r["doc_id"]] += k
    return +out


def test_pipeline_by_stages(spark):
    docs = common.table(spark, SMALL, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.settle(stage(spark, docs, SMALL), "stage")
        kept[name] = docs.collect()
        assert docs.columns[: len(columns)] == columns
    ids = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}
    texts = {r["doc_id"]: r["text"] for r in common.table(spark, SMALL, "documents").collect()}
    assert ids["language_id"] == {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert len(kept["simhash_dedup"]) == len(ids["simhash_dedup"])
    assert ids["simhash_dedup"] == plain_dedup(kept["language_id"])
    benchmark = [r["text"] for r in common.table(spark, SMALL, "benchmark").collect()]
    plain = lambda t: "".join(map(chr, decontamination.normal(t)[0])).strip()
    held = {d for d in ids["simhash_dedup"] if any(plain(b) in plain(texts[d]) for b in benchmark)}
    assert ids["decontaminate"] == ids["simhash_dedup"] - held
    assert Counter(r["doc_id"] for r in kept["mix_sources"]) == plain_copies(kept["decontaminate"])
    assert len(kept["shard_records"]) == len(kept["mix_sources"])
    by_id = {}
    for r in kept["shard_records"]:
        assert by_id.setdefault(r["doc_id"], r["shard"]) == r["shard"] and 0 <= r["shard"] < 16


def test_pipeline_of_odd_and_no_documents(spark):
    for docs in (odd.docs(spark), odd.nothing(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = common.settle(stage(spark, docs, SMALL), "odd")
        assert set(odd.CLASHES) <= set(docs.columns)
