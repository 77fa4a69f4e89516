"""Conversation repair and the prefix trie against versions that do one conversation at a time."""

import heapq
import random
from collections import defaultdict
from functools import lru_cache
from hashlib import sha256
from zlib import crc32

import pytest

from tests.llm.odd import same_rows
from voltmesh.llm import common, dialogues, prefixes, queries

SMALL = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, place string, kind string, steps string"


def mark(role, text):
    return sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def by_turn(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, mark(r[1], r[2])))


def plain_damage(rows):
    known = lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        role, text = known(role), known(text)
        case = crc32(f"{known(conv)}:{known(turn)}".encode()) % 20
        if case == 0:
            continue
        if case == 1:
            text = ""
        if case == 2:
            text = "".join(c for c in text if c not in ".!?")
        if case == 4:
            role = "user"
        for _ in range(2 if case == 3 else 1):
            yield conv, turn, role, text


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ended = text.rstrip(BLANKS)
        if not ended:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if ended[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired) by a search over all edits in order of cost, then audit."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, state, out = heapq.heappop(queue)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, out
        if (at, state) in done:
            continue
        done.add((at, state))
        steps = {"": "u", "s": "u", "u": "a", "a": "u"}
        name = {"u": "user", "a": "assistant"}[steps[state]]
        heapq.heappush(queue, (cost + 2, audit + "I", at, steps[state], (*out, (name, ""))))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state, out))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = cost + (faults[at] == "truncated")
        heapq.heappush(queue, (more + 2, audit + "R", at + 1, steps[state], (*out, (name, text))))
        if role[:1] == steps[state] or (role[:1] == "s" and state == ""):
            heapq.heappush(queue, (more, audit + "K", at + 1, role[:1], (*out, (role, text))))


def plain_repair(rows):
    """The contract, one conversation at a time. Audits of one cost are compared whole."""
    rows = [tuple(r)[:4] for r in rows]
    convs = defaultdict(list)
    for conv, turn, role, text in plain_damage(rows):
        convs[conv].append((turn, role, text))
    out = {}
    for conv in {r[0] for r in rows}:
        held = by_turn(convs.get(conv, []))
        faults = faults_of(held)
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, turns = cheapest(held, faults)
        digest = sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def listed(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def odd_rows(count=900, seed=3):
    """Few texts and turns, so that ties, repeats and all faults are there."""
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "And then", "", " \n", None, "Why?", "Yes. ", "é漢\U0001f600", "x" * 300_000 + "."]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", None, ""]
    rows = []
    for _ in range(count):
        turn = draw.choice([*range(12), None])
        text = draw.choice(texts[:9]) if draw.random() < 0.99 else texts[9]
        rows.append((draw.choice([*range(60), None, -7]), turn, draw.choice(roles), text, "x", "x", "x"))
    return rows + rows[:40]


def test_repair_of_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert listed(dialogues.repair_list(df, dialogues.damaged(df))) == plain_repair(rows)


def test_repair_of_given_rows(spark):
    df = common.table(spark, SMALL, "conversations")
    assert listed(queries.QUERIES["op11_repair_conversations"](spark, SMALL)) == plain_repair(df.collect())


def test_repair_of_one_long_conversation(spark):
    """A third of all rows in one conversation, most of them copies of one turn."""
    draw = random.Random(5)
    rows = [(c, t, draw.choice(["user", "assistant"]), f"{c} {t}.") for c in range(100) for t in range(8)]
    rows += [(7, 100 + t // 3, draw.choice(["user", "assistant"]), "Again." if t % 2 else f"Turn {t}") for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert listed(dialogues.repair_list(df, dialogues.damaged(df))) == plain_repair(rows)


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = dialogues.repair_list(df, dialogues.damaged(df))
    assert out.columns[:4] == ["conv_id", "gaps", "blank", "duplicate"] and out.count() == 0


def test_states_are_shared(monkeypatch):
    """A state is made once for every distinct end of a word."""
    made = []
    real = dialogues.State.__init__
    monkeypatch.setattr(dialogues.State, "__init__", lambda s, *a: (made.append(1), real(s, *a))[1])
    draw = random.Random(1)
    words = sorted({"".join(draw.choices("suaoUA04", k=draw.randint(0, 6))) for _ in range(400)}, key=lambda w: w[::-1])
    assert [w for w, _ in dialogues.walk(iter(words))] == words
    assert len(made) == len({w[i:] for w in words for i in range(len(w) + 1)} | {""})


def test_repaired_turns_are_in_order(spark):
    """The turns themselves, with their edits: a row put in, a role changed, a repeat taken out."""
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."), (1, 3, "assistant", "c."), (2, 0, "tool", "d.")]
    _, turns = dialogues.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = sorted(tuple(r) for r in turns.collect())
    assert [r for r in got if r[0] == 1] == [
        (1, 0, "K", "user", "a."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "b."), (1, 3, "K", "assistant", "c."),
    ]
    assert [r for r in got if r[0] == 2] == []


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn, role or "", text or ""))
    own = {c: [r[1:] for r in by_turn(held)] for c, held in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        path = (*own.get(base, [])[:h], *turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(set)
    for path in members:
        if path:
            kids[path[:-1]].add(path)

    @lru_cache(None)
    def below(path):
        size = len(path[-1][1].encode()) if path else 0
        parts = [below(k) for k in kids[path]]
        return sum(p[0] for p in parts) or 1, (len(members[path]) - 1) * size + sum(p[1] for p in parts)

    digest = lambda ids: sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(held), len(path), -10**9 if not path else min(members[path[:-1]]), len(held), len(kids[path]), *below(path), digest(ends[path]))
        for path, held in members.items()
    )


def nodes_of(df):
    assert df.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(tuple(-10**9 if v is None else v for v in r) for r in df.collect())


def family_rows(count=400, seed=2):
    draw = random.Random(seed)
    rows = []
    for c in range(-3, count):
        for t in range(draw.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, draw.choice([t, t, t, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "", None, "ü漢"])))
    return rows + rows[:30] + [(None, 1, "user", "nobody's")]


@pytest.mark.parametrize("shard", [50, 1000])
def test_trie_of_odd_rows(spark, monkeypatch, shard):
    monkeypatch.setattr(prefixes, "SHARD_ROWS", shard)
    rows = family_rows()
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    assert nodes_of(prefixes.conversation_trie(df)) == plain_trie(rows)


def test_trie_of_copies_over_many_shards(spark, monkeypatch):
    """Copies of one conversation fill several shards; their node ends in all of them."""
    monkeypatch.setattr(prefixes, "SHARD_ROWS", 20)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 1000, 5) for t in range(4)]
    rows += [(c, t, "user", f"turn {t}") for c in range(1000, 1300, 5) for t in range(6)]
    rows += [(c, t, "user", f"{c}") for c in range(2000, 2100, 5) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes_of(prefixes.conversation_trie(df)) == plain_trie(rows)


def test_trie_of_given_rows(spark):
    df = common.table(spark, SMALL, "conversations")
    rows = [tuple(r) for r in df.collect()]
    assert nodes_of(queries.QUERIES["op13_prefix_trie"](spark, SMALL)) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefixes.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_columns_do_not_matter(spark):
    rows = odd_rows(200)
    full = spark.createDataFrame(rows, SCHEMA)
    few = full.select("conv_id", "turn", "role", "text")
    for run in (lambda d: dialogues.repair_list(d, dialogues.damaged(d)), prefixes.conversation_trie):
        assert same_rows(run(full), run(few))
