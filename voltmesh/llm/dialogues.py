"""Conversations with missing, repeated, empty or cut-off turns, repaired by the cheapest edits.

A conversation's rows become a signature, one letter for each row that tells its role and
its fault. The signatures of all conversations form one automaton that shares suffixes:
each signature enters at a state of its own word, a state's right language is what is
left of the word, and states with the same right language are one. On the words sorted from their ends that
automaton is walked with one path in memory. Each state gets, once for all conversations
that pass it and for each state of the grammar, the least cost of repairing what is left and
the edits that do it, as a link in front of the next state's edits.

What a task holds is one signature, one byte a row, as long as the audit that is
returned. Texts pass through one by one.

Nulls: a null role or text counts as one space, a null turn comes first, rows without conv_id are one
conversation. Rows of one turn go by a digest of role and text; equal rows are duplicates of the
first. Empty tables give empty results; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from voltmesh.operators.skew import join_apart

from .common import crc32_sql, settle

BLANKS = " \t\n\x0b\x0c\r"
#: Letters of a signature: four kinds of role (system, user, assistant, other) for each fault.
CLEAN, TRUNCATED, BLANK, DUPLICATE = "suao", "SUAO", "0123", "4567"
DROP, EMPTY, UNFINISHED, REPEAT, AS_USER, CASES = 0, 1, 2, 3, 4, 20
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: Added for a row that stays although its text breaks off.
BROKEN = 1
#: States of the grammar (s?(ua)+)?: at the start, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The role each state lets edits write, and the state after it.
WANTED = {START: ("u", AFTER_U), AFTER_S: ("u", AFTER_U), AFTER_U: ("a", AFTER_A), AFTER_A: ("u", AFTER_U)}
NAMES = {"u": "user", "a": "assistant"}
#: Neighbouring roles that are in order.
LEGAL = ("su", "ua", "au")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that crc32 of `conv_id:turn` modulo 20 asks for."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % CASES
    rows = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"), case.alias("_case")
    )
    shown = F.when(F.col("_case") == EMPTY, "").otherwise(
        F.when(F.col("_case") == UNFINISHED, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    role = F.when(F.col("_case") == AS_USER, "user").otherwise(F.col("role"))
    times = F.when(F.col("_case") == REPEAT, 2).otherwise(1)
    kept = rows.filter(F.col("_case") != DROP).withColumns({"role": role, "text": shown})
    return kept.withColumn("_time", F.explode(F.sequence(F.lit(1), times))).drop("_time", "_case")


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows with the digest of role and text that orders and compares them."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", "turn", known("role"), known("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("_mark", F.unhex(F.substring(F.sha2(whole, 256), 1, 32)))


def _letter(fault: Column, kind: Column) -> Column:
    return F.substring(F.lit(CLEAN + TRUNCATED + BLANK + DUPLICATE), fault * 4 + kind + 1, F.lit(1))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature) of every conversation, from `_rows`.

    Texts stay behind: equal rows of a turn are counted, the first turn of a role and text comes
    from an aggregate, and letters are put together by ranges of turns, so a conversation of
    any length is spread until its letters meet.
    """
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(ended == "", 2).when(F.substring(ended, -1, 1).isin(*".!?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    counted = rows.groupBy("conv_id", "turn", "_mark", fault.alias("_fault"), kind.alias("_kind")).agg(
        F.count("*").alias("_n")
    )
    # The key says which conversation and which text, with no null in it.
    who = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    keyed = counted.withColumn("_who", F.xxhash64(who, "_mark")).withColumn("_id", who)
    keys = ["_who", "_id", "_mark"]
    firsts = keyed.groupBy(*keys).agg(F.min(F.struct("turn")).alias("_first"))
    joined = join_apart(keyed, firsts, keys)
    again = ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    blank = F.col("_fault") == 2
    one = _letter(F.when(again & ~blank, 3).otherwise(F.col("_fault")), F.col("_kind"))
    more = F.repeat(_letter(F.when(blank, 2).otherwise(3), F.col("_kind")), (F.col("_n") - 1).cast("int"))
    letters = joined.select("conv_id", "turn", "_mark", F.concat(one, more).alias("_letters"))
    letters = settle(letters, "letters")
    order = ["conv_id", "turn", "_mark"]
    sorted_rows = letters.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {f.name: f.dataType.simpleString() for f in letters.schema.fields}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, _mark binary, _letters string"
    pieces = sorted_rows.mapInArrow(_pieces, schema)
    in_order = F.sort_array(F.collect_list(F.struct("turn", "_mark", "_letters")))
    whole = F.array_join(F.transform(in_order, lambda p: p["_letters"]), "")
    return pieces.groupBy("conv_id").agg(whole.alias("signature"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of each run of rows of one conversation, under the place of its first row."""
    place, held = None, []
    for batch in batches:
        out = []
        for conv, turn, mark, letters in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place is None or place[0] != conv:
                if place is not None:
                    out.append((*place, "".join(held)))
                place, held = (conv, turn, mark), []
            held.append(letters)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), batch.schema.types)], schema=batch.schema)
    if place is not None:
        last = zip((*place, "".join(held)), batch.schema.types)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in last], schema=batch.schema)


class State:
    """A state of the automaton: what is left of a word, and the cheapest repairs of it.

    `costs` and `edits` have an entry for each state of the grammar; `edits` are links (edit,
    rest), so words that share an end share its edits. `faults` counts blank, duplicate and truncated
    rows and illegal neighbours in what is left.
    """

    __slots__ = ("costs", "edits", "faults", "letter")

    def __init__(self, letter: str = "", rest: State | None = None):
        self.letter = letter
        if rest is None:
            choices = {START: [(0, "", None)], AFTER_S: [], AFTER_U: [], AFTER_A: [(0, "", None)]}
            self.faults = (0, 0, 0, 0)
        else:
            choices = {g: self._taking(letter, rest, g) for g in WANTED}
            self.faults = self._counted(letter, rest)
        self._settle(choices)

    @staticmethod
    def _counted(letter: str, rest: State) -> tuple[int, ...]:
        pair = CLEAN[_kind(letter)] + CLEAN[_kind(rest.letter)] if rest.letter else LEGAL[0]
        found = (letter in BLANK, letter in DUPLICATE, letter in TRUNCATED, pair not in LEGAL)
        return tuple(a + b for a, b in zip(rest.faults, found))

    @staticmethod
    def _taking(letter: str, rest: State, grammar: int) -> list[tuple]:
        """Ways to deal with the first row of what is left."""
        ways = [(COSTS[DELETE] + rest.costs[grammar], DELETE, rest.edits[grammar])]
        if letter in BLANK or letter in DUPLICATE:
            return ways
        broken = BROKEN if letter in TRUNCATED else 0
        role, (wanted, after) = CLEAN[_kind(letter)], WANTED[grammar]
        ways.append((COSTS[REROLE] + broken + rest.costs[after], REROLE, rest.edits[after]))
        kept = after if role == wanted else AFTER_S if role == "s" and grammar == START else None
        if kept is not None:
            ways.append((COSTS[KEEP] + broken + rest.costs[kept], KEEP, rest.edits[kept]))
        return ways

    def _settle(self, choices: dict[int, list[tuple]]) -> None:
        """Add insertions, which stay at this state, and take the least cost, then the least edits.

        Two insertions in a row reach every state of the grammar that is worth it. The ways out
        of a state differ in their first edit, so that alone decides between equal costs.
        """
        far = float("inf")
        self.costs = [min((w[0] for w in choices[g]), default=far) for g in WANTED]
        for _ in range(2):
            self.costs = [min(c, COSTS[INSERT] + self.costs[WANTED[g][1]]) for g, c in enumerate(self.costs)]
        self.edits = [None] * len(WANTED)
        for g in (AFTER_A, AFTER_U, START, AFTER_S):
            self._choose(g, choices)

    def _choose(self, grammar: int, choices: dict[int, list[tuple]]) -> tuple | None:
        best = min((w for w in choices[grammar] if w[0] == self.costs[grammar]), key=lambda w: w[1], default=None)
        after = WANTED[grammar][1]
        inserted = COSTS[INSERT] + self.costs[after] == self.costs[grammar]
        if inserted and (best is None or INSERT < best[1]):
            self.edits[grammar] = (INSERT, self._choose(after, choices))
        else:
            self.edits[grammar] = (best[1], best[2]) if best[1] else None
        return self.edits[grammar]


def _kind(letter: str) -> int:
    return (CLEAN + TRUNCATED + BLANK + DUPLICATE).index(letter) % 4


def walk(words: Iterator[str]) -> Iterator[tuple[str, State]]:
    """Each word with the state it enters at, for words that come sorted from their ends.

    Words with a common end follow each other, so the states of the last word's ends are all
    that is kept, and a state is made once.
    """
    path, last = [State()], ""
    for word in words:
        turned = word[::-1]
        shared = 0
        for a, b in zip(turned, last):
            if a != b:
                break
            shared += 1
        del path[shared + 1 :]
        for letter in turned[shared:]:
            path.append(State(letter, path[-1]))
        last = turned
        yield word, path[-1]


def audit_of(state: State) -> str:
    out, link = [], state.edits[START]
    while link is not None:
        out.append(link[0])
        link = link[1]
    return "".join(out)


AUDIT = "signature string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    schema = pa.schema(
        [("signature", pa.string())]
        + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string())]
    )
    make = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    size = 0
    for word, state in walk(w for b in batches for w in b.column(0).to_pylist()):
        held.append((word, *state.faults, state.costs[START], audit_of(state)))
        size += 2 * len(word) + 50
        if size > 1 << 22:
            yield make(held)
            held, size = [], 0
    if held:
        yield make(held)


def audits(signed: DataFrame) -> DataFrame:
    """(conv_id, signature, counts of faults, cost, audit) from (conv_id, signature).

    A word goes through the automaton once, however many conversations have it. Where two tasks
    meet, the states on the path of the cut are made in both.
    """
    words = signed.groupBy("signature").agg(F.count("*").alias("_n"))
    turned = words.select("signature", F.reverse("signature").alias("_turned"))
    turned = settle(turned, "words")
    ordered = turned.repartitionByRange("_turned").sortWithinPartitions("_turned").select("signature")
    return join_apart(signed, ordered.mapInArrow(_audited, AUDIT), ["signature"])


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): every conversation after its edits, from `_rows`.

    The rows of a conversation come in one partition and in order. They stream past their audit,
    which sorts before them, so no text is gathered.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    plan = audited.select(
        "conv_id", F.lit(0).alias("_kind"), F.lit(None).cast(kinds["turn"]).alias("turn"),
        F.lit(None).cast("binary").alias("_mark"), F.lit("").alias("role"), F.col("audit").alias("text"),
    )
    both = plan.unionByName(rows.select("conv_id", F.lit(1).alias("_kind"), "turn", "_mark", "role", "text"))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "_kind", "turn", "_mark")
    conv = kinds["conv_id"]
    return ordered.select("conv_id", "_kind", "role", "text").mapInArrow(
        _edited, f"conv_id {conv}, place bigint, edit string, role string, text string"
    )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, audit, at, grammar, place = None, "", 0, START, 0
    out: list[tuple] = []

    def put(edit: str, role: str, text: str) -> None:
        nonlocal grammar, place
        wanted, after = WANTED[grammar]
        if edit == KEEP:
            grammar = AFTER_S if role[:1] == "s" else after
        else:
            role, grammar = NAMES[wanted], after
        out.append((conv, place, edit, role, text))
        place += 1

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == INSERT:
            put(INSERT, "", "")
            at += 1

    schema = None
    make = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    for batch in batches:
        schema = schema or pa.schema(
            [("conv_id", batch.schema.types[0]), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
        )
        for who, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                insert()
                conv, audit, at, grammar, place = who, text, 0, START, 0
                continue
            insert()
            edit, at = audit[at], at + 1
            if edit != DELETE:
                put(edit, role, text)
        if out:
            yield make()
            out.clear()
    insert()
    if out:
        yield make()


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of `repaired`'s rows as `role:text` lines, which pass in order."""
    conv = turns.schema["conv_id"].dataType.simpleString()
    lines = turns.select("conv_id", "place", "role", "text")
    return lines.mapInArrow(_hashed, f"conv_id {conv}, repaired_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha, schema = None, None, None
    for batch in batches:
        schema = schema or pa.schema([("conv_id", batch.schema.types[0]), ("repaired_sha256", pa.string())])
        out = []
        for who, place, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place == 0:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha = who, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((conv, sha.hexdigest()), schema.types)], schema=schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The findings of every conversation with rows, and its repaired turns."""
    rows = _rows(conversations)
    audited = settle(audits(settle(signatures(rows), "signatures")), "audits")
    return audited, repaired(rows, audited)


def gaps(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps): turn numbers missing between the first and the last of a conversation."""
    turns = conversations.select("conv_id", "turn").distinct().groupBy("conv_id")
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.agg(F.coalesce(missing, F.lit(0)).cast("bigint").alias("gaps"))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_list(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of `conversations`, for what is left of them in `rows`."""
    audited, turns = repair(rows)
    parts = [
        conversations.select("conv_id").distinct(),
        gaps(rows),
        audited.drop("signature"),
        digests(turns),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    nothing = hashlib.sha256().hexdigest()
    return every.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )


def _damaged_sql() -> str:
    known = lambda c: f"coalesce({c}::varchar, ' ')"
    case = f"{crc32_sql('spot')} % {CASES}"
    return f"""spots as (select conv_id, turn, {known('role')} as role, {known('text')} as text,
            {known('conv_id')} || ':' || {known('turn')} as spot from conversations),
    cases as (select *, {case} as c from spots),
    damaged as (select conv_id, turn, case when c = {AS_USER} then 'user' else role end as role,
            case when c = {EMPTY} then '' when c = {UNFINISHED} then translate(text, '.!?', '') else text end as text,
            unnest(range(case when c = {REPEAT} then 2 else 1 end)) as copy
        from cases where c <> {DROP})"""


def _way(cost: str, edit: str, rest: str, line: str | None = None, when: str = "true") -> str:
    """A repair as (cost, audit, lines): an edit in front of the repair of what is left."""
    lines = f"{rest}.lines" if line is None else f"list_prepend({line}, {rest}.lines)"
    price = f"case when {when} then {cost} + {rest}.cost else 1000000000 end"
    return f"{{'cost': {price}, 'audit': '{edit}' || {rest}.audit, 'lines': {lines}}}"


def _best_sql(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def repair_sql() -> str:
    """The same repairs, each conversation from its last row to its first."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    taking, inserting = [], []
    for g, (wanted, after) in WANTED.items():
        stays = "fault not in ('blank', 'duplicate')"
        broken = f"(fault = 'truncated')::int * {BROKEN}"
        ways = [
            _way(str(COSTS[DELETE]), DELETE, f"f{g}"),
            _way(f"{COSTS[REROLE]} + {broken}", REROLE, f"f{after}", f"'{NAMES[wanted]}:' || text", stays),
            _way(broken, KEEP, f"f{after}", "role || ':' || text", f"{stays} and role[1] = '{wanted}'"),
        ]
        if g == START:
            ways.append(_way(broken, KEEP, f"f{AFTER_S}", "role || ':' || text", f"{stays} and role[1] = 's'"))
        taking.append(f"{_best_sql(*ways)} as b{g}")
    put = lambda rest, g: _way(str(COSTS[INSERT]), INSERT, rest, f"'{NAMES[WANTED[g][0]]}:'")
    inner = ", ".join(
        f"{_best_sql(f'b{g}', put(f'b{WANTED[g][1]}', g))} as f{g}" for g in (AFTER_U, AFTER_A)
    )
    outer = ", ".join(f"{_best_sql(f'b{g}', put(f'f{AFTER_U}', g))} as f{g}" for g in (START, AFTER_S))
    end = lambda cost, audit, lines: f"{{'cost': {cost}, 'audit': '{audit}', 'lines': {lines}::varchar[]}}"
    ends = [end(0, "", "[]"), end(4, "II", "['user:', 'assistant:']"), end(2, "I", "['assistant:']"), end(0, "", "[]")]
    same = lambda a, b: f"{a}.conv_id is not distinct from {b}.conv_id"
    return f"""with recursive {_damaged_sql()},
    numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n,
            rtrim(text, {blanks}) as ended from damaged),
    told as (select *, case when ended = '' then 'blank'
            when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate'
            when right(ended, 1) in ('.', '!', '?') then '' else 'truncated' end as fault,
            lag(role[1]) over (partition by conv_id order by n) || role[1] as pair from numbered),
    found as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
            count(*) filter (fault = 'truncated') as truncated,
            count(*) filter (pair not in {LEGAL}) as illegal, max(n) as n
        from told group by conv_id),
    steps as (
        select conv_id, n + 1 as n, {', '.join(f'{e} as f{g}' for g, e in enumerate(ends))} from found
        union all
        select conv_id, n, f0, f1, f2, f3 from (
            select *, {outer} from (
                select *, {inner} from (
                    select t.conv_id, t.n, {', '.join(taking)}
                    from steps s join told t on {same('s', 't')} and t.n = s.n - 1) as a) as b) as c),
    ids as (select distinct conv_id from conversations)
    select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
        coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
        coalesce(s.f0.cost, 0)::bigint as cost, coalesce(s.f0.audit, '') as audit,
        sha256(coalesce(array_to_string(s.f0.lines, chr(10)), '')) as repaired_sha256
    from ids i left join found f on {same('i', 'f')} left join steps s on {same('i', 's')} and s.n = 1"""
