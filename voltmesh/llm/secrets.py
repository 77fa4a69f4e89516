"""Secret scan by a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams that every match must
contain. A run of documents is a segment of the index: its posting lists hold, for each
trigram a rule asks for, the documents with it. A rule's query is answered by
intersecting and joining posting lists, and only the documents found are searched with the
expression itself. Rules that require no trigram are searched in every document.
Segments are made where the documents lie, so no text is moved. Trigrams are of UTF-8
bytes with A-Z lower-cased; a candidate too many costs time, never a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre, _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import map_arrow, texts_of


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost first, whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


BASE = (
    Rule(
        "assign",
        f"({_either_case('password|passwd|secret|token|api_?key')})"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    # A run of 32 and more is the same whether or not shorter runs are matched and dropped.
    Rule("hex", "[0-9a-f]{32,}", 0, 32),
)
JWT = Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", "AIza[A-Za-z0-9_-]{35}"),
    JWT,
    Rule("url", r"://[^\x20\x09-\x0D/:@]{1,}:[^\x20\x09-\x0D/:@]{3,}@"),
)
RULES = BASE + MORE

# ---- Boolean trigram queries ------------------------------------------------------------

#: A query is True (no trigram is required), a trigram, ("and", parts) or ("or", parts).
Query = bool | bytes | tuple

#: Most strings kept in a set before it is turned into a query.
STRINGS, CLASS = 64, 10


def _parts(kind: str, query: Query) -> tuple:
    return query[1] if isinstance(query, tuple) and query[0] == kind else (query,)


def _and(parts: Sequence[Query]) -> Query:
    kept = tuple(dict.fromkeys(q for p in parts if p is not True for q in _parts("and", p)))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _or(parts: Sequence[Query]) -> Query:
    """Alternatives that require all that another one requires, and more, are left out."""
    if True in parts:
        return True
    every = dict.fromkeys(frozenset(_parts("and", q)) for p in parts for q in _parts("or", p))
    least = [e for e in every if not any(other < e for other in every)]
    kept = tuple(_and(sorted(e, key=str)) for e in least)
    return kept[0] if len(kept) == 1 else ("or", kept)


def _of_string(text: bytes) -> Query:
    return _and([text[i : i + 3] for i in range(len(text) - 2)])


def _of_set(texts: frozenset[bytes]) -> Query:
    return _or([_of_string(t) for t in sorted(texts)])


@dataclass(frozen=True)
class _Info:
    """What matches look like: all of them if `exact`, else how they begin and end."""

    exact: frozenset[bytes] | None
    first: frozenset[bytes]
    last: frozenset[bytes]
    needs: Query = True


_EMPTY = frozenset([b""])
_NOTHING = _Info(_EMPTY, _EMPTY, _EMPTY)
_ANYTHING = _Info(None, _EMPTY, _EMPTY)


def _exact(texts: frozenset[bytes]) -> _Info:
    if len(texts) <= STRINGS:
        return _Info(texts, texts, texts)
    return _open(texts, texts, True)


def _open(first: frozenset[bytes], last: frozenset[bytes], needs: Query) -> _Info:
    """Not exact: long beginnings and ends go into the query, two bytes of each stay."""
    needs = _and([needs, _of_set(first), _of_set(last)])
    first, last = frozenset(t[:2] for t in first), frozenset(t[-2:] for t in last)
    return _Info(
        None, first if len(first) <= STRINGS else _EMPTY, last if len(last) <= STRINGS else _EMPTY, needs
    )


def _cross(a: frozenset[bytes], b: frozenset[bytes]) -> frozenset[bytes]:
    if len(a) * len(b) > STRINGS * STRINGS:
        return _EMPTY
    return frozenset(x + y for x, y in product(a, b))


def _then(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= STRINGS:
        return _exact(_cross(a.exact, b.exact))
    first = _cross(a.exact, b.first) if a.exact is not None else a.first
    last = _cross(a.last, b.exact) if b.exact is not None else b.last
    return _open(first, last, _and([a.needs, b.needs, _of_set(_cross(a.last, b.first))]))


def _either(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None:
        return _exact(a.exact | b.exact)
    sides = [x if x.exact is None else _open(x.exact, x.exact, True) for x in (a, b)]
    return _open(
        sides[0].first | sides[1].first, sides[0].last | sides[1].last, _or([s.needs for s in sides])
    )


def _char(code: int) -> bytes:
    char = chr(code)
    return (char.lower() if code < 128 else char).encode("utf-8", "surrogatepass")


def _class(items: list) -> _Info:
    found: set[int] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(value)
        elif op is sre.RANGE and value[1] - value[0] < 2 * CLASS:
            found.update(range(value[0], value[1] + 1))
        else:
            return _ANYTHING
    texts = frozenset(_char(c) for c in found)
    return _exact(texts) if len(texts) <= CLASS else _ANYTHING


def _info(items) -> _Info:
    return reduce(_then, (_node(op, value) for op, value in items), _NOTHING)


def _node(op, value) -> _Info:
    if op is sre.LITERAL:
        return _exact(frozenset([_char(value)]))
    if op is sre.IN:
        return _class(value)
    if op is sre.SUBPATTERN:
        return _info(value[-1])
    if op is sre.BRANCH:
        return reduce(_either, map(_info, value[1]))
    if op is sre.AT:
        return _NOTHING
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inside = value
        one = _info(inside)
        if least == 0:
            return _either(one, _NOTHING) if most == 1 else _ANYTHING
        out = reduce(_then, [one] * min(least, 3))
        return out if least == most <= 3 else _then(_then(out, _ANYTHING), one)
    return _ANYTHING


def trigram_query(pattern: str) -> Query:
    """The trigrams that a text has to contain for the pattern to match in it."""
    info = _info(parser.parse(pattern))
    return _of_set(info.exact) if info.exact is not None else info.needs


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, tuple):
        return set().union(*map(trigrams_of, query[1]))
    return set() if query is True else {query}


# ---- A segment of the index -------------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Bytes looked at together while posting lists are made.
STRIDE = 4 << 20


def _code(trigram: bytes) -> int:
    return int.from_bytes(trigram, "big")


class Segment:
    """Posting lists of some texts for the given trigrams."""

    def __init__(self, texts: Sequence[bytes], trigrams: set[bytes]):
        self.count = len(texts)
        wanted = np.zeros(1 << 24, dtype=bool)
        wanted[[_code(t) for t in trigrams]] = True
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = _FOLD[np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)]
        pairs = []
        for start in range(0, len(data) - 2, STRIDE):
            part = data[start : start + STRIDE + 2].astype(np.uint32)
            codes = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
            at = np.flatnonzero(wanted[codes])
            owner = np.searchsorted(ends, at + start, side="right")
            pairs.append(np.unique(codes[at].astype(np.int64) * self.count + owner))
        found = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        self.keys, self.docs = found // max(1, self.count), found % max(1, self.count)

    def posting(self, trigram: bytes) -> np.ndarray:
        code = _code(trigram)
        low, high = np.searchsorted(self.keys, [code, code + 1])
        return self.docs[low:high]

    def answer(self, query: Query) -> np.ndarray:
        """Ordinals of the texts that satisfy the query, ascending."""
        if query is True:
            return np.arange(self.count)
        if isinstance(query, bytes):
            return self.posting(query)
        kind, parts = query
        if kind == "or":
            return np.unique(np.concatenate([self.answer(p) for p in parts]))
        lists = sorted((self.answer(p) for p in parts), key=len)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists)


# ---- The operator -----------------------------------------------------------------------

_DOTTED = re.compile("[A-Za-z0-9_.-]+")


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the jwt rule, from one walk over runs of its letters and dots.

    The expression itself tries every `eyJ` of a run to the run's end, so a long text made of them takes it
    the square of its length.
    """
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        start, i = run.start(), 0
        while i + 2 < len(parts):
            at = parts[i].find("eyJ")
            if at >= 0 and len(parts[i]) - at - 3 >= 8 and min(len(parts[i + 1]), len(parts[i + 2])) >= 8:
                end = start + sum(map(len, parts[i : i + 3])) + 2
                yield start + at, end
                start, i = end + 1, i + 3
            else:
                start, i = start + len(parts[i]) + 1, i + 1


def matches(rule: Rule, compiled: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the rule's matches that are long enough."""
    if rule == JWT:
        yield from _tokens(text)
        return
    for match in compiled.finditer(text):
        if match.end(rule.group) - match.start(rule.group) >= rule.least:
            yield match.start(), match.end()


_FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)
_FOUND_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    name: str = "secrets",
    redact: bool = False,
) -> DataFrame:
    """Columns of the input and `name`: an array of kind, start, end of every match, in
    code points, by start and then by the order of the rules. With `redact` the
    text has each match, or run of overlapping ones, replaced by the first one's kind in
    brackets. Null and empty texts have no matches and stay what they are, texts of any length are searched
    whole in time that grows with the length, repeated rows get equal results. A column of that name is replaced.
    """
    kept = docs.drop(name)
    queries = [trigram_query(rule.pattern) for rule in rules]
    trigrams = set().union(*map(trigrams_of, queries))
    compiled = [re.compile(rule.pattern) for rule in rules]

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch, text)
        segment = Segment([(t or "").encode("utf-8", "surrogatepass") for t in texts], trigrams)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for nth, (rule, query) in enumerate(zip(rules, queries)):
            for i in segment.answer(query):
                found[i] += [(a, nth, b) for a, b in matches(rule, compiled[nth], texts[i] or "")]
        for own in found:
            own.sort()
        spans = [[{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in own] for own in found]
        columns = list(batch.columns)
        if redact:
            at = batch.schema.get_field_index(text)
            columns[at] = pa.array([_redacted(t, m, rules) for t, m in zip(texts, found)], pa.string())
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(spans, _FOUND_ARROW)], names=[*batch.schema.names, name]
        )

    return map_arrow(kept, scan, T.StructType([*kept.schema.fields, T.StructField(name, _FOUND)]))


def _redacted(
    text: str | None, matches: list[tuple[int, int, int]], rules: Sequence[Rule]
) -> str | None:
    if not matches:
        return text
    out, done, end = [], 0, -1
    for start, nth, stop in matches:
        if start >= end:
            out += [text[done:start], f"[{rules[nth].kind}]"]
        end = max(end, stop)
        done = end
    return "".join([*out, text[done:]])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secret_list(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans of every document."""
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(r.kind).alias(f"n_{r.kind}") for r in BASE]
    found = find_secrets(docs.select("doc_id", "text"), rules)
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans")
    )


def secret_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same list in DuckDB: positions from the lengths of matches and of what lies between."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    found = "\n            union all ".join(
        f"""select rid, '{r.kind}' as kind, {nth} as nth, {r.group} as part, {r.least} as least,
                {quoted(r.pattern)} as pattern,
                unnest(string_split_regex(body, {quoted(r.pattern)})) as piece,
                unnest(list_append(regexp_extract_all(body, {quoted(r.pattern)}), null)) as hit,
                unnest(range(len(string_split_regex(body, {quoted(r.pattern)})))) as i from rows"""
        for nth, r in enumerate(rules)
    )
    checks = " or ".join(
        f"(kind = '{r.kind}' and length(regexp_extract(hit, {quoted(r.pattern)}, {r.group})) >= {r.least})"
        for r in rules
    )
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    item = "kind || ':' || (stop - length(hit)) || ':' || stop, ',' order by stop - length(hit), nth"
    return f"""
        with rows as (
            select row_number() over () as rid, doc_id, coalesce(text, '') as body from documents),
        found as ({found}),
        placed as (
            select *, sum(length(piece) + coalesce(length(hit), 0))
                over (partition by rid, kind order by i)::bigint as stop from found),
        held as (select * from placed where hit is not null and ({checks})),
        listed as (
            select rid, {", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE)},
                coalesce(string_agg({item}) filter (kind in ({base})), '') as base,
                string_agg({item}) as spans
            from held group by rid)
        select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE)},
            sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from rows left join listed using (rid)"""
