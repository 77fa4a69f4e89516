"""Line-first cleaning: rules judge single lines, then documents by what is left of them.

A line fails as navigation, as boilerplate, as a copy of an earlier line, without the end of
a sentence, as a run of exclamations, of one word or of symbols. Failed lines go; a
document that loses more than `MAX_LOST` of its word characters goes as well. Words are runs of characters other than
space, tab, newline, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_arrow, texts_of

SPACE = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: A document is rejected when over this percentage of its words lies in repeated windows.
MAX_REPEATED = 50
#: Largest share of the word characters that line cleaning may take from a kept document.
MAX_LOST = 0.3
#: A line with more than this share of symbols, or of one repeated word, fails.
MAX_SYMBOLS, MAX_ONE_WORD, REPEAT_WORDS = 0.1, 0.5, 6
#: More exclamation and question marks than words times this fail a line, from MARKS marks on.
MAX_MARKS, MARKS = 0.5, 4

# The expressions are read alike by Python and by DuckDB.
NAVIGATION = r"^[^|»›•]*([|»›•][^|»›•]*){3,}$|^[^.!?]{0,40} [»›>] [^.!?]{0,40} [»›>] [^.!?]*$"
BOILERPLATE = (
    r"(cookie policy|privacy policy|terms of (use|service)|all rights reserved|accept (all )?cookies"
    r"|enable javascript|javascript is (disabled|required)|lorem ipsum|click here to|sign up for our"
    r"|subscribe to our newsletter|skip to (main )?content|©|\(c\) *[0-9]{4})"
)
SENTENCE_END = r"[.!?:;…。！？][\"'”’»)\]]*($|[\x20\x09-\x0D])"

_SPACES = re.compile(f"[{SPACE}]+")
_NAVIGATION, _BOILERPLATE, _SENTENCE_END = map(re.compile, (NAVIGATION, BOILERPLATE, SENTENCE_END))


def bad_line(line: str) -> bool:
    """Whether a line with at least one word fails a rule that looks at this line alone."""
    body = line.strip(SPACE)
    words = _SPACES.split(body)
    chars = sum(map(len, words))
    symbols = sum(body.count(s) for s in SYMBOLS)
    marks = body.count("!") + body.count("?")
    return (
        _SENTENCE_END.search(body) is None
        or symbols > MAX_SYMBOLS * chars
        or (marks >= MARKS and marks > MAX_MARKS * len(words))
        or (len(words) >= REPEAT_WORDS and _most_common(words) > MAX_ONE_WORD * len(words))
        or _NAVIGATION.search(body) is not None
        or _BOILERPLATE.search(body.lower()) is not None
    )


def _most_common(words: Sequence[str]) -> int:
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    return max(counts.values())


def clean(text: str) -> tuple[str, int]:
    """The text without its failed lines, and the word characters these had.

    Lines without a word stay.
    """
    kept, lost, seen = [], 0, set()
    for line in text.split("\n"):
        if line.strip(SPACE) and (line in seen or bad_line(line)):
            lost += word_chars(line)
        else:
            kept.append(line)
        seen.add(line)
    return "\n".join(kept), lost


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, SPACE))


def repeated_words(words: Sequence[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    count = len(words)
    if count < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, count)
    base = len(number)
    if base < 1 << 21:
        windows = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:  # three ids do not fit 63 bits
        pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * base + ids[2:]
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    covered = np.zeros(count, dtype=bool)
    for shift in range(3):
        covered[shift : shift + count - 2] |= twice
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


_ADDED = [
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_dup_lines", "long"),
    ("n_repeat_words", "long"),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
    ("lost_chars", "long"),
    ("clean_text", "string"),
]
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def measure(text: str | None) -> tuple:
    """All added columns of one text; a null text has no words, and none left."""
    body = text or ""
    words = body.encode("utf-8", "surrogatepass").split()  # splits at SPACE, no more
    chars, repeated = word_chars(body), repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
    left, lost = clean(body)
    kept = not failed and lost <= MAX_LOST * chars
    symbols = sum(map(body.count, SYMBOLS))
    return (
        len(words), chars, symbols, repeated_lines(body), repeated, failed, kept, lost,
        None if text is None else left,
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of the input and the measures of each text: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, lost_chars and clean_text.

    Empty and null texts fail for want of words. Repeated rows are judged alike, each
    row by itself. Input columns with the names of results are replaced.
    """
    own = docs.drop(*[name for name, _ in _ADDED if name != text])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t) for t in texts_of(batch, text)]
        added = [
            pa.array([r[i] for r in rows], _ARROW[kind]) for i, (_, kind) in enumerate(_ADDED)
        ]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *added], names=[*batch.schema.names, *[n for n, _ in _ADDED]]
        )

    fields = [T.StructField(n, T._parse_datatype_string(k)) for n, k in _ADDED]
    return map_arrow(own, run, T.StructType([*own.schema.fields, *fields]))


def quality_list(docs: DataFrame) -> DataFrame:
    """doc_id, the base measures and the verdict of every document."""
    judged = judge(docs.select("doc_id", "text"))
    return judged.select("doc_id", *[name for name, _ in _ADDED if name != "clean_text"])


def quality_sql() -> str:
    """The same list in DuckDB."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    spaces, blank = r"'[\x20\x09-\x0D]'", r"'[\x20\x09-\x0D]+'"
    return rf"""
        with docs as (
            select row_number() over () as rid, doc_id, coalesce(text, '') as body from documents),
        words as (
            select rid, word, row_number() over (partition by rid order by i) as nth
            from (select rid, unnest(string_split_regex(body, {blank})) as word,
                    generate_subscripts(string_split_regex(body, {blank}), 1) as i from docs)
            where word <> ''),
        windows as (
            select rid, nth, word, lead(word) over w as second, lead(word, 2) over w as third
            from words window w as (partition by rid order by nth)),
        twice as (
            select rid, nth, count(*) over (partition by rid, word, second, third) > 1 as again
            from windows where third is not null),
        covered as (
            select rid, count(distinct nth + shift) as n_repeat_words
            from twice, range(3) as r(shift) where again group by rid),
        counted as (select rid, count(*) as n_words from words group by rid),
        lines as (
            select rid, i, line, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) as body
            from (select rid, unnest(string_split(body, chr(10))) as line,
                    generate_subscripts(string_split(body, chr(10)), 1) as i from docs)),
        full_lines as (
            select *, regexp_replace(body, {spaces}, '', 'g') as dense,
                string_split_regex(body, {blank}) as parts
            from lines where body <> ''),
        judged as (
            select rid, line, length(dense) as chars,
                row_number() over (partition by rid, line order by i) > 1
                or not regexp_matches(body, {quoted(SENTENCE_END)})
                or length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) > {MAX_SYMBOLS} * length(dense)
                or (length(regexp_replace(body, '[^!?]', '', 'g')) >= {MARKS} and
                    length(regexp_replace(body, '[^!?]', '', 'g')) > {MAX_MARKS} * len(parts))
                or (len(parts) >= {REPEAT_WORDS}
                    and list_max(map_values(list_histogram(parts))) > {MAX_ONE_WORD} * len(parts))
                or regexp_matches(body, {quoted(NAVIGATION)})
                or regexp_matches(lower(body), {quoted(BOILERPLATE)}) as bad
            from full_lines),
        by_doc as (
            select rid, count(*) - count(distinct line) as n_dup_lines, sum(chars)::bigint as word_chars,
                coalesce(sum(chars) filter (bad), 0)::bigint as lost_chars
            from judged group by rid),
        measured as (
            select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
                length(regexp_replace(docs.body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
                coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
                coalesce(lost_chars, 0) as lost_chars
            from docs left join counted using (rid) left join by_doc using (rid)
                left join covered using (rid)),
        failing as (
            select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words
                as base_failed from measured)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            not base_failed and lost_chars <= {MAX_LOST} * word_chars as kept, lost_chars
        from failing"""
