"""List text as stored on a user: '' or a JSON array."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ROWS = "array<array<string>>"
ITEMS = "array<string>"


def parse_list(text: Column, kind: str = ITEMS) -> Column:
    empty = F.from_json(F.lit("[]"), kind)
    return F.when(text == "", empty).otherwise(F.from_json(text, kind))


def _quoted(value: Column) -> Column:
    boxed = F.to_json(F.array(value))
    return F.substring(boxed, F.lit(2), F.length(boxed) - 2)


def dump_items(items: Column) -> Column:
    """JSON text with a space after each comma, as the service stores it."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, _quoted), ", "), F.lit("]"))


def dump_rows(rows: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(rows, dump_items), ", "), F.lit("]"))


def row_ids(rows: Column, field: int) -> Column:
    return F.transform(rows, lambda row: F.element_at(row, field + 1))


def index_of(ids: Column, wanted: Column) -> Column:
    """Position from 0, or -1."""
    return (F.array_position(ids, wanted) - 1).cast("int")


def drop_first(ids: Column, wanted: Column) -> Column:
    """The list without the first occurrence of a value."""
    at = F.array_position(ids, wanted)
    return F.filter(ids, lambda _, i: i != at - 1)
