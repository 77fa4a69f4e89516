"""District codes: ten digits, read by prefixes of 2, 4, 5, 8 and 10."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import NO_REGION

PREFIX_LENGTHS = [2, 4, 5, 8, 10]


def region_prefix(bcode: Column, level: Column) -> Column:
    """The leading part of a region's code that all codes inside it share.

    Null for a level outside 1 to 3, so that such a region counts nothing.
    """
    padded = lambda length: F.substr(bcode, F.lit(length + 1)) == "0" * (10 - length)
    by_five = F.when(padded(5), F.left(bcode, F.lit(5)))
    by_four = F.when(padded(4), F.left(bcode, F.lit(4)))
    eight = F.left(bcode, F.lit(8))
    return (
        F.when(level == 1, F.left(bcode, F.lit(2)))
        .when(level == 2, F.coalesce(by_four, by_five, eight))
        .when(level == 3, F.coalesce(by_five, F.when(padded(8), eight), bcode))
    )


def code_prefixes(code: Column) -> Column:
    """All prefixes of a code that a region may be matched by."""
    cuts = [F.when(F.length(code) >= n, F.left(code, F.lit(n))) for n in PREFIX_LENGTHS]
    return F.array_compact(F.array(*cuts))


def region_level(name: Column) -> Column:
    """Number of words in a district name, three at most."""
    return F.least(F.size(F.split(name, " ")), F.lit(3))


def last_word(name: Column) -> Column:
    return F.element_at(F.split(name, " "), -1)


def code_or_failed(code: Column) -> Column:
    return F.coalesce(code, F.lit(NO_REGION))


def needs_region(code: Column) -> Column:
    return (code == NO_REGION) | code.isNull()
