"""Box search on a space-filling curve.

A place has a Morton code: the bits of its latitude and longitude, in steps of a grid over the
globe, by turns. Rows laid out by the code are near each other in files if they are near on the
map, in both directions. A box is cut into a bounded number of ranges of codes, by quarters of
quarters, which reach the scan beside the exact test of the coordinates.

A null or not a number in the coordinates gives a row that no box holds; what lies off the
globe goes to its edge, boxes too, so such rows are found as well.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geo

#: Steps of the grid are 2^BITS each way, 38 m of longitude at the equator.
BITS = 20
#: Ranges that a box is cut into at most.
RANGES = 32
#: Name of the code's column.
CODE = "place"

_STEPS = 2**BITS
_LAT, _LNG = (90.0, _STEPS / 180.0), (180.0, _STEPS / 360.0)  # shift and scale
# Each doubling of the gaps between bits: how far to shift, and the bits that stay.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
           (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(step: Column) -> Column:
    """The bits of a step with a free bit before each."""
    return reduce(lambda x, s: x.bitwiseOR(F.shiftleft(x, s[0])).bitwiseAND(F.lit(s[1])), _SPREAD, step)


def _step(value: Column, shift: float, scale: float) -> Column:
    step = F.floor((value.cast("double") + shift) * scale)
    return F.least(F.greatest(step, F.lit(0)), F.lit(_STEPS - 1)).cast("bigint")


def code(lat: Column, lng: Column) -> Column:
    return F.shiftleft(_spread(_step(lat, *_LAT)), 1).bitwiseOR(_spread(_step(lng, *_LNG)))


def _step_of(value: float, shift: float, scale: float) -> int:
    reach = min(max((float(value) + shift) * scale, 0.0), _STEPS - 1.0)
    return math.floor(reach)


def code_ranges(top: float, bottom: float, right: float, left: float, most: int = RANGES) -> list[tuple[int, int]]:
    """First and last code of stretches of the curve that hold the box, `most` at most, in order.

    A box that is empty has none.
    """
    low = (_step_of(bottom, *_LAT), _step_of(left, *_LNG))
    high = (_step_of(top, *_LAT), _step_of(right, *_LNG))
    if bottom > top or left > right:
        return []
    whole: list[tuple[int, int]] = []  # cells within the box: (first code, level)
    part = [(0, 0, 0, 0)]  # cells it cuts: first code, level, south and west step
    while part:
        inner, cut = [], []
        for start, level, y, x in part:
            if level == BITS:
                inner.append((start, level))
                continue
            side, codes = 1 << (BITS - level - 1), 1 << (2 * (BITS - level - 1))
            for quarter in range(4):
                south, west = y + side * (quarter >> 1), x + side * (quarter & 1)
                if south > high[0] or west > high[1] or south + side <= low[0] or west + side <= low[1]:
                    continue
                inside = low[0] <= south and south + side - 1 <= high[0] and low[1] <= west and west + side - 1 <= high[1]
                cell = (start + quarter * codes, level + 1)
                inner.append(cell) if inside else cut.append((*cell, south, west))
        cells = [*whole, *inner, *[(start, level) for start, level, *_ in cut]]
        if len(_joined(cells)) > most:
            break
        whole, part = whole + inner, cut
    return _joined([*whole, *[(start, level) for start, level, *_ in part]])


def _joined(cells: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, level in sorted(cells):
        end = start + (1 << (2 * (BITS - level))) - 1
        if out and out[-1][1] + 1 == start:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def by_curve(rows: DataFrame) -> DataFrame:
    """Rows with their code, laid out along the curve. A place with very many rows is divided by station."""
    placed = rows.withColumn(CODE, code(F.col("lat"), F.col("lng")))
    ranges = [CODE, *[k for k in ("statid", "chgerid") if k in rows.columns]]
    return placed.repartitionByRange(*ranges).sortWithinPartitions(*ranges)


def in_box(rows: DataFrame, top: float, bottom: float, right: float, left: float) -> DataFrame:
    """Rows in a box, edges included, of a table that was laid out by_curve; without the code."""
    found = code_ranges(top, bottom, right, left)
    along = [F.col(CODE).between(a, b) for a, b in found]
    near = reduce(lambda a, b: a | b, along, F.lit(False))
    exact = geo.in_box(F.col("lat"), F.col("lng"), top, bottom, right, left)
    return rows.filter(near & exact).drop(CODE)
