"""A spatial order of points: the bits of both coordinates in turn.

Points near each other get codes near each other, so rows in order of their codes lie in files
that each cover a small part of the map, and a section of the map is a few ranges of codes.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each coordinate: steps of about 20 and 10 metres.
BITS = 21


class Box(NamedTuple):
    """A section of the map; its edges belong to it."""

    south: float
    west: float
    north: float
    east: float


def _step(value: Column, low: float, span: float) -> Column:
    whole = F.floor((value - low) / span * float(1 << BITS))
    kept = F.least(F.greatest(whole, F.lit(0)), F.lit((1 << BITS) - 1)).cast("bigint")
    return F.when(value.isNotNull(), kept)


def _spread(x: Column) -> Column:
    """The bits of a number with a gap after each, by halves of halves."""
    for shift in (16, 8, 4, 2, 1):
        mask = sum(((1 << shift) - 1) << (2 * shift * k) for k in range(64 // (2 * shift)))
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def place_code(latitude: Column, longitude: Column) -> Column:
    """The interleaved code of a point; null where a coordinate is."""
    y, x = _step(latitude, -90.0, 180.0), _step(longitude, -180.0, 360.0)
    return F.shiftleft(_spread(y), 1).bitwiseOR(_spread(x))


def in_box(box: Box) -> Column:
    return F.col("latitude").between(box.south, box.north) & F.col("longitude").between(box.west, box.east)


def code_ranges(box: Box, most: int = 64) -> list[tuple[int, int]]:
    """Ranges of codes, both ends included, that cover a box; at most about ``most`` of them.

    Squares of the map are cut in four as long as they lie partly outside; those left are
    taken whole, so the ranges may cover more than the box and never less.
    """

    def step(value: float, low: float, span: float) -> int:
        return min(max(int((value - low) / span * (1 << BITS) // 1), 0), (1 << BITS) - 1)

    south, north = step(box.south, -90.0, 180.0), step(box.north, -90.0, 180.0)
    west, east = step(box.west, -180.0, 360.0), step(box.east, -180.0, 360.0)
    # a square: its code without the low bits, its level, and its lower corner
    squares, level, done = [(0, 0, 0)], BITS, []
    while squares and level and len(done) + len(squares) <= most // 2:
        level -= 1
        size, smaller = 1 << level, []
        for code, y, x in squares:
            for part in range(4):
                low_y, low_x = y + (part >> 1) * size, x + (part & 1) * size
                if low_y > north or low_y + size - 1 < south or low_x > east or low_x + size - 1 < west:
                    continue
                square = (code << 2 | part, low_y, low_x)
                inside = low_y >= south and low_y + size - 1 <= north and low_x >= west and low_x + size - 1 <= east
                if inside:
                    done.append((square[0] << 2 * level, ((square[0] + 1) << 2 * level) - 1))
                else:
                    smaller.append(square)
        squares = smaller
    done += [(code << 2 * level, ((code + 1) << 2 * level) - 1) for code, _, _ in squares]
    return _merged(sorted(done))


def _merged(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in ranges:
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out
