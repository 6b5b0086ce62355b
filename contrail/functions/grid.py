"""Grid cells of about 11 km and bounding-box identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def grid_cell(lat: Column, lon: Column, digits: int = 1) -> Column:
    """``"<lat>_<lon>"``, both rounded half-up; null when either is null."""
    return F.concat(F.round(lat, digits).cast("string"), F.lit("_"), F.round(lon, digits).cast("string"))


def split_grid_cell(cell: Column) -> tuple[Column, Column]:
    """The two coordinates of a cell; null where the text is not a cell."""
    parts = F.split(cell, "_")
    return tuple(F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))


def bbox_id(lamin: float, lamax: float, lomin: float, lomax: float) -> str:
    """Identifier of a bounding box, built once on the driver from the job's arguments."""
    return "_".join(str(round(float(bound), 1)) for bound in (lamin, lamax, lomin, lomax))


MORTON_BITS = 16


def _spread(value: Column) -> Column:
    """The low 16 bits of a number with a zero between every two."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def _cell(value: Column, low: float, span: float) -> Column:
    """Which of 2^16 equal parts of the span a value lies in, the last one with its end."""
    at = F.floor((value - low) / span * (1 << MORTON_BITS))
    return F.when(value.isNotNull(), F.least(F.greatest(at, F.lit(0)), F.lit((1 << MORTON_BITS) - 1)))


def morton_code(lat: Column, lon: Column) -> Column:
    """Position on a curve that keeps near places together: the bits of both coordinates' parts, interleaved. Null
    without a position."""
    return _spread(_cell(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_cell(lat, -90.0, 180.0)), 1))


def morton_ranges(lamin: float, lamax: float, lomin: float, lomax: float, most: int = 64) -> list[tuple[int, int]]:
    """At most about ``most`` ranges of codes that together hold every place of the box. Squares of the curve are
    halved each way until they lie inside of the box or are outside of it, the largest first; what is left at the end is
    taken whole."""
    size = 1 << MORTON_BITS

    def part(value: float, low: float, span: float) -> int:
        return min(max(int((value - low) / span * size // 1), 0), size - 1)

    box = (part(lamin, -90.0, 180.0), part(lamax, -90.0, 180.0), part(lomin, -180.0, 360.0), part(lomax, -180.0, 360.0))
    if lamin > lamax or lomin > lomax:
        return []
    done: list[tuple[int, int]] = []
    open_squares = [(0, 0, 0, size)]  # first code, first part of latitude and longitude, side
    while open_squares and len(done) + 4 * len(open_squares) <= most:
        following = []
        for code, y, x, side in open_squares:
            half, quarter = side // 2, (side // 2) ** 2
            for k in range(4):
                a, b = y + half * (k >> 1), x + half * (k & 1)
                if a > box[1] or a + half - 1 < box[0] or b > box[3] or b + half - 1 < box[2]:
                    continue
                inside = a >= box[0] and a + half - 1 <= box[1] and b >= box[2] and b + half - 1 <= box[3]
                if inside or half == 1:
                    done.append((code + k * quarter, code + (k + 1) * quarter - 1))
                else:
                    following.append((code + k * quarter, a, b, half))
        open_squares = following
    done += [(code, code + side * side - 1) for code, _, _, side in open_squares]
    merged: list[tuple[int, int]] = []
    for low, high in sorted(done):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = merged[-1][0], max(high, merged[-1][1])
        else:
            merged.append((low, high))
    return merged
