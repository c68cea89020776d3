"""Equal-area hexagonal grid in plain column arithmetic.

Points are projected with the Lambert cylindrical equal-area projection and
binned into pointy-top hexagons. A finer resolution has cells seven times
smaller. Cells are named ``resolution:q:r`` with axial coordinates q and r.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371007.2
STANDARD_PARALLEL_DEG = 37.0
AREA_AT_8_KM2 = 0.7373
AREA_RATIO = 7

_COS_PARALLEL = math.cos(math.radians(STANDARD_PARALLEL_DEG))
_SQRT3 = math.sqrt(3.0)


def side_m(resolution: int) -> float:
    """Side of a hexagon at a resolution, from its mean area."""
    area = AREA_AT_8_KM2 * 1e6 * AREA_RATIO ** (8 - resolution)
    return math.sqrt(2.0 * area / (3.0 * _SQRT3))


def planar(lat: Column, lng: Column, resolution: int) -> tuple[Column, Column]:
    """Position (q, r) of a point in units of cells; straight lines on the plane stay straight."""
    side = side_m(resolution)
    x = F.radians(lng) * (EARTH_RADIUS_M * _COS_PARALLEL)
    y = F.sin(F.radians(lat)) * (EARTH_RADIUS_M / _COS_PARALLEL)
    return (x * (_SQRT3 / 3.0) - y / 3.0) / side, y * (2.0 / 3.0) / side


def holding(q: Column, r: Column) -> tuple[Column, Column]:
    """Axial coordinates of the cell that holds a position."""
    t = -q - r
    rq, rr, rt = (F.floor(v + 0.5) for v in (q, r, t))
    dq, dr, dt = F.abs(rq - q), F.abs(rr - r), F.abs(rt - t)
    # The coordinate that moved most when rounded is rebuilt from the other two.
    worst_q = (dq > dr) & (dq > dt)
    worst_r = ~worst_q & (dr > dt)
    return F.when(worst_q, -rr - rt).otherwise(rq), F.when(worst_r, -rq - rt).otherwise(rr)


def axial(lat: Column, lng: Column, resolution: int) -> tuple[Column, Column]:
    """Axial coordinates (q, r) of the cell that holds a point."""
    return holding(*planar(lat, lng, resolution))


def cell_at(q: Column, r: Column, resolution: int) -> Column:
    """Id of the cell that holds a position."""
    return F.concat_ws(":", F.lit(str(resolution)), *holding(q, r))


def cell(lat: Column, lng: Column, resolution: int) -> Column:
    return cell_at(*planar(lat, lng, resolution), resolution)


def edge_crossings(q0: Column, r0: Column, q1: Column, r1: Column) -> Column:
    """Where a straight line may leave a cell, as shares of its length in (0, 1), unordered.

    All edges of the grid lie on lines where q - r, r - t or t - q is whole (t = -q - r).
    """
    def whole_between(a: Column, b: Column) -> Column:
        first, last = F.floor(F.least(a, b)) + 1, F.ceil(F.greatest(a, b)) - 1
        steps = F.when(first <= last, F.sequence(first, last, F.lit(1).cast("long"))).otherwise(F.array().cast("array<long>"))
        return F.transform(steps, lambda k: (k - a) / (b - a))

    axes = [(q0 - r0, q1 - r1), (q0 + 2 * r0, q1 + 2 * r1), (-2 * q0 - r0, -2 * q1 - r1)]
    return F.concat(*[whole_between(a, b) for a, b in axes])


def _part(cell_id: Column, position: int) -> Column:
    return F.split_part(cell_id, F.lit(":"), F.lit(position)).cast("long")


def _to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    lat = F.degrees(F.asin(y * (_COS_PARALLEL / EARTH_RADIUS_M)))
    return lat, F.degrees(x / (EARTH_RADIUS_M * _COS_PARALLEL))


def _centre_m(cell_id: Column, resolution: int) -> tuple[Column, Column]:
    side = side_m(resolution)
    q, r = _part(cell_id, 2), _part(cell_id, 3)
    return (q + r / 2.0) * (_SQRT3 * side), r * (1.5 * side)


def centre(cell_id: Column, resolution: int) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre."""
    return _to_degrees(*_centre_m(cell_id, resolution))


def boundary(cell_id: Column, resolution: int) -> Column:
    """Closed ring of seven (lat, lng) points around a cell."""
    side = side_m(resolution)
    x, y = _centre_m(cell_id, resolution)
    ring = []
    for corner in (0, 1, 2, 3, 4, 5, 0):
        angle = math.radians(60 * corner + 30)
        lat, lng = _to_degrees(x + side * math.cos(angle), y + side * math.sin(angle))
        ring.append(F.struct(lat.alias("lat"), lng.alias("lng")))
    return F.array(*ring)
