"""Hexagonal grid in column arithmetic.

A cell is a BIGINT laid out as ``2^62 | resolution << 52 | (q + 2^25) << 26 | (r + 2^25)``;
bit 62 marks it as one of this lattice, and what reads positions from a cell raises on any other,
where (q, r) are axial coordinates of a pointy-top hexagon lattice drawn on the
Web Mercator plane. Everything below is built-in Column math, so it stays inside
whole-stage codegen and can be pushed through joins and filters like any other
expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6378137.0
SQRT3 = math.sqrt(3.0)
# Hexagon edge at resolution 0 in metres, and the shrink per level.
EDGE_0_M = 1107712.591
APERTURE = math.sqrt(7.0)
# Web Mercator ends at this latitude; points beyond have no cell.
MAX_LATITUDE = 85.0511287798066

AXIS_BITS = 26
RES_SHIFT = 2 * AXIS_BITS
OFFSET = 1 << (AXIS_BITS - 1)
AXIS_MASK = (1 << AXIS_BITS) - 1
# Bits 56 and up of every cell of this lattice.
MARK_SHIFT = 56
MARK = 64


def check_resolution(resolution: int) -> int:
    if isinstance(resolution, bool) or not isinstance(resolution, int) or not 0 <= resolution <= 15:
        raise ValueError(f"resolution must be an integer from 0 to 15, got {resolution!r}")
    return resolution


def edge_length(resolution: int) -> float:
    """Hexagon edge (= centre-to-corner distance) in Mercator metres."""
    return EDGE_0_M / APERTURE ** check_resolution(resolution)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mercator_x(longitude: Column | str) -> Column:
    return F.lit(EARTH_M) * F.radians(_col(longitude))


def mercator_y(latitude: Column | str) -> Column:
    clamped = F.greatest(F.lit(-MAX_LATITUDE), F.least(F.lit(MAX_LATITUDE), _col(latitude)))
    return F.lit(EARTH_M) * F.asinh(F.tan(F.radians(clamped)))


def pack(q: Column, r: Column, resolution: int) -> Column:
    """The cell at (q, r); null where an axis does not fit (resolution 15 far from the origin)."""
    head = F.lit(MARK << MARK_SHIFT | check_resolution(resolution) << RES_SHIFT).cast("bigint")
    cell = (
        head
        + (q.cast("bigint") + F.lit(OFFSET)) * F.lit(1 << AXIS_BITS)
        + (r.cast("bigint") + F.lit(OFFSET))
    )
    if resolution < 15:
        return cell
    return F.when(q.between(-OFFSET, OFFSET - 1) & r.between(-OFFSET, OFFSET - 1), cell)


def is_own(cell: Column | str) -> Column:
    """Whether a cell id belongs to this lattice."""
    return F.shiftright(_col(cell), MARK_SHIFT) == F.lit(MARK)


def own(cell: Column | str) -> Column:
    """The cell itself; raises on an id of another grid, whose bits mean something else."""
    c = _col(cell)
    foreign = F.raise_error(F.concat(F.lit("cell id of another grid: "), c.cast("string"))).cast("bigint")
    return F.when(c.isNull() | is_own(c), c).otherwise(foreign)


def cell_q(cell: Column | str) -> Column:
    return F.shiftright(_col(cell), AXIS_BITS).bitwiseAND(F.lit(AXIS_MASK).cast("bigint")) - F.lit(OFFSET)


def cell_r(cell: Column | str) -> Column:
    return _col(cell).bitwiseAND(F.lit(AXIS_MASK).cast("bigint")) - F.lit(OFFSET)


def resolution_of(cell: Column | str) -> Column:
    return F.shiftright(_col(cell), RES_SHIFT).bitwiseAND(F.lit(15).cast("bigint")).cast("int")


def cell_at(latitude: Column | str, longitude: Column | str, resolution: int) -> Column:
    """Cell holding a point; null when a coordinate is null, NaN or out of range.

    Rounding to the nearest hexagon with floors along two lattice diagonals; it repeats
    its inputs far less than rounding three cube axes, which keeps generated code small.
    """
    size = edge_length(resolution)
    x = mercator_x(longitude) / F.lit(SQRT3 * size)
    t = F.lit(1.0) - mercator_y(latitude) / F.lit(size)
    diagonal = F.floor(t + x)
    q = F.floor((diagonal + (F.lit(2.0) * x + F.lit(1.0))) / F.lit(3.0))
    r = -F.floor((diagonal + (t - x)) / F.lit(3.0))
    # NaN compares as larger than any number, so the range test refuses it too.
    valid = (F.abs(_col(latitude)) <= F.lit(MAX_LATITUDE)) & (F.abs(_col(longitude)) <= F.lit(180.0))
    return F.when(valid, pack(q, r, resolution))


def centre_latitude_of_row(r: Column, resolution: int) -> Column:
    """Latitude shared by all centres of lattice row ``r``."""
    y = F.lit(1.5 * edge_length(resolution)) * r
    return F.degrees(F.atan(F.sinh(y / F.lit(EARTH_M))))


def column_of_longitude(longitude: Column, r: Column, resolution: int) -> Column:
    """Fractional ``q`` of a longitude on lattice row ``r``."""
    return mercator_x(longitude) / F.lit(SQRT3 * edge_length(resolution)) - r / F.lit(2.0)


def row_of_latitude(latitude: Column, resolution: int) -> Column:
    """Fractional ``r`` of a latitude."""
    return mercator_y(latitude) / F.lit(1.5 * edge_length(resolution))


def _edge_of(cell: Column | str) -> Column:
    """Edge length by the cell's own resolution, for columns of mixed resolution."""
    sizes = F.array(*[F.lit(edge_length(k)) for k in range(16)])
    return F.element_at(sizes, resolution_of(cell) + F.lit(1))


def _edge(cell: Column | str, resolution: int | None) -> Column:
    return _edge_of(cell) if resolution is None else F.lit(edge_length(resolution))


def centre_latitude(cell: Column | str, resolution: int | None = None) -> Column:
    cell = own(cell)
    y = F.lit(1.5) * _edge(cell, resolution) * cell_r(cell)
    return F.degrees(F.atan(F.sinh(y / F.lit(EARTH_M))))


def centre_longitude(cell: Column | str, resolution: int | None = None) -> Column:
    cell = own(cell)
    x = F.lit(SQRT3) * _edge(cell, resolution) * (cell_q(cell) + cell_r(cell) / F.lit(2.0))
    return F.degrees(x / F.lit(EARTH_M))


def centre(cell: Column | str, resolution: int | None = None) -> Column:
    """struct(lat, lon) of a cell centre; pass ``resolution`` when it is known."""
    return F.struct(
        centre_latitude(cell, resolution).alias("lat"), centre_longitude(cell, resolution).alias("lon")
    )


def same_resolution(a: Column | str, b: Column | str) -> Column:
    return resolution_of(a) == resolution_of(b)


def _steps(a: Column | str, b: Column | str) -> Column:
    dq, dr = cell_q(a) - cell_q(b), cell_r(a) - cell_r(b)
    return F.greatest(F.abs(dq), F.abs(dr), F.abs(dq + dr)).cast("int")


def _wrapped(cell: Column, turn: float) -> Column:
    """The cell around a cell's centre moved once around the globe, on the lattice run on beyond 180 degrees.

    The lattice does not close at 180 degrees, so this is the nearest cell there, off by less than one edge."""
    size = _edge_of(cell)
    x = F.lit(SQRT3) * (cell_q(cell) + cell_r(cell) / F.lit(2.0)) * size + F.lit(EARTH_M * math.radians(turn))
    t = F.lit(1.0) - F.lit(1.5) * cell_r(cell)
    x = x / (F.lit(SQRT3) * size)
    diagonal = F.floor(t + x)
    q = F.floor((diagonal + (F.lit(2.0) * x + F.lit(1.0))) / F.lit(3.0))
    return q.cast("bigint") - cell_q(cell)


def _around(a: Column, b: Column) -> Column:
    """Steps the shorter way around the globe. A turn keeps the row, so only the column moves."""
    dr = cell_r(a) - cell_r(b)
    ways = [_steps(a, b)]
    for turn in (360.0, -360.0):
        dq = cell_q(a) - cell_q(b) - _wrapped(b, turn)
        ways.append(F.greatest(F.abs(dq), F.abs(dr), F.abs(dq + dr)).cast("int"))
    return F.least(*ways)


def grid_distance(a: Column | str, b: Column | str) -> Column:
    """Steps between two cells, the shorter way around the globe; null when their resolutions differ or one is
    null, an error on foreign ids."""
    a, b = _col(a), _col(b)
    return (
        F.when(is_own(a) & is_own(b), F.when(same_resolution(a, b), _around(a, b)))
        .when(a.isNotNull() & b.isNotNull(), F.raise_error(F.lit("cell id of another grid")).cast("int"))
    )


def point_grid_distance(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str, resolution: int
) -> Column:
    a, b = cell_at(lat1, lon1, resolution), cell_at(lat2, lon2, resolution)
    # Points less than half a turn apart in longitude take the direct way.
    far = F.abs(_col(lon1) - _col(lon2)) > F.lit(180.0)
    return F.when(far, _around(a, b)).otherwise(_steps(a, b))


def within_ring(cell: Column | str, origin: Column | str, k: int) -> Column:
    """Membership in the k-ring of ``origin`` without building the ring."""
    return F.coalesce(grid_distance(cell, origin) <= F.lit(k), F.lit(False))


def ring_offsets(k: int) -> list[tuple[int, int]]:
    """Axial offsets of the filled ring: 1 + 3k(k+1) of them."""
    if k < 0:
        raise ValueError("k must not be negative")
    return [
        (dq, dr)
        for dq in range(-k, k + 1)
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)
    ]


def ring(cell: Column | str, k: int | Column) -> Column:
    """array<bigint> of all cells within ``k`` steps; ``k`` may be a column.

    Beyond 180 degrees the ring goes on at the other end; as the lattice does not close there, a ring across the
    line may have a few cells less."""
    c = own(cell)
    depth = F.lit(k) if isinstance(k, int) else k
    def row(dq: Column) -> Column:
        low = F.greatest(-depth, -dq - depth)
        high = F.least(depth, -dq + depth)
        return F.transform(
            F.sequence(low, high), lambda dr: c + dq.cast("bigint") * F.lit(1 << AXIS_BITS) + dr.cast("bigint")
        )
    cells = F.flatten(F.transform(F.sequence(-depth, depth), row))
    spacing = F.degrees(F.lit(SQRT3 / EARTH_M) * _edge_of(c))

    def inside(x: Column) -> Column:
        """The cell itself, or beyond the last cells that hold points the one a turn away."""
        lon = centre_longitude(x)
        turned = F.when(lon > 0, _wrapped(x, -360.0)).otherwise(_wrapped(x, 360.0))
        return F.when(F.abs(lon) <= F.lit(180.0) + spacing / F.lit(2.0), x).otherwise(x + turned * F.lit(1 << AXIS_BITS))

    near = F.abs(centre_longitude(c)) + spacing * (depth + F.lit(1)) > F.lit(180.0)
    return F.when(near, F.array_distinct(F.transform(cells, inside))).otherwise(cells)


def half_spacing(resolution: int) -> float:
    """Degrees of longitude from a cell's centre to its side: points at 180 degrees may lie in a cell centred that far beyond."""
    return math.degrees(SQRT3 * edge_length(resolution) / 2.0 / EARTH_M)


def cell_to_text(cell: Column | str) -> Column:
    """Canonical text: lowercase hexadecimal, no padding."""
    return F.lower(F.hex(_col(cell)))


def text_to_cell(text: Column | str) -> Column:
    return F.conv(_col(text), 16, 10).cast("bigint")
