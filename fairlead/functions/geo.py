"""Geometry as columns: WKT in and out, great-circle distance, edge arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius used for great-circle distances, in metres.
SPHERE_M = 6371007.180918475


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres; null when a coordinate is out of range."""
    a1, o1, a2, o2 = map(_col, (lat1, lon1, lat2, lon2))
    p1, p2 = F.radians(a1), F.radians(a2)
    h = (
        F.pow(F.sin((p2 - p1) / F.lit(2.0)), F.lit(2.0))
        + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(o2) - F.radians(o1)) / F.lit(2.0)), F.lit(2.0))
    )
    metres = F.lit(2.0 * SPHERE_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
    in_range = a1.between(-90, 90) & a2.between(-90, 90) & o1.between(-180, 180) & o2.between(-180, 180)
    return F.when(in_range, metres)


def _number(c: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", c.cast("double"))


def point_wkt(lat, lon, digits: int = 9) -> Column:
    return F.concat(F.lit("POINT ("), _number(_col(lon), digits), F.lit(" "), _number(_col(lat), digits), F.lit(")"))


def tri_line_wkt(lat1, lon1, lat2, lon2, lat3, lon3, digits: int = 9) -> Column:
    def pair(lat, lon):
        return F.concat(_number(_col(lon), digits), F.lit(" "), _number(_col(lat), digits))
    return F.concat(
        F.lit("LINESTRING ("), pair(lat1, lon1), F.lit(", "), pair(lat2, lon2), F.lit(","), pair(lat3, lon3), F.lit(")")
    )


def spread_box_wkt(lat, lon, lat_sd, lon_sd, factor: float = 1.0, digits: int = 9) -> Column:
    """Closed box of ``factor`` standard deviations around a mean position."""
    left = _number(_col(lon) - F.lit(float(factor)) * _col(lon_sd), digits)
    right = _number(_col(lon) + F.lit(float(factor)) * _col(lon_sd), digits)
    low = _number(_col(lat) - F.lit(float(factor)) * _col(lat_sd), digits)
    high = _number(_col(lat) + F.lit(float(factor)) * _col(lat_sd), digits)
    corners = [(left, low), (left, high), (right, high), (right, low), (left, low)]
    return F.concat(
        F.lit("POLYGON(("), F.concat_ws(", ", *[F.concat_ws(" ", x, y) for x, y in corners]), F.lit("))")
    )


POLYGON_TEXT = r"(?i)^\s*(MULTI)?POLYGON\s*\(.*\)\s*$"


def parse_rings(wkt: Column | str) -> Column:
    """array<array<struct<lon,lat>>> of every ring of a POLYGON or MULTIPOLYGON.

    Null text stays null; any other geometry type or malformed text raises.
    """
    text = _col(wkt)
    body = F.regexp_replace(F.regexp_replace(text, r"^[^(]*[(\s]+", ""), r"[)\s]+$", "")
    rings = F.split(body, r"\)[\s,()]*\(")

    def point(pair: Column) -> Column:
        axes = F.split(F.trim(pair), r"\s+")
        return F.struct(
            F.element_at(axes, 1).cast("double").alias("lon"), F.element_at(axes, 2).cast("double").alias("lat")
        )

    parsed = F.transform(rings, lambda ring: F.transform(F.split(ring, ","), point))
    return (
        F.when(text.isNull(), F.lit(None))
        .when(text.rlike(POLYGON_TEXT), parsed)
        .otherwise(F.raise_error(F.concat(F.lit("not a polygon text: "), text)))
    )


def ring_edges(ring: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> of consecutive vertices of one closed ring."""
    count = F.size(ring)
    pairs = F.arrays_zip(
        F.slice(ring, F.lit(1), count - 1).alias("a"), F.slice(ring, F.lit(2), count - 1).alias("b")
    )
    return F.transform(
        pairs,
        lambda p: F.struct(
            p["a"]["lon"].alias("x1"), p["a"]["lat"].alias("y1"), p["b"]["lon"].alias("x2"), p["b"]["lat"].alias("y2")
        ),
    )


def local_plane(lat: Column, lon: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> dict[str, Column]:
    """Edge start and direction in metres on the tangent plane of a point."""
    north = F.lit(SPHERE_M)
    east = north * F.cos(F.radians(lat))
    return {
        "_ax": F.radians(x1 - lon) * east,
        "_ay": F.radians(y1 - lat) * north,
        "_dx": F.radians(x2 - x1) * east,
        "_dy": F.radians(y2 - y1) * north,
    }


def nearest_share(ax: Column, ay: Column, dx: Column, dy: Column) -> Column:
    """Position (0..1) along the edge a + t*d of the point nearest to the origin."""
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, -(ax * dx + ay * dy) / length2).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))


def side_of_line(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Cross product sign source: > 0 when the point is left of a->b."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


# A point this close to an outline (in degrees) lies on it: above the rounding error of
# the arithmetic, far below a millimetre on the ground.
ON_EDGE_DEGREES = 1e-12


def on_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    slack = F.lit(ON_EDGE_DEGREES)
    return (
        (F.abs(side_of_line(px, py, ax, ay, bx, by)) <= slack * (F.abs(bx - ax) + F.abs(by - ay)))
        & px.between(F.least(ax, bx) - slack, F.greatest(ax, bx) + slack)
        & py.between(F.least(ay, by) - slack, F.greatest(ay, by) + slack)
    )


def crosses(px: Column, py: Column, cx: Column, cy: Column, edge: Column) -> Column:
    """Whether the segment p-c crosses ``edge``; vertices belong to one side only."""
    ax, ay, bx, by = edge["x1"], edge["y1"], edge["x2"], edge["y2"]
    split_edge = (side_of_line(ax, ay, px, py, cx, cy) >= 0) != (side_of_line(bx, by, px, py, cx, cy) >= 0)
    split_path = (side_of_line(px, py, ax, ay, bx, by) >= 0) != (side_of_line(cx, cy, ax, ay, bx, by) >= 0)
    return split_edge & split_path
