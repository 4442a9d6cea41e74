"""Polygons to cells, buffers, and the exact point-in-polygon join.

Polygons are exploded to edges, and every step below works on edges or lattice rows,
so a zone with a very long outline spreads over many tasks and no row ever carries a
whole outline next to a candidate cell.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions import geo, grid, ports
from fairlead.operators import joins
from fairlead.schemas import AOI_METHODS


def load_wkt(df: DataFrame, wkt_field: str = "WKT_geom", drop_wkt: bool = True) -> DataFrame:
    """Add ``geom`` (rings of lon/lat points) parsed from text; bad text raises."""
    out = df.withColumn("geom", geo.parse_rings(wkt_field))
    return out.drop(wkt_field) if drop_wkt else out


def select_method(aoi: DataFrame, method: str, column: str = "method") -> DataFrame:
    """Areas of one of the four published delineations."""
    if method not in AOI_METHODS:
        raise ValueError(f"unknown method {method!r}, choose one of {list(AOI_METHODS)}")
    return aoi.filter(F.col(column) == method)


AREA = "_area"


def identified(areas: DataFrame) -> DataFrame:
    """Areas with an id of their own (``_area``), made of all their columns, so that areas of one
    name never mix. Rows that repeat each other are numbered; the id does not depend on order."""
    same = F.xxhash64(*areas.columns)
    number = F.row_number().over(Window.partitionBy("_same").orderBy("_same"))
    return areas.withColumn("_same", same).withColumn(AREA, F.xxhash64("_same", number)).drop("_same")


def polygon_edges(areas: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    """One row per polygon edge: keys, x1, y1, x2, y2 in degrees."""
    # Outer generators: the plain ones would parse once more to drop empty outlines.
    rings = areas.select(*keys, F.explode_outer(geom).alias("_ring"))
    edges = rings.select(*keys, F.inline_outer(geo.ring_edges(F.col("_ring"))))
    return spread(edges.filter(F.col("x1").isNotNull()), "x1", "y1", "x2", "y2")


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as generated values, so a later filter on them reuses the value
    instead of repeating its whole expression (generators stop filter pushdown)."""
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows out evenly before they expand: a few bytes of outline can become millions
    of cells, which size-based partitioning would leave in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def fill_runs(edges: DataFrame, keys: Sequence[str], resolution: int) -> DataFrame:
    """(keys, _r, _first, _last): runs of cells whose centre lies inside the polygon (all parts,
    holes left out), by lattice row.

    An outline that crosses 180 degrees runs on beyond it (170, 190, ...); its cells wrap around.

    Scan-line fill: each edge meets the lattice rows it spans, crossings of one row
    are paired off in order of longitude, and each pair spans a run of cells.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.filter(F.col("y1") != F.col("y2")).select(
        *keys, "x1", "y1", "x2", "y2",
        F.explode(
            F.sequence(
                F.floor(grid.row_of_latitude(low, resolution)), F.ceil(grid.row_of_latitude(high, resolution))
            )
        ).alias("_r"),
    )
    met = settle(rows, _lat=grid.centre_latitude_of_row(F.col("_r"), resolution)).filter((F.col("_lat") >= low) & (F.col("_lat") < high))
    share = (F.col("_lat") - F.col("y1")) / (F.col("y2") - F.col("y1"))
    crossings = met.select(*keys, "_r", (F.col("x1") + share * (F.col("x2") - F.col("x1"))).alias("_x"))
    w = Window.partitionBy(*keys, "_r").orderBy("_x")
    spans = crossings.withColumns({"_n": F.row_number().over(w), "_to": F.lead("_x").over(w)}).filter("_n % 2 = 1")
    spans = around_the_line(spans, F.col("_x"), F.col("_to"), resolution)
    first = F.ceil(grid.column_of_longitude(F.col("_west"), F.col("_r"), resolution))
    last = F.ceil(grid.column_of_longitude(F.col("_east"), F.col("_r"), resolution)) - F.lit(1)
    runs = settle(spans, _first=first.cast("bigint"), _last=last.cast("bigint")).filter("_first <= _last")
    return runs.select(*keys, "_r", "_first", "_last")


def around_the_line(df: DataFrame, west: Column, east: Column, resolution: int) -> DataFrame:
    """Intervals of longitude that may reach beyond 180 degrees as intervals within the lattice, in
    ``_west`` and ``_east``: what lies beyond one end comes in again at the other. The lattice ends half a
    cell beyond 180 degrees, where the last cells that hold points have their centres."""
    end = 180.0 + grid.half_spacing(resolution)
    pieces = F.array(
        *[
            F.struct(F.greatest(west + F.lit(turn), F.lit(-end)).alias("_west"), F.least(east + F.lit(turn), F.lit(end)).alias("_east"))
            for turn in (0.0, -360.0, 360.0)
        ]
    )
    return df.select("*", F.inline(F.filter(pieces, lambda p: p["_west"] <= p["_east"])))


def merged_runs(runs: DataFrame) -> DataFrame:
    """Runs of a lattice row that overlap or touch, as one."""
    along = Window.partitionBy("_r").orderBy("_first", "_last")
    reached = F.max("_last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("_new", F.coalesce(F.col("_first") > reached + 1, F.lit(True)).cast("int"))
    numbered = marked.withColumn("_part", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("_r", "_part").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last")).drop("_part")


def run_cells(runs: DataFrame, keys: Sequence[str], resolution: int, cell: str) -> DataFrame:
    """One row per cell of the runs; cells that do not fit the lattice are left out."""
    runs = spread(runs.select(*keys, "_r", "_first", "_last"), "_r", "_first")
    cells = runs.select(*keys, "_r", F.explode(F.sequence("_first", "_last")).alias("_q")).select(
        *keys, grid.pack(F.col("_q"), F.col("_r"), resolution).alias(cell)
    )
    return cells.filter(F.col(cell).isNotNull()) if resolution == 15 else cells


def fill(edges: DataFrame, keys: Sequence[str], resolution: int, cell: str = "cell") -> DataFrame:
    """Cells whose centre lies inside the polygon."""
    return run_cells(fill_runs(edges, keys, resolution), keys, resolution, cell)


def area_cells(areas: DataFrame, keys: Sequence[str], resolution: int, cell: str = "h3_ids_int") -> DataFrame:
    """Distinct (keys, cell) rows of a table with a parsed ``geom`` column. Each area is filled by
    itself; areas that share their keys add up."""
    known = identified(areas)
    filled = fill(polygon_edges(known, [AREA]), [AREA], resolution, cell)
    return known.select(AREA, *keys).join(filled, AREA).select(*keys, cell).distinct()


def zone_runs(areas: DataFrame, resolution: int) -> DataFrame:
    """(_r, _first, _last): the union of all given areas as runs of cells by lattice row. A zone of a
    hundred million cells has some ten thousand runs."""
    return merged_runs(fill_runs(polygon_edges(identified(areas), [AREA]), [AREA], resolution))


def zone_cells(areas: DataFrame, resolution: int, cell: str = "cell") -> DataFrame:
    """Distinct cells of the union of all given areas."""
    return run_cells(zone_runs(areas, resolution), [], resolution, cell)


def port_cells(
    aoi: DataFrame, keys: Sequence[str], resolution: int, method: str = "Manual", cell: str = "h3_ids_int"
) -> DataFrame:
    """Cells of the ports; the hand-drawn set loses ports too small for the cells."""
    kept = ports.without_small_ports(aoi, resolution) if method == "Manual" else aoi
    return area_cells(kept, keys, resolution, cell)


def _edge_samples(edges: DataFrame, keys: Sequence[str], step_m: Column) -> DataFrame:
    """Points along each edge, at most ``step_m`` apart, ends included."""
    dx = (F.col("x2") - F.col("x1")) * F.cos(F.radians(F.least(F.abs("y1"), F.abs("y2"))))
    dy = F.col("y2") - F.col("y1")
    length = F.radians(F.sqrt(dx * dx + dy * dy)) * F.lit(grid.EARTH_M)
    count = F.greatest(F.lit(1), F.ceil(length / step_m).cast("int"))
    cut = settle(edges, _count=count).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_count"))))
    t = F.col("_i") / F.col("_count").cast("double")
    points = settle(
        cut,
        _x=F.col("x1") + t * (F.col("x2") - F.col("x1")),
        _y=F.col("y1") + t * (F.col("y2") - F.col("y1")),
    )
    return points.select(*keys, "x1", "y1", "x2", "y2", "_x", "_y")


def cells_near_edges(edges: DataFrame, keys: Sequence[str], resolution: int, reach_m: float, cell: str) -> DataFrame:
    """(keys, edge, cell) rows, with repeats, covering every cell whose centre may lie
    within ``reach_m`` of the edge (a superset; callers test exactly)."""
    spacing = grid.SQRT3 * grid.edge_length(resolution)
    widest = F.greatest(F.abs("y1"), F.abs("y2"))
    shrink = F.cos(F.radians(F.least(F.lit(grid.MAX_LATITUDE), widest + F.lit(math.degrees(reach_m / grid.EARTH_M)))))
    ground = F.lit(spacing) * shrink
    step = F.greatest(F.lit(reach_m / 2.0), ground / F.lit(2.0))
    # A step on the lattice covers at least sqrt(3)/2 of the spacing.
    depth = F.ceil((F.lit(reach_m) + step) / (ground * F.lit(math.sqrt(3.0) / 2.0))).cast("int") + F.lit(1)
    edge = [*keys, "x1", "y1", "x2", "y2"]
    seeds = _edge_samples(edges, keys, step).select(
        *edge, grid.cell_at("_y", "_x", resolution).alias("_seed"), depth.alias("_k")
    ).distinct()
    columns_of_ring = seeds.select("*", F.explode(F.sequence(-F.col("_k"), F.col("_k"))).alias("_dq"))
    low = F.greatest(-F.col("_k"), -F.col("_dq") - F.col("_k"))
    high = F.least(F.col("_k"), -F.col("_dq") + F.col("_k"))
    around = columns_of_ring.select("*", F.explode(F.sequence(low, high)).alias("_dr"))
    moved = F.col("_seed") + F.col("_dq").cast("bigint") * F.lit(1 << grid.AXIS_BITS) + F.col("_dr").cast("bigint")
    return around.select(*edge, moved.alias(cell))


# From here on cells are small enough to measure on the tangent plane of their centre.
PLANE_RESOLUTION = 5


def with_distance(pairs: DataFrame, cell: str, resolution: int) -> DataFrame:
    """Metres from each cell's centre to the edge beside it, as ``_metres``."""
    df = settle(pairs, _lat=grid.centre_latitude(cell, resolution), _lon=grid.centre_longitude(cell, resolution))
    df = settle(df, **geo.local_plane(F.col("_lat"), F.col("_lon"), *map(F.col, ("x1", "y1", "x2", "y2"))))
    df = settle(df, _t=geo.nearest_share(F.col("_ax"), F.col("_ay"), F.col("_dx"), F.col("_dy")))
    metres = F.hypot(F.col("_ax") + F.col("_t") * F.col("_dx"), F.col("_ay") + F.col("_t") * F.col("_dy"))
    return settle(df, _metres=metres)


def near_runs(edges: DataFrame, resolution: int, reach_m: float) -> DataFrame:
    """(_r, _first, _last): per edge and lattice row, the cells whose centre is within ``reach_m`` of the edge.

    On the tangent planes of a row's centres, which differ by a shift only, the places
    near an edge are convex, so they meet the row in one interval: the hull of what the
    discs around both ends and the strip along the edge cut out of it.
    """
    pad = F.lit(math.degrees(reach_m / geo.SPHERE_M))
    low, high = F.least("y1", "y2") - pad, F.greatest("y1", "y2") + pad
    top = F.ceil(grid.row_of_latitude(high, resolution))
    rows = edges.select(
        "x1", "y1", "x2", "y2", F.explode(F.sequence(F.floor(grid.row_of_latitude(low, resolution)), top)).alias("_r")
    )
    rows = settle(rows, _lat=grid.centre_latitude_of_row(F.col("_r"), resolution))
    # metres east of the edge's start, on the row
    rows = settle(rows, **geo.local_plane(F.col("_lat"), F.col("x1"), *map(F.col, ("x1", "y1", "x2", "y2"))))
    ay, dx, dy, reach = F.col("_ay"), F.col("_dx"), F.col("_dy"), F.lit(reach_m)
    half_a, half_b = (F.lit(reach_m**2) - h * h for h in (ay, ay + dy))
    rows = settle(
        rows,
        _a=F.when(half_a >= 0, F.sqrt(half_a)),
        _b=F.when(half_b >= 0, F.sqrt(half_b)),
        _length2=dx * dx + dy * dy,
    )
    # The strip: within reach of the line, and beside the edge rather than beyond its ends.
    wide = reach * F.sqrt("_length2")
    lines = F.when(dy != 0, F.array_sort(F.array((-dx * ay - wide) / dy, (-dx * ay + wide) / dy))).when(
        F.abs(ay) <= reach, F.array(F.lit(float("-inf")), F.lit(float("inf")))
    )
    beside = F.when(dx != 0, F.array_sort(F.array(ay * dy / dx, (F.col("_length2") + ay * dy) / dx))).when(
        (-ay * dy).between(F.lit(0.0), F.col("_length2")), F.array(F.lit(float("-inf")), F.lit(float("inf")))
    )
    rows = settle(rows, _lines=lines, _beside=beside)
    rows = settle(rows, _from=F.greatest(F.get("_lines", 0), F.get("_beside", 0)), _to=F.least(F.get("_lines", 1), F.get("_beside", 1)))
    strip = F.col("_lines").isNotNull() & F.col("_beside").isNotNull() & (F.col("_length2") > 0) & (F.col("_from") <= F.col("_to"))
    rows = settle(
        rows,
        _west=F.least(-F.col("_a"), dx - F.col("_b"), F.when(strip, F.col("_from"))),
        _east=F.greatest(F.col("_a"), dx + F.col("_b"), F.when(strip, F.col("_to"))),
    ).filter("_west is not null")

    def longitude(metres: str) -> Column:
        return F.col("x1") + F.degrees(F.col(metres) / (F.lit(geo.SPHERE_M) * F.cos(F.radians("_lat"))))

    rows = settle(rows, _from_lon=longitude("_west"), _to_lon=longitude("_east")).drop("_west", "_east")
    rows = around_the_line(rows, F.col("_from_lon"), F.col("_to_lon"), resolution)

    def column(degrees: str) -> Column:
        return grid.column_of_longitude(F.col(degrees), F.col("_r"), resolution)

    rows = settle(rows, _first=F.ceil(column("_west")).cast("bigint"), _last=F.floor(column("_east")).cast("bigint"))
    return rows.filter("_first <= _last").select("_r", "_first", "_last")


def buffer_runs(areas: DataFrame, radius_m: float = 10000.0, resolution: int = 8) -> DataFrame:
    """(_r, _first, _last): runs of the cells whose centre is inside an area or within ``radius_m`` of it."""
    edges = polygon_edges(identified(areas), [AREA])
    inside = fill_runs(edges, [AREA], resolution).select("_r", "_first", "_last")
    return merged_runs(inside.unionByName(near_runs(edges, resolution, float(radius_m))))


def buffer_cells(
    areas: DataFrame, radius_m: float = 10000.0, resolution: int = 8, cell: str = "boundary_h3"
) -> DataFrame:
    """Distinct cells whose centre is inside an area or within ``radius_m`` of it."""
    return run_cells(buffer_runs(areas, radius_m, resolution), [], resolution, cell)


#: A block is a rhombus of this many rows and columns of cells, as a power of two.
BLOCK_BITS = 5


def block_of(q: Column, r: Column) -> Column:
    """The block that holds a cell: a negative number, so that blocks and cells can stand in one column."""
    side = F.lit(1 << grid.AXIS_BITS)
    column, row = (F.shiftright(x.cast("bigint"), BLOCK_BITS) + F.lit(grid.OFFSET) for x in (q, r))
    return -(column * side + row) - F.lit(1)


def cover(edges: DataFrame, keys: Sequence[str], resolution: int) -> DataFrame:
    """Cells and blocks that cover a polygon: coarse inside, fine along the outline.

    A block of cells that lie inside, none of them touched by an edge, is one row: a place in it is inside.
    All other cells have a row each: whether the centre is inside, and the edges that may cross the cell. So
    the rows follow the length of the outline, and the area only by its blocks.
    """
    runs = spread(fill_runs(edges, keys, resolution), "_r", "_first")
    touched = cells_near_edges(edges, keys, resolution, grid.edge_length(resolution), "cell")
    touched = touched.distinct()
    if resolution >= PLANE_RESOLUTION:
        reach = F.lit(1.1 * grid.edge_length(resolution)) * F.cos(F.radians("_lat"))
        touched = with_distance(touched, "cell", resolution).filter(F.col("_metres") <= reach)
    side = 1 << BLOCK_BITS
    pieces = runs.select("*", F.explode(F.sequence(F.shiftright("_first", BLOCK_BITS), F.shiftright("_last", BLOCK_BITS))).alias("_at"))
    pieces = pieces.select(
        *keys,
        "_r",
        F.greatest(F.col("_first"), F.col("_at") * side).alias("_from"),
        F.least(F.col("_last"), F.col("_at") * side + F.lit(side - 1)).alias("_to"),
        block_of(F.col("_at") * side, F.col("_r")).alias("_block"),
    )
    broken = touched.select(*keys, block_of(grid.cell_q("cell"), grid.cell_r("cell")).alias("_block")).distinct()
    full = pieces.groupBy(*keys, "_block").agg(F.sum(F.col("_to") - F.col("_from") + 1).alias("_n")).filter(F.col("_n") == side * side)
    full = full.select(*keys, "_block").join(broken, [*keys, "_block"], "left_anti")
    rest = pieces.join(full, [*keys, "_block"], "left_anti")
    inside = rest.select(*keys, "_r", F.explode(F.sequence("_from", "_to")).alias("_q")).select(
        *keys, grid.pack(F.col("_q"), F.col("_r"), resolution).alias("cell"), F.lit(True).alias("_inside")
    ).filter(F.col("cell").isNotNull())
    both = inside.withColumn("_edge", F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>")).unionByName(
        touched.select(*keys, "cell", F.lit(False).alias("_inside"), F.struct("x1", "y1", "x2", "y2").alias("_edge"))
    )
    fine = both.groupBy(*keys, "cell").agg(
        F.max("_inside").alias("centre_inside"),
        F.collect_list("_edge").alias("local_edges"),
    ).withColumns(
        {"centre_lon": grid.centre_longitude("cell", resolution), "centre_lat": grid.centre_latitude("cell", resolution)}
    )
    nothing = F.lit(None).cast("double")
    coarse = full.select(
        *keys,
        F.col("_block").alias("cell"),
        F.lit(True).alias("centre_inside"),
        F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("local_edges"),
        nothing.alias("centre_lon"),
        nothing.alias("centre_lat"),
    )
    return fine.unionByName(coarse)


def points_in_areas(
    points: DataFrame,
    areas: DataFrame,
    resolution: int = 8,
    lon: str = "longitude",
    lat: str = "latitude",
) -> DataFrame:
    """Exact spatial join: every (area, point) pair where the point is inside or on
    the outline, with all columns of both but ``geom``.

    An equi join on the cell, or on the block of cells well inside, finds candidates. The exact answer is local: starting
    from whether the cell centre is inside, each nearby edge between the point and
    the centre flips it. A point on an edge counts as inside. Every area is told apart by an
    id of its own, so areas that share their columns or overlap each give their pairs.
    """
    carried = [c for c in areas.columns if c != "geom"]
    known = identified(areas)
    covered = cover(polygon_edges(known, [AREA]), [AREA], resolution)
    # A place is looked for in its cell and in its block; of one area only one of them can be there.
    at = settle(points, _at=grid.cell_at(lat, lon, resolution))
    at = at.withColumn("_cell", F.explode(F.array("_at", block_of(grid.cell_q("_at"), grid.cell_r("_at"))))).drop("_at")
    found = at.join(
        joins.sized(covered.withColumnRenamed("cell", "_cell")), "_cell", "inner"
    )
    px, py = F.col(lon), F.col(lat)
    cx, cy = F.col("centre_lon"), F.col("centre_lat")
    # One walk over the edges: 0 outside, 1 inside, 2 for good once the point is on one.
    walked = F.aggregate(
        "local_edges",
        F.col("centre_inside").cast("int"),
        lambda n, e: F.when(
            (n == 2) | geo.on_segment(px, py, e["x1"], e["y1"], e["x2"], e["y2"]), F.lit(2)
        ).otherwise(F.when(geo.crosses(px, py, cx, cy, e), F.lit(1) - n).otherwise(n)),
    )
    # Most pairs meet in cells that no edge crosses: there is nothing to walk.
    state = F.when(F.size("local_edges") == 0, F.col("centre_inside").cast("int")).otherwise(walked)
    inside = settle(found, _state=state).filter("_state > 0").select(AREA, *points.columns)
    # What an area carries is fetched for the pairs found, not repeated in each of its cells. The pairs, points times
    # the areas that overlap there, do not travel again for it where the areas are few enough to be sent.
    named = joins.sized(known.select(AREA, *[F.col(c).alias(f"_of_{c}") for c in carried]))
    return inside.join(named, AREA).select(*[F.col(f"_of_{c}").alias(c) for c in carried], *points.columns)
