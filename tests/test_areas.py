"""Polygons: fill, buffer and exact membership against brute force."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fairlead.functions import geo, grid
from fairlead.operators import areas, joins, zones
from fairlead.schemas import HORMUZ_WKT

SHAPES = {
    "square": "POLYGON ((10.0 20.0, 10.3 20.0, 10.3 20.3, 10.0 20.3, 10.0 20.0))",
    "hole": "POLYGON ((10.5 20.0, 10.9 20.0, 10.9 20.4, 10.5 20.4, 10.5 20.0), (10.6 20.1, 10.8 20.1, 10.8 20.3, 10.6 20.3, 10.6 20.1))",
    "two": "MULTIPOLYGON (((10.0 21.0, 10.1 21.0, 10.1 21.1, 10.0 21.1, 10.0 21.0)),((10.2 21.0, 10.3 21.05, 10.2 21.2, 10.2 21.0)))",
    "star": "POLYGON((10.4 21.0,10.45 21.2,10.6 21.25,10.45 21.3,10.4 21.5,10.35 21.3,10.2 21.25,10.35 21.2,10.4 21.0))",
}


def table(spark, shapes=SHAPES):
    return areas.load_wkt(spark.createDataFrame(list(shapes.items()), "name string, wkt string"), "wkt")


def rings_of(text):
    body = text[text.index("(") :]
    rings, depth = [], ""
    for part in body.replace("(", " ( ").replace(")", " ) ").split(")"):
        numbers = part.split("(")[-1].strip(" ,")
        if numbers:
            rings.append([tuple(map(float, p.split())) for p in numbers.split(",")])
    return rings


def edges_of(text):
    return [(*a, *b) for ring in rings_of(text) for a, b in zip(ring, ring[1:])]


def inside(edges, x, y):
    odd = False
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
            odd = not odd
    return odd


def centres(spark, resolution):
    """All cells whose centre falls in a box around the shapes."""
    seed = spark.range(1).select(F.explode(grid.ring(grid.cell_at(F.lit(20.75), F.lit(10.45), resolution), 90)).alias("c"))
    return [tuple(r) for r in seed.select("c", grid.centre_latitude("c", resolution), grid.centre_longitude("c", resolution)).collect()]


def test_fill_equals_brute_force(spark):
    got = {(r.name, r.h3_ids_int) for r in areas.area_cells(table(spark), ["name"], 7).collect()}
    want = {(n, c) for c, lat, lon in centres(spark, 7) for n, w in SHAPES.items() if inside(edges_of(w), lon, lat)}
    assert got == want and len({n for n, _ in got}) == 4


@pytest.mark.parametrize("radius", [200.0, 6000.0])
def test_buffer_equals_brute_force(spark, radius):
    got = {r.boundary_h3 for r in areas.buffer_cells(table(spark), radius, 7).collect()}

    def near(edges, lat, lon):
        east = geo.SPHERE_M * math.cos(math.radians(lat))
        for x1, y1, x2, y2 in edges:
            ax, ay = math.radians(x1 - lon) * east, math.radians(y1 - lat) * geo.SPHERE_M
            dx, dy = math.radians(x2 - x1) * east, math.radians(y2 - y1) * geo.SPHERE_M
            t = max(0.0, min(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy)))
            if math.hypot(ax + t * dx, ay + t * dy) <= radius:
                return True
        return False

    want = {c for c, lat, lon in centres(spark, 7) for w in SHAPES.values() if inside(edges_of(w), lon, lat) or near(edges_of(w), lat, lon)}
    assert got == want


@pytest.mark.parametrize("resolution", [4, 6, 8, 9])
def test_points_in_areas_equals_brute_force(spark, resolution):
    rnd = random.Random(resolution)
    pts = [(i, rnd.uniform(9.9, 11.0), rnd.uniform(19.9, 21.6)) for i in range(3000)]
    pts += [(9000, 10.0, 20.1), (9001, 10.0, 20.0), (9002, 10.6, 20.2), (9003, 10.15, 20.3), (9004, 10.25, 21.025)]
    df = spark.createDataFrame(pts, "id long, longitude double, latitude double")
    got = {(r.name, r.id) for r in areas.points_in_areas(df, table(spark), resolution).collect()}
    want = {(n, i) for i, x, y in pts if i < 9000 for n, w in SHAPES.items() if inside(edges_of(w), x, y)}
    on_outline = {("square", 9000), ("square", 9001), ("hole", 9002), ("square", 9003), ("two", 9004)}
    assert got == want | on_outline


def test_zone_and_attributes(spark):
    strait = areas.load_wkt(spark.createDataFrame([(HORMUZ_WKT, "strait", 1)], "wkt string, name string, tag int"), "wkt")
    cells = areas.zone_cells(strait, 5)
    assert cells.count() == cells.distinct().count() > 100
    df = spark.createDataFrame([(55.5, 26.0), (50.0, 26.0)], "longitude double, latitude double")
    assert [tuple(r) for r in areas.points_in_areas(df, strait, 6).collect()] == [("strait", 1, 55.5, 26.0)]


@pytest.mark.parametrize("bad", ["POINT (1 2)", "POLYGON ((1 2, 3 4", "nonsense", "POLYGON ((a b, c d, a b))"])
def test_malformed_text_raises(spark, bad):
    with pytest.raises(PySparkException):
        table(spark, {"x": bad}).collect()


def test_missing_outline_gives_no_cells(spark):
    df = areas.load_wkt(spark.createDataFrame([("a", None), ("b", SHAPES["square"])], "name string, wkt string"), "wkt", drop_wkt=False)
    assert df.columns == ["name", "wkt", "geom"]
    assert {r.name for r in areas.area_cells(df, ["name"], 7).collect()} == {"b"}


def test_method_is_checked(spark):
    with pytest.raises(ValueError):
        areas.select_method(table(spark), "Circle")


def test_small_ports_leave_only_below_resolution_10(spark):
    df = areas.load_wkt(
        spark.createDataFrame([("rci", SHAPES["square"]), ("BLW", SHAPES["two"])], "Kode string, wkt string"), "wkt"
    )
    assert {r.Kode for r in areas.port_cells(df, ["Kode"], 8).select("Kode").distinct().collect()} == {"BLW"}
    assert {r.Kode for r in areas.port_cells(df, ["Kode"], 8, "Cluster").select("Kode").distinct().collect()} == {"rci", "BLW"}
    assert {r.Kode for r in areas.port_cells(df, ["Kode"], 10).select("Kode").distinct().collect()} == {"rci", "BLW"}


def test_areas_that_share_their_name_add_up(spark):
    square = "POLYGON (({0} 1, {1} 1, {1} 1.02, {0} 1.02, {0} 1))"
    one, other = square.format("100", "100.02"), square.format("100.01", "100.03")
    counts = []
    for texts in ([one], [one, one], [one, other], [one, other, one]):
        table = spark.createDataFrame([("BLW", t) for t in texts], "Kode string, wkt string").repartition(2)
        counts.append(areas.area_cells(areas.load_wkt(table, "wkt"), ["Kode"], 10).count())
    assert counts[0] == counts[1] and counts[0] < counts[2] == counts[3] < 2 * counts[0]
    points = spark.createDataFrame([(1, 100.015, 1.01), (2, 100.005, 1.01), (3, 100.2, 1.01)], "id int, longitude double, latitude double")
    found = areas.points_in_areas(points, areas.load_wkt(table, "wkt"), 10)
    assert sorted(r.id for r in found.collect()) == [1, 1, 1, 2, 2]


# ---- lattice runs joined as runs --------------------------------------------------


def square(spark, west, south, east, north):
    wkt = f"POLYGON (({west} {south}, {east} {south}, {east} {north}, {west} {north}, {west} {south}))"
    return areas.load_wkt(spark.createDataFrame([("z", wkt)], "name string, wkt string"), "wkt")


def test_a_zone_of_a_hundred_million_cells_is_tagged_without_a_shuffle_of_pings(spark):
    rnd = random.Random(11)
    runs = areas.zone_runs(square(spark, -10.0, -20.0, 60.0, 50.0), 8)
    assert runs.agg(F.sum(F.col("_last") - F.col("_first") + 1)).first()[0] > 100_000_000 and runs.count() < 20_000
    rows = [(k, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for k in range(3000)] + [(3000, None, 1.0)]
    pings = spark.createDataFrame(rows, "event_id long, latitude double, longitude double")
    pings = pings.withColumn("H3_int_index_8", grid.cell_at("latitude", "longitude", 8))
    tagged = zones.tag_zone_runs(pings, runs, "inside")
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan.split("InMemoryRelation")[0]
    centre = tagged.select("event_id", "inside", grid.centre("H3_int_index_8", 8).alias("c")).collect()
    for r in centre:
        want = r.c is not None and r.c.lat is not None and -20 <= r.c.lat < 50 and -10 <= r.c.lon < 60
        assert r.inside == want, r


def test_runs_with_many_parts_in_a_row(spark, monkeypatch):
    """Hundreds of runs in one row of the lattice, found by binary search, against their cells."""
    rnd = random.Random(12)
    parts, x = [], 0.0
    for _ in range(300):
        x += rnd.uniform(0.02, 0.1)
        width = rnd.uniform(0.01, 0.05)
        parts.append(f"(({x:.4f} 0.1, {x + width:.4f} 0.1, {x + width:.4f} 0.3, {x:.4f} 0.3, {x:.4f} 0.1))")
        x += width
    zone = areas.load_wkt(spark.createDataFrame([("m", f"MULTIPOLYGON ({', '.join(parts)})")], "name string, wkt string"), "wkt")
    rows = [(k, rnd.uniform(0.05, 0.35), rnd.uniform(-1, x + 1)) for k in range(4000)]
    pings = spark.createDataFrame(rows, "event_id long, latitude double, longitude double")
    pings = pings.withColumn("H3_int_index_9", grid.cell_at("latitude", "longitude", 9))
    got = joins.tag_runs(pings, areas.zone_runs(zone, 9), "inside", 9).select("event_id", "inside").collect()
    cells = {r[0] for r in areas.zone_cells(zone, 9).collect()}
    where = {r.event_id: r.H3_int_index_9 for r in pings.collect()}
    assert all(r.inside == (where[r.event_id] in cells) for r in got) and len(got) == 4000
    assert 100 < sum(r.inside for r in got) < 3900
    assert joins.tag_runs(pings, areas.zone_runs(zone.limit(0), 9), "inside", 9).filter("inside").count() == 0
    # the same by a merge join, as for runs that are too many to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(joins.sized, "__defaults__", (0, 0))
        merged = joins.keep_in_runs(pings, areas.zone_runs(zone, 9), 9)
        assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == sum(r.inside for r in got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cells_of_another_resolution_or_grid_raise(spark):
    runs = areas.zone_runs(square(spark, 0.0, 0.0, 1.0, 1.0), 8)
    for cell in (grid.cell_at(F.lit(0.5), F.lit(0.5), 9), F.lit(613196570357137407)):
        pings = spark.range(1).withColumn("H3_int_index_8", cell)
        with pytest.raises(Exception):
            joins.tag_runs(pings, runs, "inside", 8).collect()


# ---- across 180 degrees -----------------------------------------------------------

ACROSS = "POLYGON ((179.7 10.0, 180.4 10.0, 180.4 10.5, 180.1 10.8, 179.7 10.5, 179.7 10.0), (179.9 10.1, 180.1 10.1, 180.1 10.3, 179.9 10.3, 179.9 10.1))"


def across(spark):
    return areas.load_wkt(spark.createDataFrame([("a", ACROSS)], "name string, wkt string"), "wkt")


def points_around_the_line(spark, resolution, n=3000):
    rnd = random.Random(21)
    rows = []
    for k in range(n):
        lon = rnd.uniform(179.0, 181.0)
        rows.append((k, rnd.uniform(9.5, 11.2), lon if lon <= 180 else lon - 360))
    rows += [(n, 10.45, 180.0), (n + 1, 10.45, -180.0)]
    df = spark.createDataFrame(rows, "event_id long, latitude double, longitude double")
    c = f"H3_int_index_{resolution}"
    df = df.withColumn(c, grid.cell_at("latitude", "longitude", resolution))
    return df.withColumns({"clat": grid.centre_latitude(c, resolution), "clon": grid.centre_longitude(c, resolution)})


def inside_across(lat, lon):
    """Whether a place lies in the outline, by counting crossings, in the turn that is nearest to it."""
    lon = lon + 360 if lon < 0 else lon
    rings = [[tuple(map(float, p.split())) for p in part.split(", ")] for part in ACROSS[10:-2].split("), (")]
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 <= lat) != (y2 <= lat) and lon < x1 + (lat - y1) / (y2 - y1) * (x2 - x1):
                odd = not odd
    return odd


def test_an_outline_across_the_line_fills_both_ends(spark):
    got = joins.tag_runs(points_around_the_line(spark, 8), areas.zone_runs(across(spark), 8), "inside", 8).collect()
    assert all(r.inside == inside_across(r.clat, r.clon) for r in got)
    assert {r.inside for r in got if r.longitude < 0} == {r.inside for r in got if r.longitude > 0} == {True, False}
    cells = {r[0] for r in areas.zone_cells(across(spark), 8).collect()}
    assert {r.H3_int_index_8 for r in got if r.inside} <= cells
    filled = {r.h3_ids_int for r in areas.area_cells(across(spark), ["name"], 8).collect()}
    assert filled == cells


def test_a_buffer_goes_on_across_the_line(spark):
    near = "POLYGON ((179.9 10.0, 179.95 10.0, 179.95 10.05, 179.9 10.05, 179.9 10.0))"
    area = areas.load_wkt(spark.createDataFrame([("b", near)], "name string, wkt string"), "wkt")
    reach = 30_000.0
    got = joins.tag_runs(points_around_the_line(spark, 8), areas.buffer_runs(area, reach, 8), "near", 8).collect()

    def metres(lat, lon):
        lon = lon + 360 if lon < 0 else lon
        best = 1e18
        for k in range(401):
            t = k / 400
            for x, y in ((179.9 + 0.05 * t, 10.0), (179.9 + 0.05 * t, 10.05), (179.9, 10 + 0.05 * t), (179.95, 10 + 0.05 * t)):
                dx, dy = math.radians(lon - x) * math.cos(math.radians((lat + y) / 2)), math.radians(lat - y)
                best = min(best, math.hypot(dx, dy) * geo.SPHERE_M)
        return best

    checked = 0
    for r in got:
        d = metres(r.clat, r.clon)
        if abs(d - reach) > 30:
            assert r.near == (d < reach), (r.clat, r.clon, d)
            checked += r.longitude < 0
    assert checked > 500 and any(r.near for r in got if r.longitude < 0)


def test_distances_and_rings_across_the_line(spark):
    rnd = random.Random(22)
    rows = [(rnd.uniform(-60, 60), rnd.uniform(178, 182)) for _ in range(400)]
    rows = [(a, x if x <= 180 else x - 360, b, y if y <= 180 else y - 360, x, y) for (a, x), (b, y) in zip(rows, rows[1:])]
    df = spark.createDataFrame(rows, "la double, lo double, lb double, lp double, ux double, uy double")
    # the same places moved 90 degrees west lie far from the line: distances agree but for the seam
    df = df.select(
        grid.point_grid_distance("la", "lo", "lb", "lp", 6).alias("d"),
        grid.point_grid_distance("lb", "lp", "la", "lo", 6).alias("back"),
        grid.point_grid_distance("la", F.col("ux") - 90, "lb", F.col("uy") - 90, 6).alias("far"),
        grid.grid_distance(grid.cell_at("la", "lo", 6), grid.cell_at("lb", "lp", 6)).alias("cells"),
        (F.signum("lo") != F.signum("lp")).alias("crosses"),
    )
    for r in df.collect():
        assert abs(r.d - r.far) <= 2 and abs(r.d - r.back) <= 1 and r.cells == r.d
    assert df.filter("crosses").count() > 100
    at = spark.range(1).select(grid.cell_at(F.lit(10.0), F.lit(179.99), 6).alias("c"))
    cells = at.select("c", F.explode(grid.ring("c", 4)).alias("x"))
    lons = [r[0] for r in cells.select(grid.centre_longitude("x", 6)).collect()]
    assert 50 <= len(lons) <= 61 and len(set(lons)) > 5 and min(lons) < 0 < max(lons) and max(map(abs, lons)) <= 180 + grid.half_spacing(6)
    steps = [r[0] for r in cells.select(grid.grid_distance("c", "x")).collect()]
    assert max(steps) <= 5
    # far from the line rings are whole
    assert spark.range(1).select(F.size(grid.ring(grid.cell_at(F.lit(10.0), F.lit(100.0), 6), 4))).first()[0] == 61


# ---- cover of several resolutions --------------------------------------------------


def test_cover_is_coarse_inside_and_exact_for_areas_of_very_different_size(spark):
    shapes = {
        "huge": "POLYGON ((10.0 10.0, 18.0 10.0, 18.0 18.0, 14.0 17.0, 10.0 18.0, 10.0 10.0), (12.0 12.0, 12.5 12.0, 12.5 12.5, 12.0 12.5, 12.0 12.0))",
        "small": "POLYGON ((11.0 11.0, 11.2 11.0, 11.2 11.2, 11.0 11.2, 11.0 11.0))",
        "tiny": "POLYGON ((11.1 11.1, 11.101 11.1, 11.101 11.101, 11.1 11.101, 11.1 11.1))",
    }
    zones_ = table(spark, shapes)
    known = areas.identified(zones_)
    covered = areas.cover(areas.polygon_edges(known, ["_area"]), ["_area"], 8).cache()
    cells = areas.area_cells(zones_, ["name"], 8).count()
    assert cells > 1_000_000 and covered.count() < cells / 10
    # every cell once: blocks count for all their cells
    inside = covered.filter("centre_inside").agg(F.sum(F.when(F.col("cell") < 0, 1 << (2 * areas.BLOCK_BITS)).otherwise(1))).first()[0]
    assert inside == cells
    rnd = random.Random(31)
    rows = [(k, rnd.uniform(9, 19), rnd.uniform(9, 19)) for k in range(3000)]
    rows += [(3000 + k, rnd.uniform(10.9, 11.3), rnd.uniform(10.9, 11.3)) for k in range(1500)]
    rows += [(4500, 10.0, 14.0), (4501, 12.0, 12.2), (4502, 11.1005, 11.1005), (4503, None, 11.0)]
    points = spark.createDataFrame(rows, "event_id long, latitude double, longitude double")
    got = {(r.name, r.event_id) for r in areas.points_in_areas(points, zones_, 8).select("name", "event_id").collect()}
    edge = {("huge", 4500), ("huge", 4501)}  # on an outline
    want = {(name, k) for name, wkt in shapes.items() for k, lat, lon in rows if lat is not None and inside_of(wkt, lon, lat)}
    assert got == want | edge
    at = points.withColumn("c", grid.cell_at("latitude", "longitude", 8))
    at = at.withColumn("cell", F.explode(F.array("c", areas.block_of(grid.cell_q("c"), grid.cell_r("c")))))
    assert at.join(covered.select("cell"), "cell").count() <= 3 * len(got)


def inside_of(wkt, x, y):
    odd = False
    for part in wkt[wkt.index("((") + 2 : -2].split("), ("):
        ring = [tuple(map(float, p.split())) for p in part.split(", ")]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                odd = not odd
    return odd
