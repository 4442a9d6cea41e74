"""Scans of a clustered table read fewer files and rows, and give the same pings."""

import datetime as dt
import random

import pytest

from fairlead.functions import grid
from fairlead.operators import areas
from fairlead.sources import layout, readers

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def pings(spark):
    rnd = random.Random(2)
    rows = []
    for k in range(12_000):
        ship = rnd.randrange(300)
        # ships keep to their own waters
        lat, lon = (ship % 17) * 5 - 40 + rnd.random(), (ship % 31) * 10 - 150 + rnd.random()
        rows.append((k, ship, START + dt.timedelta(seconds=rnd.randrange(6 * 86400)), lat, lon))
    rows += [(12_000, 5, START, None, None), (12_001, None, START, 1.0, 1.0)]
    return spark.createDataFrame(rows, "event_id long, mmsi long, dt_pos_utc timestamp_ntz, latitude double, longitude double").cache()


@pytest.fixture(scope="module")
def target(spark, pings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout"))
    layout.write_clustered(pings, path, 48)
    return path


def outline(spark, west, south, size):
    e, n = west + size, south + size
    wkt = f"POLYGON (({west} {south}, {e} {south}, {e} {n}, {west} {n}, {west} {south}))"
    return areas.load_wkt(spark.createDataFrame([("z", wkt)], "name string, wkt string"), "wkt")


def scanned(df):
    """Rows that come out of the file scan of a plan that has run."""
    total = 0

    def walk(node):
        nonlocal total
        if node.nodeName().startswith("Scan parquet"):
            total += int(str(node.metrics().apply("numOutputRows").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    walk(plan)
    return total


def test_a_region_scan_skips_row_groups(spark, pings, target):
    zone = outline(spark, -150.0, -40.0, 1.0)
    whole = layout.read_clustered(spark, target, "2024-01-01", "2024-01-06")
    near = layout.within_boxes(whole, zone).select("event_id", "latitude", "longitude")
    want = {r.event_id for r in pings.filter("latitude between -40 and -39 and longitude between -150 and -149").collect()}
    assert {r.event_id for r in near.collect()} == want and want
    assert scanned(near) < 0.3 * pings.count()
    assert {r.event_id for r in whole.collect()} == {r.event_id for r in pings.collect()}


def test_a_scan_by_ships_opens_only_files_with_them(spark, pings, target, tmp_path):
    zone = outline(spark, -150.0, -40.0, 1.0)
    got = layout.pings_of_ships_seen_in(spark, target, zone, 7, "2024-01-02", "2024-01-04", str(tmp_path))
    placed = pings.withColumn("c", grid.cell_at("latitude", "longitude", 7))
    want = readers.pings_of_ships_seen_in(placed, areas.zone_cells(zone, 7), "c", "2024-01-02", "2024-01-04")
    assert {r.event_id for r in got.collect()} == {r.event_id for r in want.collect()} and got.columns == pings.columns
    opened = [f for f in got.inputFiles() if "/pings/" in f]
    every = layout.read_clustered(spark, target, "2024-01-01", "2024-01-06").inputFiles()
    assert 0 < len(opened) < len(every) / 2
    nobody = layout.pings_of_ships_seen_in(spark, target, outline(spark, 0.0, 80.0, 0.5), 7, "2024-01-02", "2024-01-04", str(tmp_path))
    assert nobody.count() == 0 and nobody.columns == pings.columns


def test_the_curve_interleaves_bits(spark):
    rnd = random.Random(3)
    rows = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    for r in df.select("*", layout.place_on_curve().alias("p")).collect():
        x, y = (min(int((v - low) * 65536 / span), 65535) for v, low, span in ((r.longitude, -180, 360), (r.latitude, -90, 180)))
        want = sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(16))
        assert r.p == want


def test_many_areas_share_one_box(spark, pings):
    shapes = [(f"z{k}", f"POLYGON (({k} 0, {k}.5 0, {k}.5 0.5, {k} 0.5, {k} 0))") for k in range(40)]
    many = areas.load_wkt(spark.createDataFrame(shapes, "name string, wkt string"), "wkt")
    got = {r.event_id for r in layout.within_boxes(pings, many).collect()}
    assert got == {r.event_id for r in pings.filter("latitude between 0 and 0.5 and longitude between 0 and 39.5").collect()}
