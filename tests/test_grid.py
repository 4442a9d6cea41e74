"""Grid and text functions."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairlead.functions import geo, grid, labels, ports


def points(spark, n=300, seed=3, lat=70):
    rnd = random.Random(seed)
    return spark.createDataFrame(
        [(rnd.uniform(-lat, lat), rnd.uniform(-179, 179), rnd.uniform(-lat, lat), rnd.uniform(-179, 179)) for _ in range(n)],
        "lat double, lon double, lat2 double, lon2 double",
    )


@pytest.mark.parametrize("resolution", [0, 5, 8, 10, 13, 15])
def test_point_lies_within_one_edge_of_its_centre(spark, resolution):
    df = points(spark).withColumn("c", grid.cell_at("lat", "lon", resolution))
    centre = grid.centre("c", resolution)
    dx = grid.mercator_x("lon") - grid.mercator_x(centre["lon"])
    dy = grid.mercator_y("lat") - grid.mercator_y(centre["lat"])
    worst = df.agg(F.max(F.hypot(dx, dy))).first()[0]
    assert worst <= grid.edge_length(resolution) * (1 + 1e-6)


def test_centre_maps_back_to_its_cell(spark):
    df = points(spark).withColumn("c", grid.cell_at("lat", "lon", 9))
    back = grid.cell_at(grid.centre_latitude("c"), grid.centre_longitude("c"), 9)
    assert df.filter(back != F.col("c")).count() == 0
    assert df.filter(grid.resolution_of("c") != 9).count() == 0


@given(st.integers(0, 6))
@settings(deadline=None, max_examples=7)
def test_ring_size(k):
    offsets = grid.ring_offsets(k)
    assert len(set(offsets)) == 1 + 3 * k * (k + 1)
    assert all(max(abs(q), abs(r), abs(q + r)) <= k for q, r in offsets)


def test_ring_and_distance_agree(spark):
    df = points(spark, 20).withColumn("c", grid.cell_at("lat", "lon", 7))
    ringed = df.select("c", F.explode(grid.ring("c", 3)).alias("n"))
    assert ringed.distinct().count() == df.select("c").distinct().count() * 37
    assert ringed.filter(~grid.within_ring("n", "c", 3)).count() == 0
    assert ringed.agg(F.max(grid.grid_distance("n", "c"))).first()[0] == 3


def test_distance_is_symmetric_and_null_across_resolutions(spark):
    df = points(spark, 100).withColumns(
        {"a": grid.cell_at("lat", "lon", 6), "b": grid.cell_at("lat2", "lon2", 6), "x": grid.cell_at("lat2", "lon2", 7)}
    )
    assert df.filter(grid.grid_distance("a", "b") != grid.grid_distance("b", "a")).count() == 0
    assert df.filter(grid.grid_distance("a", "x").isNotNull()).count() == 0
    assert df.filter(grid.within_ring("a", "x", 3)).count() == 0


def test_documented_text_pair(spark):
    row = spark.range(1).select(
        grid.cell_to_text(F.lit(621922022744817663)).alias("t"), grid.text_to_cell(F.lit("8a182c8dbb27fff")).alias("c"),
        grid.resolution_of(F.lit(621922022744817663)).alias("r"),
    ).first()
    assert (row.t, row.c, row.r) == ("8a182c8dbb27fff", 621922022744817663, 10)


@pytest.mark.parametrize("bad", [-1, 16, 2.5, True])
def test_resolution_is_checked(bad):
    with pytest.raises(ValueError):
        grid.edge_length(bad)


def test_haversine(spark):
    row = spark.range(1).select(
        geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        geo.haversine_m(F.lit(91.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("bad"),
        geo.haversine_m(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("missing"),
    ).first()
    assert row.half == pytest.approx(math.pi * geo.SPHERE_M) and row.bad is None and row.missing is None


def test_stay_estimates_round_half_to_even(spark):
    lower, upper = labels.stay_estimates(F.lit(0), F.lit(0), F.lit(1800), F.lit(5400))
    back_lower, _ = labels.stay_estimates(F.lit(0), F.lit(7200), F.lit(0), F.lit(0), -1)
    row = spark.range(1).select(lower.alias("l"), upper.alias("u"), back_lower.alias("b")).first()
    assert (row.l, row.u, row.b) == (0, 2, 2)
    with pytest.raises(ValueError):
        labels.stay_estimates(F.lit(0), F.lit(0), F.lit(0), F.lit(0), 0)


def test_labels(spark):
    row = spark.range(1).select(
        labels.country_of(F.lit("Tanjung Priok - Indonesia")).alias("c"), labels.country_of(F.lit("Sea")).alias("w"),
        labels.country_of(F.lit("A-B")).alias("d"), labels.home_or_foreign(F.lit(None).cast("string")).alias("f"),
        labels.or_false(F.lit(None).cast("boolean")).alias("z"), ports.port_name(F.lit("NAM")).alias("p"),
        ports.port_name(F.lit("???")).alias("q"), labels.observation_thresholds(F.lit("PASSENGER"))[1].alias("t"),
        labels.observation_thresholds(F.lit(None).cast("string"))[0].alias("n"),
    ).first()
    assert tuple(row) == ("Indonesia", "Sea", "A-B", "Foreign", False, "Leksula", None, 2, 10)
    assert len(ports.PORT_NAMES) == 135


def test_positions_out_of_range_have_no_cell(spark):
    rows = [(91.0, 181.0), (86.0, 0.0), (90.0, 0.0), (float("nan"), 0.0), (0.0, float("nan")), (0.0, 180.5), (None, 0.0), (-84.0, 179.9)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    for resolution in (0, 8, 15):
        got = [r.c for r in df.select(grid.cell_at("lat", "lon", resolution).alias("c")).collect()]
        assert got[:7] == [None] * 7 and (got[7] is None) == (resolution == 15)


def test_foreign_cells_raise(spark):
    df = spark.range(1).select(F.lit(621922022744817663).alias("h"), grid.cell_at(F.lit(1.0), F.lit(2.0), 10).alias("c"))
    for read in (grid.centre("h"), grid.ring("h", 1), grid.grid_distance("h", "c"), grid.grid_distance("c", "h")):
        with pytest.raises(Exception, match="another grid"):
            df.select(read.alias("x")).collect()
