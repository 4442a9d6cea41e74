"""Cleaning, joins, statistics and sinks on hand-built tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fairlead.functions import grid
from fairlead.operators import clean, columns, joins, reports, stats, voyages
from fairlead.sources import readers, writers

START = dt.datetime(2024, 1, 1)


def test_ships_without_fast_pings_stay(spark):
    rows = [(1, 0.0)] * 10 + [(2, 9.0)] * 9 + [(3, 9.0)] * 19 + [(4, 9.0)] * 20 + [(5, 3.0)] * 10 + [(6, None)] * 12
    df = spark.createDataFrame(rows, "mmsi long, sog double")
    assert {r.mmsi for r in clean.active_ships_only(df).collect()} == {1, 4, 5, 6}


def test_match_classes(spark):
    pings = spark.createDataFrame(
        [(1, 10, "a"), (1, 10, "a"), (1, 99, "a"), (7, 20, "b"), (8, None, "C"), (9, None, None)],
        "mmsi long, imo long, vessel_name string",
    )
    register = spark.createDataFrame([(1, 10, "A"), (2, 20, "B"), (3, 30, "C"), (4, 31, "C")], "ship long, no long, title string")
    got = joins.match_register(pings, register, "ship", "no", "title")
    assert sorted((r.mmsi, r.imo or 0, r.ihs_matchtype, r.title) for r in got.collect()) == [
        (1, 10, 1, "A"), (1, 10, 1, "A"), (1, 99, 2, "A"), (7, 20, 3, "B"), (8, 0, 4, "C"), (9, 0, 9, None)
    ]
    assert joins.match_register(pings, register, "ship", "no", "title", return_all=False).count() == 5
    assert {r.ship for r in got.filter("mmsi = 8").collect()} == {3}


def test_matched_only_drops_null(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "ihs_matchtype int")
    assert columns.matched_only(df).count() == 1


def test_keyed_join(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k long, v string")
    b = spark.createDataFrame([(1, "p")], "k long, w string")
    nulls = joins.keyed_join(a, b, "k", "k", "LEFT", "NullsOnly")
    assert nulls.columns == ["k", "v", "k", "w"]
    assert sorted(str(tuple(r)) for r in nulls.collect()) == ["(2, 'y', None, None)", "(None, 'z', None, None)"]
    assert joins.keyed_join(a, b, "k", "k", "LEFT", "All").count() == 3
    for args in (("OUTER", "All"), ("LEFT", "Some")):
        with pytest.raises(ValueError):
            joins.keyed_join(a, b, "k", "k", *args)


def test_large_dimension_is_not_broadcast(spark):
    big, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
    plan = lambda n: big.join(joins.sized(dim, n), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(50) and "SortMergeJoin" in plan(49)


def test_keep_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.keep_columns(df, ["c", "a", "A", "zz"]).columns == ["a", "c"]
    assert columns.keep_columns(df).columns == ["a", "b", "c"]


def test_box_is_strict_and_ignores_point_fields(spark):
    df = spark.createDataFrame([(0.0, 0.5), (0.5, 0.5), (1.0, 0.5)], "longitude double, latitude double")
    got = columns.in_box(df, "latitude", "longitude", 0.0, 0.0, 1.0, 1.0).collect()
    assert [(r.geom.lon, r.geom.lat) for r in got] == [(0.5, 0.5)] and got[0].longitude == 0.5


def test_type_overrides_take_the_last_entry(spark):
    df = spark.createDataFrame([("a", "m", "s"), (None, "m", "s")], "vessel_name string, vessel_type_main string, vessel_type_sub string")
    got = columns.override_types(df, [("a", "x", "y"), ("a", "z", None)]).collect()
    assert [tuple(r) for r in got] == [("a", "z", "y"), (None, "m", "s")]


def test_equal_modes(spark):
    df = spark.createDataFrame([(1, "b", 0), (1, "a", 1), (1, "a", 2), (1, "b", 3), (1, "c", 4)], "k int, v string, t int")
    pick = lambda which: {r["mode"] for r in stats.mode_per_key(df, ["k"], "v", "t", which).collect()}
    assert (pick(1), pick(0), pick("all")) == ({"a"}, {"b"}, {"a", "b"})
    with pytest.raises(ValueError):
        stats.mode_per_key(df, ["k"], "v", "t", 2)


def test_means_and_deviations_skip_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 2.0), (1, nan), (1, 4.0), (2, 5.0), (3, nan), (3, 1.0)], "k int, v double")
    got = {r.k: r for r in df.groupBy("k").agg(stats.clean_mean("v").alias("m"), stats.clean_deviation("v").alias("s")).collect()}
    assert (got[1].m, got[2].s) == (3.0, 0.0) and got[1].s == pytest.approx(math.sqrt(2)) and math.isnan(got[3].s)


def test_cell_in_two_ports_yields_two_rows(spark):
    cell = (1 << 62) + (8 << 52) + ((5 + grid.OFFSET) << 26) + grid.OFFSET
    pings = spark.createDataFrame([(1, START, "t", cell)], "mmsi long, dt_pos_utc timestamp_ntz, vessel_type string, H3_int_index_8 long")
    ports = spark.createDataFrame([("P", "X", cell, "P - X"), ("Q", "Y", cell, "Q - Y")], "Port string, Country string, boundary_h3 long, Port_Country string")
    legs = voyages.legs(voyages.port_calls(pings, voyages.with_centres(ports, resolution=8)))
    assert [(r.Country_Origin, r.Country_Destination) for r in legs.collect()] == [("X", "Y")]


def test_ports_union_goes_by_name(spark):
    a = spark.createDataFrame([("P", "X", 5, "P - X")], "Port string, Country string, boundary_h3 long, Port_Country string")
    b = spark.createDataFrame([("Q - Y", 6, "Y", "Q")], "Port_Country string, boundary_h3 long, Country string, Port string")
    assert {r.Port for r in voyages.union_ports(a, b).collect()} == {"P", "Q"}


def test_stop_recap_rules(spark):
    rows = [("A", START, 2, 2), ("A", START, 2, 3), ("A", START, 1, 2), ("A", START, 1, 3), ("A", START, 3, 3)]
    df = spark.createDataFrame(rows, "Kode string, obs_time timestamp_ntz, state_initial int, state_final int")
    assert reports.recap_stops(df, "arrival").first().kedatangan == 2
    assert reports.recap_stops(df, "departed").first().keberangkatan == 2
    assert reports.recap_stops(df, "arrival", month_obs=2).count() == 0
    text = df.withColumn("obs_time", F.col("obs_time").cast("string"))
    assert reports.recap_stops(text, "arrival", "A", 1, 1, 2024).first().kedatangan == 2
    with pytest.raises(ValueError):
        reports.recap_stops(df, "leaving")
    with pytest.raises(ValueError):
        reports.summarize_time_in_port(df, ["Kode"], "stationary")


def test_period_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, START), (2, dt.datetime(2024, 1, 2, 23, 59))], "mmsi long, dt_pos_utc timestamp_ntz").write.parquet(path)
    df = readers.in_period(readers.read_parquet(spark, path), "2024-01-02", "2024-01-02")
    assert [r.mmsi for r in df.collect()] == [2]
    assert "GreaterThanOrEqual(dt_pos_utc" in df._jdf.queryExecution().executedPlan().toString()


def test_accumulation_writes_one_period(spark, tmp_path):
    path = str(tmp_path / "all")
    old, now = (spark.createDataFrame([r], "x int, y string") for r in ((1, "a"), (2, "b")))
    writers.accumulate(spark, old, path, "2024-01")
    writers.accumulate(spark, now, path, "2024-02")
    writers.accumulate(spark, now.select("y", "x"), path, "2024-02")
    rows = writers.accumulated(spark, path)
    assert sorted(tuple(r) for r in rows.select("x", "y", "period").collect()) == [(1, "a", "2024-01"), (2, "b", "2024-02")]
    with pytest.raises(ValueError):
        writers.accumulate(spark, now.select("x"), path, "2024-03")
    with pytest.raises(ValueError):
        writers.accumulate(spark, now, path, "a/b")


def test_accumulation_raises_on_damaged_history(spark, tmp_path):
    path = tmp_path / "all"
    now = spark.createDataFrame([(1, "a")], "x int, y string")
    writers.accumulate(spark, now, str(path), "2024-01")
    for f in path.rglob("*.parquet"):
        f.write_bytes(b"damaged")
    with pytest.raises(Exception):  # noqa: B017
        writers.accumulate(spark, now, str(path), "2024-02")


REGISTER = "number bigint, imo_no bigint, name string, status string"


def test_register_rows_that_share_a_key(spark):
    register = spark.createDataFrame(
        [
            (7, 70, "A", "second by imo"), (7, 71, "A", "first by row"), (None, 72, "B", "no number"), (9, 72, "B", "numbered"),
            (0, 0, "", "nobody"), (None, 73, "C", "x"), (None, 73, "C", "y"),
        ],
        REGISTER,
    )
    ships = [(7, 70, "Z"), (7, 5, "Z"), (1, 72, "Z"), (2, 0, ""), (0, 6, None), (3, None, "B"), (4, 73, "Z"), (None, None, None)]
    pings = spark.createDataFrame([(i, *s) for i, s in enumerate(ships * 2)], "event_id int, mmsi bigint, imo bigint, vessel_name string")

    def match(p, r):
        out = joins.match_register(p, r, "number", "imo_no", "name")
        return {r.event_id: (r.ihs_matchtype, r.status) for r in out.collect()}

    got = match(pings, register)
    assert len(got) == 16 and [got[i][0] for i in range(8)] == [1, 2, 3, 9, 9, 4, 3, 9]
    assert got[0][1] == "second by imo" and got[2][1] == "numbered" and got[5][1] == "numbered"
    assert got == match(pings.repartition(5), register.repartition(3))


def test_csv_rows_with_nulls_are_dropped(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("a,b\n1,x\n2,\n,y\n")
    assert [tuple(r) for r in readers.read_csv_complete(spark, str(path)).collect()] == [("1", "x")]
