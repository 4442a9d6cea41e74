"""Periods added one by one against one run over the whole history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fairlead.operators import reports, stops, visits, voyages
from fairlead.plans import periods
from tests import test_stops

START = dt.datetime(2024, 1, 1)
DAY = 86400
VISIT = (
    "mmsi long, dt_pos_utc timestamp_ntz, Kode string, h3_ids_int long, vessel_name string, Prov_ID string, Hirarki_1 string, flag_country string, "
    "GroupBeneficialOwnerCountryofDomicile string, GroupBeneficialOwnerCountryOfRegistration string, RegisteredOwnerCountryofDomicile string, "
    "vessel_type string, vessel_type_main string, vessel_type_sub string, nav_status string, draught double, sog double, latitude double, "
    "longitude double, H3_int_index_8 long"
)


def tagged_rows(rnd, ships, days, per_day):
    """Ships that hop in and out of ports, some silent for whole periods, some never in port, with repeated pings."""
    rows = []
    for ship in range(ships):
        port = None
        for day in range(days):
            if ship % 4 == 1 and day % 3 == 1 or (ship % 5 == 2 and day == 0):
                continue
            for _ in range(rnd.randrange(per_day)):
                if rnd.random() < 0.4:
                    port = rnd.choice([None, None, "A", "B"]) if ship % 7 else None
                t = START + dt.timedelta(days=day, seconds=rnd.randrange(DAY))
                rows.append((ship, t, port, None if port is None else 5, "v", "p", "h", "f", "o", "o", "o", "t", "m", "s", rnd.choice("xy"), 1.0, 2.0, 3.0, 4.0, 7))
    rows.sort(key=lambda r: (r[0], r[1]))
    return rows + rnd.sample(rows, len(rows) // 20)


def text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("seed,cuts", [(1, [0, 2, 5, 9]), (2, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]), (3, [0, 9])])
def test_visits_of_periods_equal_one_run(spark, tmp_path, seed, cuts):
    df = spark.createDataFrame(tagged_rows(random.Random(seed), 24, 9, 7), VISIT).repartition(3)
    want = visits.port_visits(df, slice_seconds=2 * DAY)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        first, after = (F.lit(START + dt.timedelta(days=d)).cast("timestamp_ntz") for d in (a, b))
        part = df.filter((F.col("dt_pos_utc") >= first) & (F.col("dt_pos_utc") < after))
        periods.add_visits(part, str(tmp_path), f"p{k:02d}", slice_seconds=2 * DAY)
    got = periods.port_visits(spark, str(tmp_path))
    assert got.columns == want.columns and text(got.collect()) == text(want.collect()) and want.count() > 100


def test_a_period_may_be_run_again_and_reads_only_its_pings(spark, tmp_path):
    df = spark.createDataFrame(tagged_rows(random.Random(5), 12, 6, 7), VISIT)
    cut = F.lit(START + dt.timedelta(days=3)).cast("timestamp_ntz")
    parts = [df.filter(F.col("dt_pos_utc") < cut), df.filter(F.col("dt_pos_utc") >= cut)]
    for k in (0, 1, 1):
        periods.add_visits(parts[k], str(tmp_path), f"p{k}", slice_seconds=DAY)
    assert text(periods.port_visits(spark, str(tmp_path)).collect()) == text(visits.port_visits(df, slice_seconds=DAY).collect())
    # at most two waiting rows a ship and step
    state = spark.read.parquet(f"{tmp_path}/open_edges").filter("period = 'p1'")
    assert state.groupBy("mmsi", "_level").count().agg(F.max("count")).first()[0] <= 2
    plan = periods.port_visits(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan
    with pytest.raises(ValueError):
        periods.port_visits(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("cuts", [[0, 3, 6, 9], [0, 1, 8, 9]])
def test_voyages_of_periods_equal_one_run(spark, tmp_path, cuts):
    rnd = random.Random(7)
    rows = []
    for ship in range(20):
        cell = 1
        for k in range(60):
            if rnd.random() < 0.5:
                cell = rnd.randrange(6)
            day = rnd.randrange(9)
            if ship % 3 == 0 and 3 <= day < 6:
                continue
            rows.append((ship, START + dt.timedelta(days=day, seconds=rnd.randrange(DAY)), "t", cell, ship * 1000 + k))
    df = spark.createDataFrame(rows, "mmsi long, dt_pos_utc timestamp_ntz, vessel_type string, H3_int_index_8 long, event_id long")
    ports = spark.createDataFrame(
        [(c, f"P{c // 2} - C{c // 2}", float(c // 2), 1.0) for c in range(5)], "boundary_h3 long, Port_Country string, lat double, lon double"
    )
    want = voyages.legs(voyages.port_calls(df, ports, tiebreak=["event_id"], slice_seconds=DAY), ["event_id"], DAY)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        first, after = (F.lit(START + dt.timedelta(days=d)).cast("timestamp_ntz") for d in (a, b))
        part = df.filter((F.col("dt_pos_utc") >= first) & (F.col("dt_pos_utc") < after))
        periods.add_voyages(part, ports, str(tmp_path), f"p{k}", tiebreak=["event_id"], slice_seconds=DAY)
    got = periods.voyage_legs(spark, str(tmp_path)).select(*want.columns)
    assert text(got.collect()) == text(want.collect()) and want.count() > 100


@pytest.mark.parametrize("seed,days", [(1, [0, 1, 2, 3]), (2, [0, 2, 3]), (3, [0, 1, 2, 3, 4, 5, 6])])
def test_stop_events_of_periods_equal_one_run(spark, tmp_path, seed, days):
    rnd = random.Random(seed)
    rows = []
    for ship in range(14):
        kind = ["Passenger", "Tanker", None][ship % 3]
        n = rnd.choice([1, 2, 12, 60, 300])
        rows += test_stops.walk(rnd, ship, n, kind, ship * 1000, step=rnd.choice([60, 600, 1800]))
    df = spark.createDataFrame(rows, test_stops.SCHEMA).repartition(3)
    want = stops.stop_events(df, 10, ["event_id"], slice_seconds=3600)
    edges = [test_stops.START + dt.timedelta(days=d) for d in days] + [dt.datetime(2100, 1, 1)]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        first, after = (F.lit(d).cast("timestamp_ntz") for d in (a, b))
        part = df.filter((F.col("dt_pos_utc") >= first) & (F.col("dt_pos_utc") < after))
        periods.add_stops(part, str(tmp_path), f"p{k:02d}", 10, ["event_id"], slice_seconds=3600)
    got = periods.stop_events(spark, str(tmp_path))

    def cells(df):
        out = []
        for r in df.collect():
            # sums of parts differ in the last bits
            out.append({k: (round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items() if "wkt" not in k})
        return sorted(out, key=str)

    assert got.columns == want.columns and cells(got) == cells(want) and len(cells(want)) > 5
    held = spark.read.parquet(f"{tmp_path}/open_events")
    assert held.groupBy("period", "mmsi", "nav_status").count().agg(F.max("count")).first()[0] == 1


def test_periods_that_cut_a_slice_raise(spark, tmp_path):
    rows = test_stops.walk(random.Random(3), 1, 80, "Tanker", 0, step=60)
    df = spark.createDataFrame(rows, test_stops.SCHEMA)
    cut = F.lit(rows[40][4]).cast("timestamp_ntz")
    periods.add_stops(df.filter(F.col("dt_pos_utc") < cut), str(tmp_path), "a", slice_seconds=86400)
    with pytest.raises(Exception, match="multiple of the slice length"):
        periods.add_stops(df.filter(F.col("dt_pos_utc") >= cut), str(tmp_path), "b", slice_seconds=86400)


def test_merged_medians_keep_the_stated_rank_error(spark, tmp_path):
    rnd = random.Random(9)
    values = [(k % 3, k % 40, rnd.lognormvariate(2, 1)) for k in range(60_000)] + [(5, 1, None), (4, 1, 2.0), (4, 2, None)]
    df = spark.createDataFrame(values, "port int, day int, hours double").repartition(4)
    for name, rule in (("a", "day < 10"), ("b", "day between 10 and 30"), ("c", "day > 30")):
        periods.add_durations(reports.duration_sketches(df.filter(rule), "hours", ["port", "day"]), str(tmp_path), name)
    got = {r.port: r for r in periods.durations(spark, str(tmp_path), ["port"]).collect()}
    assert set(got) == {0, 1, 2, 4} and got[4].median_durasi == got[4].rata_rata_durasi == 2.0
    for port in range(3):
        mine = sorted(v for p, _, v in values if p == port)
        rank = sum(v <= got[port].median_durasi for v in mine) / len(mine)
        assert abs(rank - 0.5) < 0.01 and abs(got[port].rata_rata_durasi - sum(mine) / len(mine)) < 1e-9
    whole = periods.durations(spark, str(tmp_path), []).first()
    everything = sorted(v for _, _, v in values if v is not None)
    assert abs(sum(v <= whole.median_durasi for v in everything) / len(everything) - 0.5) < 0.01


def test_periods_of_durations_find_their_events_once(spark, monkeypatch):
    from fairlead.operators import stops as stop_operators
    from fairlead.operators import visits as visit_operators
    from queries.catalog import QUERIES

    calls = []
    for module, name in ((stop_operators, "stop_events"), (visit_operators, "port_visits")):
        made = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _f=made, _n=name, **o: calls.append(_n) or _f(*a, **o))
    for query in ("stay_hours_by_period", "time_in_port_by_period"):
        assert QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0
    assert calls == ["stop_events", "port_visits"]
