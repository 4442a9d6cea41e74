"""International legs from lists of ports equal those from a row per port and ping."""

import datetime as dt
import random

import pytest

from fairlead.operators import voyages

START = dt.datetime(2024, 1, 1)
COLUMNS = [
    "mmsi", "dt_pos_utc", "vessel_type", *voyages.ROUTE, *voyages.ROUTE_POINTS, "Country_Origin", "Country_Destination",
]


@pytest.mark.parametrize("tiebreak", [[], ["event_id"]])
def test_legs_equal_those_of_expanded_calls(spark, tiebreak):
    rnd = random.Random(4)
    names = [f"P{k} - {c}" for k, c in enumerate(["Indonesia", "Japan", "Indonesia", "Qatar", "Indonesia", "Japan"])] + [None]
    cells = [(c, n, 1.0 + c, 2.0 + c) for c in range(9) for n in rnd.choices(names, k=rnd.choice([1, 1, 2, 4]))]
    ports = spark.createDataFrame(cells, "boundary_h3 long, Port_Country string, lat double, lon double").cache()
    rows = []
    for _ in range(900):  # many pings of one time, some of them twice, some ids null or repeated
        at = None if rnd.random() < 0.01 else START + dt.timedelta(seconds=900 * rnd.randrange(60))
        rows += [(rnd.choice([None, *range(15)]), at, rnd.choice(["t", None]), rnd.randrange(14), rnd.choice([None, *range(40)]))] * rnd.choice([1, 1, 2])
    pings = spark.createDataFrame(rows, "mmsi long, dt_pos_utc timestamp_ntz, vessel_type string, H3_int_index_8 long, event_id long").cache()
    calls = voyages.port_calls(pings, ports, tiebreak=tiebreak, slice_seconds=7200)
    want = voyages.international(voyages.legs(calls, tiebreak, 7200)).select(COLUMNS)
    got = voyages.international_legs(pings, ports, tiebreak=tiebreak, slice_seconds=7200).select(COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 100


def test_rows_do_not_grow_with_the_ports_of_a_cell(spark):
    ports = spark.createDataFrame(
        [(1, f"P{k:03} - Japan", 1.0, 1.0) for k in range(300)] + [(2, "Q - Indonesia", 2.0, 2.0)],
        "boundary_h3 long, Port_Country string, lat double, lon double",
    )
    pings = spark.createDataFrame(
        [(1, START + dt.timedelta(hours=k), "t", 1 + k % 2) for k in range(40)],
        "mmsi long, dt_pos_utc timestamp_ntz, vessel_type string, H3_int_index_8 long",
    )
    df = voyages.international_legs(pings, ports)
    got = [tuple(r) for r in df.select(voyages.ROUTE).collect()]
    assert sorted(set(got)) == [("P299 - Japan", "Q - Indonesia"), ("Q - Indonesia", "P000 - Japan")] and len(got) == 39
