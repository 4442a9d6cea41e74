"""Zone edges and travel times against a plain loop."""

import datetime as dt
import random

import pytest

from fairlead.operators import zones

START = dt.datetime(2024, 1, 1)


def brute(rows):
    """rows: time-ordered (time, in_strait, in_home) of one ship."""
    entries = [b[0] for a, b in zip(rows, rows[1:]) if not a[2] and b[2]]
    if not entries:
        return None
    exits = [b[0] for a, b in zip(rows, rows[1:]) if a[1] and not b[1] and b[0] < entries[0]]
    return (max(exits), entries[0]) if exits else None


@pytest.mark.parametrize("seconds", [600, 7200, 10**8])
def test_transit_times(spark, seconds):
    rnd = random.Random(seconds)
    data, want = [], {}
    for ship in range(60):
        rows = []
        t = START
        for _ in range(400 if ship == 0 else rnd.randint(1, 25)):
            t += dt.timedelta(seconds=rnd.choice([60, 1000, 8000]))
            rows.append((t, rnd.random() < 0.3, rnd.random() < (0.02 if ship == 0 else 0.2)))
        data += [(ship, *r) for r in rows]
        if (found := brute(rows)) is not None:
            want[ship] = found
    df = spark.createDataFrame(data, "mmsi long, dt_pos_utc timestamp_ntz, s boolean, h boolean")
    got = zones.transit_times(zones.zone_edges(df, "s", "h", slice_seconds=seconds), seconds).collect()
    assert {r.mmsi: (r.t_hormuz, r.t_indo) for r in got} == want
    for r in got:
        assert r.travel_time_hours == pytest.approx((r.t_indo - r.t_hormuz).total_seconds() / 3600)


def test_first_ping_is_never_an_edge(spark):
    df = spark.createDataFrame([(1, START, True, True)], "mmsi long, dt_pos_utc timestamp_ntz, s boolean, h boolean")
    assert zones.zone_edges(df, "s", "h").count() == 0


def test_duplicate_zone_cells_do_not_multiply(spark):
    pings = spark.createDataFrame([(1, 5), (1, 6)], "mmsi long, H3_int_index_8 long")
    cells = spark.createDataFrame([(5,), (5,)], "cell long")
    assert [(r.H3_int_index_8, r.z) for r in zones.tag_zone(pings, cells, "z").orderBy("H3_int_index_8").collect()] == [
        (5, True), (6, False)
    ]
