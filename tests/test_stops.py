"""Stop events against the state machine run ping by ping in plain Python."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fairlead.functions import grid
from fairlead.operators import stops

START = dt.datetime(2024, 1, 1)
SCHEMA = (
    "event_id long, mmsi long, imo long, nav_status string, dt_pos_utc timestamp_ntz, length double, width double, "
    "vessel_type string, vessel_type_main string, flag_country string, source string, destination string, sog double, "
    "cog double, latitude double, longitude double, H3_int_index_10 long"
)


def cell(q, r):
    return (1 << 62) + (10 << 52) + ((q + grid.OFFSET) << 26) + r + grid.OFFSET


def walk(rnd, ship, n, kind, first_id, step=600, speed_missing=True):
    q = r = 0
    rows, t = [], START
    for i in range(n):
        if rnd.random() < 0.5:
            q, r = q + rnd.choice([-2, -1, 0, 1, 2]), r + rnd.choice([-1, 0, 1])
        if rnd.random() < 0.03:
            q += 30
        t += dt.timedelta(seconds=rnd.choice([step, step, 4 * step]))
        sog = None if speed_missing and rnd.random() < 0.05 else rnd.choice([0.0, 0.5, 1.0, 8.0])
        rows.append(
            (first_id + i, ship, None if rnd.random() < 0.6 else 9000 + i, rnd.choice(["moored", "anchor", None]), t, 10.0, 2.0,
             kind, "m", "f", "s", "d", sog, 0.0, 1.0 + 0.001 * q, 2.0 + 0.001 * r, cell(q, r))
        )
    return rows


def reach(a, b):
    dq = ((a >> 26) - (b >> 26))
    dr = (a & grid.AXIS_MASK) - (b & grid.AXIS_MASK)
    return max(abs(dq), abs(dr), abs(dq + dr)) <= 3


def brute(rows, compat):
    """rows of one ship in order -> list of event dicts."""
    passenger = (rows[0][7] or "").lower() == "passenger"
    event_min, ship_min = (2, 2) if passenger else ((20, 10) if compat else (10, 20))
    if len(rows) <= ship_min:
        return []
    unix = [int((r[4] - dt.datetime(1970, 1, 1)).total_seconds()) for r in rows]
    spans, current = [], None
    for i, r in enumerate(rows):
        if current is not None:
            if reach(r[16], rows[current[0]][16]):
                current.append(i)
            else:
                spans.append((current, i))
                current = None
        elif r[12] is not None and r[12] < 1:
            current = [i]
    if current is not None:
        spans.append((current, None))
    out = []
    for members, closing in spans:
        a, z = members[0], members[-1]
        if compat and closing is None:
            members = [*members, z]
        imo = next((r[2] for r in rows[: a + 1] if r[2] is not None), -1)
        lower = round((unix[z] - unix[a]) / 3600)
        upper = round((unix[closing if closing is not None else z] - unix[a - 1 if a else a]) / 3600)
        seen = {}
        for i in members:
            seen[rows[i][3]] = seen.get(rows[i][3], 0) + 1
        best = max(seen.values())
        mode = [k for k, v in seen.items() if v == best][-1]

        def state(i):
            return 3 if i == len(rows) - 1 else 1 if i == 0 else 2

        lats = [rows[i][14] for i in members]
        valid = len(members) > event_min
        out.append(
            {
                "mmsi": rows[0][1], "unix_trigger": unix[a], "unix_disarm": unix[z], "obs_count": len(members), "imo": imo,
                "time_lower": upper if compat else lower, "time_upper": lower if compat else upper,
                "mode_nav_status": mode, "obs_nav_status": best, "state_initial": state(a), "state_final": state(z),
                "is_valid": "valid" if valid else "invalid", "avg_unix": sum(unix[i] for i in members) // len(members),
                "sd_lat": statistics.stdev(lats) if valid else 0.0, "avg_lat": statistics.fmean(lats),
            }
        )
    return out


@pytest.fixture(scope="module")
def ships():
    rnd = random.Random(11)
    out, n = {}, 0
    sizes = [1, 2, 3, 10, 11, 20, 21, 900] + [rnd.randint(1, 80) for _ in range(40)]
    for ship, size in enumerate(sizes):
        kind = rnd.choice(["Tanker", "passenger", None])
        out[ship] = walk(rnd, ship, size, kind, n)
        n += size
    # One ship that never moves: a single event over every slice.
    out[500] = [(*r[:12], 0.2, *r[13:16], cell(0, 0)) for r in walk(rnd, 500, 300, "Tanker", n)]
    return out


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("seconds", [600, 5400, 10**9])
def test_events_equal_plain_loop(spark, ships, compat, seconds):
    df = spark.createDataFrame([r for rows in ships.values() for r in rows], SCHEMA).repartition(3)
    got = stops.stop_events(df, 10, ["event_id"], compat=compat, slice_seconds=seconds).collect()
    want = [e for rows in ships.values() for e in brute(rows, compat)]
    key = lambda e: (e["mmsi"], e["unix_trigger"])
    got = sorted((r.asDict() for r in got), key=key)
    want.sort(key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for name, value in w.items():
            assert g[name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (name, w)


def test_lower_never_exceeds_upper(spark, ships):
    df = spark.createDataFrame([r for rows in ships.values() for r in rows], SCHEMA)
    assert stops.stop_events(df, 10, ["event_id"], slice_seconds=3600).filter("time_lower > time_upper").count() == 0


def test_small_arrow_batches_split_groups(spark, ships):
    df = spark.createDataFrame([r for rows in ships.values() for r in rows], SCHEMA)
    whole = stops.stop_events(df, 10, ["event_id"], slice_seconds=10**9).select("mmsi", "unix_trigger", "obs_count")
    expected = sorted(map(tuple, whole.collect()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, whole.select("*").collect())) == expected
        sliced = stops.stop_events(df, 10, ["event_id"], slice_seconds=3600).select("mmsi", "unix_trigger", "obs_count")
        assert sorted(map(tuple, sliced.collect())) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_no_slow_ping_gives_no_events(spark, ships):
    df = spark.createDataFrame(ships[7], SCHEMA).withColumn("sog", F.lit(9.0))
    assert stops.stop_events(df, 10, ["event_id"], slice_seconds=3600).count() == 0


def test_arguments(spark, ships):
    df = spark.createDataFrame(ships[7], SCHEMA)
    with pytest.raises(ValueError):
        stops.stop_events(df, 10, geometry="circle")
    with pytest.raises(ValueError):
        stops.stop_events(df, 9)


def test_profiles_count_from_the_minimum(spark, ships):
    df = spark.createDataFrame(ships[7], SCHEMA)
    rows = stops.stop_event_profiles(df, 4, 10, ["event_id"], slice_seconds=3600).collect()
    assert rows and len(rows[0]) == 34
    for r in rows:
        assert (r.is_valid == "valid") == (r.obs_count >= 4)
        assert (r.wkt_sd_box == "POLYGON EMPTY") == (r.obs_count < 4)


def test_ties_do_not_depend_on_partitioning_or_slices(spark):
    rnd = random.Random(11)
    rows = [r for ship in range(12) for r in walk(rnd, ship, 90, "Tanker", ship * 1000)]
    at = [f.split()[0] for f in SCHEMA.split(", ")].index("dt_pos_utc")
    rows = [(*r[:at], r[at].replace(minute=0, second=0, microsecond=0), *r[at + 1 :]) for r in rows]
    results = []
    for seconds, parts in ((3600, 1), (6 * 3600, 5), (10**7, 3)):
        rnd.shuffle(rows)
        got = stops.stop_events(spark.createDataFrame(rows, SCHEMA).repartition(parts), slice_seconds=seconds)
        results.append(sorted(map(str, got.drop("avg_lat", "avg_lng", "sd_lat", "sd_lng", "geom_wkt", "wkt_avg_pt").collect())))
    assert results[0] and results[0] == results[1] == results[2]


def test_foreign_cells_raise(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame(walk(rnd, 1, 20, "Tanker", 0), SCHEMA).withColumn("H3_int_index_10", F.lit(621922022744817663))
    with pytest.raises(Exception, match="another grid"):
        stops.stop_events(df).collect()


def test_short_slices_are_run_side_by_side(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from fairlead.operators import slices

    def alone(*_):
        raise AssertionError("a slice of a few pings was run by itself")

    monkeypatch.setattr(slices, "_Slice", alone)
    rnd = random.Random(11)
    groups = [walk(rnd, ship, rnd.randrange(1, 9), "Tanker", 0, speed_missing=False) for ship in range(40)]
    rows = [r for g in groups for r in g]
    ship, zero = np.array([r[1] for r in rows]), np.zeros(len(rows), np.int64)
    cells, slow = [r[16] for r in rows], [r[12] < 1 for r in rows]
    batch = pa.record_batch(
        [pa.array(ship), pa.array(zero), pa.array(cells), pa.array(slow), pa.array(zero), pa.array(["k"] * len(rows)), pa.array([r[2] for r in rows], pa.int64())],
        names=["mmsi", "_slice", "_cell", "_slow", "cluster_time", "vessel_type", "imo"],
    )
    summary = [s for b in slices.summarise(grid.ring_offsets(3), 3)(iter([batch])) for s in b.to_pylist()]

    def left_open(group, entered):
        """Position of the event still open after the pings, -1 for none, -2 for that of the entry."""
        at, anchor = (-2, entered) if entered is not None else (-1, None)
        for i, r in enumerate(group):
            if at != -1:
                at, anchor = (at, anchor) if reach(r[16], anchor) else (-1, None)
            elif r[12] < 1:
                at, anchor = i, r[16]
        return at

    assert len(summary) == len(groups)
    for got, group in zip(summary, groups):
        first = group[0][16]
        far = left_open(group, first + (40 << 26))
        anchors = [first + (dq << 26) + dr for dq, dr in grid.ring_offsets(3)]
        ends = {a: left_open(group, a) for a in anchors}
        assert got["none_pos"] == left_open(group, None) and got["far_pos"] == far
        assert got["stays"] == [a for a in anchors if ends[a] == -2]
        assert dict(zip(got["other"], got["other_pos"])) == {a: e for a, e in ends.items() if e not in (-2, far)}
        assert got["_imo"] == next((r[2] for r in group if r[2] is not None), None)


def test_recap_of_counted_stops_is_that_of_the_events(spark):
    from fairlead.operators import joins, reports

    rnd = random.Random(12)
    rows = [
        (i, rnd.randrange(4) if rnd.random() < 0.9 else None, START + dt.timedelta(hours=rnd.randrange(24 * 20)) if rnd.random() < 0.95 else None,
         rnd.choice([1, 2, 3, None]), rnd.choice([1, 2, 3]))
        for i in range(4000)
    ]
    events = spark.createDataFrame(rows, "mmsi long, h3_index_int long, obs_time timestamp, state_initial int, state_final int")
    cells = spark.createDataFrame([(f"K{k}", c) for k in range(30) for c in range(4) if (k + c) % 3], "Kode string, h3_ids_int long")
    counted = reports.counted_stops(events)
    assert counted.count() < 2000 and counted.agg(F.sum("events")).first()[0] == len(rows)
    for kind in ("arrival", "departed"):
        for period in ({}, {"month_obs": 1}, {"port_code": "K7", "year_obs": 2024, "date_obs": 9}):
            want = reports.recap_stops(joins.events_in_ports(events, cells), kind, **period)
            got = reports.recap_stops(joins.events_in_ports(counted, cells), kind, events="events", **period)
            assert got.dtypes == want.dtypes and want.count()
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
