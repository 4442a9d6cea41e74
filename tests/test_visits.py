"""Visit detection on hand-built sequences and against brute force."""

import datetime as dt
import random

import pytest

from fairlead.operators import joins, reports, visits, zones

START = dt.datetime(2024, 1, 1)
FIELDS = (
    "mmsi long, vessel_name string, Prov_ID string, Kode string, Hirarki_1 string, dt_pos_utc timestamp_ntz, "
    "flag_country string, GroupBeneficialOwnerCountryofDomicile string, GroupBeneficialOwnerCountryOfRegistration string, "
    "RegisteredOwnerCountryofDomicile string, vessel_type string, vessel_type_main string, vessel_type_sub string, "
    "nav_status string, draught double, sog double, latitude double, longitude double, H3_int_index_8 long, h3_ids_int long"
)


def tagged(spark, ships, step=600):
    """ships: {mmsi: "..A" text}, a dot is an outside ping, a letter a port."""
    rows = []
    for mmsi, text in ships.items():
        for i, c in enumerate(text):
            port = None if c == "." else c
            rows.append(
                (mmsi, "n", "p", port, "h", START + dt.timedelta(seconds=i * step), "Indonesia", "Indonesia", None, None,
                 "t", "m", "s", "nav", 1.0, 1.0, 0.0, float(i), i, None if port is None else 1)
            )
    return spark.createDataFrame(rows, FIELDS)


def kept(rows, mmsi=1):
    return [(int(r.longitude), r.Port or ".") for r in sorted(rows, key=lambda r: (r.mmsi, r.dt_pos_utc)) if r.mmsi == mmsi]


def brute_two_passes(text):
    rows = [(i, c, c != ".") for i, c in enumerate(text)]
    if not any(inside for _, _, inside in rows):
        return []
    for _ in range(2):
        keep = []
        for k, row in enumerate(rows):
            if k in (0, len(rows) - 1) or (rows[k - 1][2] != row[2]) != (rows[k + 1][2] != row[2]):
                keep.append(row)
        rows = keep
    return [(i, c) for i, c, _ in rows]


@pytest.mark.parametrize("text", ["..A..", "AA.AA", "..AAA..", "AAAA", "A", "....", ".AABB.", "AAA...BBB", ".A.A.A."])
def test_two_passes(spark, text):
    rows = visits.edge_rows(visits.visit_pings(tagged(spark, {1: text})), slice_seconds=1800).collect()
    assert kept(rows) == brute_two_passes(text)


def test_random_sequences(spark):
    rnd = random.Random(4)
    ships = {m: "".join(rnd.choice("..AAB") for _ in range(rnd.randint(1, 60))) for m in range(40)}
    ships[99] = "".join(rnd.choice("..AAAAB") for _ in range(1500))
    rows = visits.edge_rows(visits.visit_pings(tagged(spark, ships)), slice_seconds=3600).collect()
    for m, text in ships.items():
        assert kept(rows, m) == brute_two_passes(text), (m, text)


def test_marks_and_time(spark):
    rows = sorted(visits.port_visits(tagged(spark, {1: "..AAA.."}), slice_seconds=900).collect(), key=lambda r: r.dt_pos_utc)
    assert [(r.masuk_pelabuhan, r.keluar_pelabuhan, r.time) for r in rows] == [
        ("-", "-", 600), ("masuk", "-", 600), ("masuk", "-", 1200), ("-", "keluar", 600), ("-", "keluar", 600), ("-", "-", None)
    ]


def brute_change(text):
    """Closed form of the port-change variant, written row by row."""
    rows = brute_two_passes(text)

    def at(i, rs):
        return rs[i][1] if 0 <= i < len(rs) else None

    keep = []
    for k, (i, c) in enumerate(rows):
        p, n = at(k - 1, rows), at(k + 1, rows)
        if c == "." or p != c or p == "." or n == "." or (n is not None and n != c):
            keep.append((i, c))
    out = []
    for k, (i, c) in enumerate(keep):
        p, n = at(k - 1, keep), at(k + 1, keep)
        if c == ".":
            marks = (n not in (None, "."), p not in (None, "."))
        else:
            marks = (p is not None and p != c, n is not None and n != c)
        out.append((i, c, *marks))
    return out


def test_port_change_variant(spark):
    rnd = random.Random(8)
    ships = {1: ".AABB.", 2: "AABBCC", 3: "..AAAA.."}
    ships.update({m: "".join(rnd.choice(".AAABBC") for _ in range(rnd.randint(1, 40))) for m in range(10, 40)})
    rows = visits.port_visits_by_port_change(tagged(spark, ships), slice_seconds=3600).collect()
    for m, text in ships.items():
        got = [
            (int(r.longitude), r.Port or ".", r.masuk_pelabuhan == "masuk", r.keluar_pelabuhan == "keluar")
            for r in sorted((r for r in rows if r.mmsi == m), key=lambda r: r.dt_pos_utc)
        ]
        assert got == brute_change(text), (m, text)


def test_minimum_stay_is_inclusive(spark):
    act = visits.port_visits(tagged(spark, {1: ".AA.", 2: ".AAAA."}, step=600), slice_seconds=900)
    assert {r.mmsi for r in visits.arrivals(act, 10).collect()} == {1, 2}
    assert {r.mmsi for r in visits.arrivals(act, 11).collect()} == {2}
    assert {(r.mmsi, r.Port) for r in visits.departures(act, 10, slice_seconds=900).collect()} == {(1, "A"), (2, "A")}
    assert {r.mmsi for r in visits.departures(act, 31, slice_seconds=900).collect()} == set()


def test_exact_duplicates_are_dropped(spark):
    once = tagged(spark, {1: "..AAA.."})
    assert visits.port_visits(once.union(once), slice_seconds=900).count() == visits.port_visits(once, slice_seconds=900).count()


def test_unknown_activity_and_missing_flag(spark):
    act = visits.port_visits(tagged(spark, {1: "..AAA.."}), slice_seconds=900)
    with pytest.raises(ValueError):
        visits.movements(act, "landing")
    with pytest.raises(ValueError):
        reports.vessel_list(act, True)
    with pytest.raises(ValueError):
        reports.summarize_time_in_port(act, ["Port"], "other")
    with pytest.raises(ValueError):
        joins.tag_ports(act.drop("H3_int_index_8"), act)


def test_flag_is_false_for_unknown_ships_and_types_do_not_duplicate(spark):
    act = visits.port_visits(tagged(spark, {1: "..AAA..", 2: "..AAA.."}), slice_seconds=900)
    pings = spark.createDataFrame(
        [(1, START, "x", True), (1, START + dt.timedelta(1), "y", True)],
        "mmsi long, dt_pos_utc timestamp_ntz, vessel_type string, z boolean",
    )
    flagged = zones.flag_activity(act, zones.zone_history(pings, "z"))
    assert flagged.count() == act.count()
    assert {(r.mmsi, r.is_through_hormuz) for r in flagged.collect()} == {(1, True), (2, False)}


def test_port_variants(spark):
    t = tagged(spark, {1: "..AAA.."}).withColumnsRenamed({"Prov_ID": "kd_prov", "Hirarki_1": "kode_hirar", "Kode": "kode"})
    assert {"Prov_ID", "Hirarki_1", "Port"} <= set(visits.port_visits(t, slice_seconds=900).columns)


@pytest.mark.parametrize("name", ["port_visits", "departure_recap", "port_visits_by_port_change"])
def test_visit_queries_read_the_pings_twice_at_most(spark, name):
    from queries.catalog import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("Relation [event_id") <= 2


def test_visits_are_the_same_from_the_outer_ports_of_a_cell(spark):
    rnd = random.Random(12)
    cells = [(c, rnd.choice(["A", "B", "C", "D", "E", None]), f"p{rnd.randrange(3)}", f"h{rnd.randrange(3)}") for c in range(8) for _ in range(9)]
    ports = spark.createDataFrame(cells, "h3_ids_int long, Kode string, Prov_ID string, Hirarki_1 string").distinct().cache()
    outer = visits.outer_ports(ports)
    assert outer.columns == ports.columns
    assert outer.filter("Kode is not null").groupBy("h3_ids_int").count().agg({"count": "max"}).first()[0] == 2
    blank = tagged(spark, {}).drop("Prov_ID", "Kode", "Hirarki_1", "h3_ids_int")
    rows = []
    for ship in range(12):
        for _ in range(60):  # few times and many cells without a port, so that pings of one time meet
            at = START + dt.timedelta(seconds=600 * rnd.randrange(40))
            rows.append((ship, "n", at, "Indonesia", "Indonesia", None, None, "t", "m", "s", "nav", 1.0, 1.0, 0.0, 0.0, rnd.randrange(16)))
    pings = spark.createDataFrame(rows, blank.schema).cache()
    for detect in (visits.port_visits, visits.port_visits_by_port_change):
        want, got = (sorted(map(str, detect(joins.tag_ports(pings, p), slice_seconds=7200).collect())) for p in (ports, outer))
        assert got == want and len(got) > 50


def test_boundary_joins_two_ports_a_cell_at_most(spark, monkeypatch):
    from fairlead.functions import grid
    from fairlead.operators import areas
    from fairlead.plans import jobs

    square = "POLYGON ((100 0, 100.1 0, 100.1 0.1, 100 0.1, 100 0))"
    aoi = spark.createDataFrame([(f"P{k:02}", "p", "h", "Cluster", square) for k in range(30)], "Kode string, Prov_ID string, Hirarki_1 string, method string, wkt string")
    seen, tag = [], joins.tag_ports
    monkeypatch.setattr(joins, "tag_ports", lambda pings, cells, *rest: seen.append(cells) or tag(pings, cells, *rest))
    pings = tagged(spark, {1: ".AA."}).drop("Prov_ID", "Kode", "Hirarki_1", "h3_ids_int")
    pings = pings.withColumns({"latitude": pings.latitude + 0.05, "longitude": 99.0 + pings.longitude * (3 - pings.longitude) / 2 + 0.05})
    pings = pings.withColumn("H3_int_index_8", grid.cell_at("latitude", "longitude", 8))
    rows = jobs.boundary(pings, areas.load_wkt(aoi, "wkt"), "Cluster", 8).collect()
    assert [(r.position, r.Port) for r in sorted(rows, key=lambda r: (r.dt_pos_utc, r.Port or ""))] == [("out", None), ("in", "P00"), ("in", "P29"), ("out", None)]
    assert {r.Kode for r in seen[0].collect()} == {"P00", "P29"}
