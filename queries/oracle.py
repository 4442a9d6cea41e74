"""SQL for an independent engine: one statement per registered query, over the same
tables. Written apart from the Spark code: plain windows per ship, brute-force
geometry, cube rounding for cells, and a recursive scan for the stop events."""

from __future__ import annotations

import math

from fairlead.functions.ports import PORT_NAMES, SMALL_PORTS
from fairlead.schemas import PING_COLUMNS, SHIP_ATTRIBUTES
from queries.catalog import FIXES
from queries.fixture import oracle as fixture

ORACLE: dict[str, str] = {}
R = "6378137e0"
SPHERE = "6371007.180918475e0"
S3 = math.sqrt(3.0)
HALF = 1 << 25
MARK = 1 << 62


def edge_length(resolution: int) -> float:
    """Metres of a hexagon's edge at resolution 0, and the shrink per level."""
    return 1107712.591 / 7.0 ** (resolution / 2.0)


def num(x: float) -> str:
    return f"{x:.17e}"


def ctes(*names: str, **more: str) -> str:
    parts = [f"{n} AS ({fixture(n)})" for n in names]
    parts += [f"{n} AS ({text})" for n, text in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def port_name(code: str) -> str:
    pairs = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PORT_NAMES.items())
    return f"CASE {code} {pairs} END"


def home(c: str) -> str:
    return f"CASE WHEN {c} = 'Indonesia' THEN 'Domestic' ELSE 'Foreign' END"


def with_cell(source: str, resolution: int, name: str, lat: str = "latitude", lon: str = "longitude") -> str:
    """Source rows plus a cell column, by cube rounding."""
    s = num(edge_length(resolution))
    return f"""SELECT * EXCLUDE (x_, y_, fq_, fr_, q_, r_, s_),
 CAST({MARK | resolution << 52} AS BIGINT)
 + (CAST(CASE WHEN abs(q_ - fq_) > abs(r_ - fr_) AND abs(q_ - fq_) > abs(s_ + fq_ + fr_) THEN -r_ - s_ ELSE q_ END AS BIGINT) + {HALF}) * {1 << 26}
 + CAST(CASE WHEN abs(q_ - fq_) > abs(r_ - fr_) AND abs(q_ - fq_) > abs(s_ + fq_ + fr_) THEN r_
             WHEN abs(r_ - fr_) > abs(s_ + fq_ + fr_) THEN -q_ - s_ ELSE r_ END AS BIGINT) + {HALF} AS {name}
FROM (SELECT *, floor(fq_ + 0.5e0) AS q_, floor(fr_ + 0.5e0) AS r_, floor(-fq_ - fr_ + 0.5e0) AS s_
 FROM (SELECT *, ({num(S3 / 3)} * x_ - y_ / 3e0) / {s} AS fq_, ({num(2 / 3)} * y_) / {s} AS fr_
  FROM (SELECT *, {R} * radians({lon}) AS x_, {R} * asinh(tan(radians({lat}))) AS y_ FROM ({source}) src_) a_) b_) c_"""


def cell_q(c: str) -> str:
    return f"((({c}) >> 26) % {1 << 26} - {HALF})"


def cell_r(c: str) -> str:
    return f"(({c}) % {1 << 26} - {HALF})"


def centre_lat(c: str, res: int) -> str:
    return f"degrees(atan(sinh({num(1.5 * edge_length(res))} * {cell_r(c)} / {R})))"


def centre_lon(c: str, res: int) -> str:
    return f"degrees({num(S3 * edge_length(res))} * ({cell_q(c)} + {cell_r(c)} / 2e0) / {R})"


def steps(a: str, b: str) -> str:
    dq, dr = f"({cell_q(a)} - {cell_q(b)})", f"({cell_r(a)} - {cell_r(b)})"
    return f"CAST(greatest(abs({dq}), abs({dr}), abs({dq} + {dr})) AS INTEGER)"


def grid_pings(res: int = 8) -> str:
    base = fixture("pings")
    if res == 8:
        base = f"SELECT * EXCLUDE (H3_int_index_8) FROM ({base}) p_"
    return with_cell(base, res, f"H3_int_index_{res}")


RINGS = r"""SELECT * EXCLUDE (parts), unnest(parts) AS ring_text, generate_subscripts(parts, 1) - 1 AS ring FROM (
 SELECT *, string_split_regex(regexp_replace(regexp_replace(wkt, '^[^(]*[( ]+', ''), '[) ]+$', ''), '\)[ ,()]*\(') AS parts FROM aoi) a_"""
VERTICES = """SELECT *, CAST(split_part(pair, ' ', 1) AS DOUBLE) AS lon, CAST(split_part(pair, ' ', 2) AS DOUBLE) AS lat FROM (
 SELECT * EXCLUDE (pairs), trim(unnest(pairs)) AS pair, generate_subscripts(pairs, 1) - 1 AS i FROM (
  SELECT *, string_split(ring_text, ',') AS pairs FROM rings) b_) c_"""
EDGES = """SELECT Kode, x1, y1, x2, y2 FROM (SELECT Kode, lon AS x1, lat AS y1,
 lead(lon) OVER (PARTITION BY Kode, ring ORDER BY i) AS x2, lead(lat) OVER (PARTITION BY Kode, ring ORDER BY i) AS y2 FROM vertices) d_
 WHERE x2 IS NOT NULL"""
OUTLINES = {"rings": RINGS, "vertices": VERTICES, "edges": EDGES}
PARITY = "(e.y1 > {lat}) <> (e.y2 > {lat}) AND {lon} < e.x1 + ({lat} - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1)"


def candidates(res: int, margin_deg: float = 0.0) -> str:
    """Every cell of the lattice rectangle around each area, with its centre."""
    s = edge_length(res)
    m = num(margin_deg)
    return f"""SELECT Kode, CAST({MARK | res << 52} AS BIGINT) + (q + {HALF}) * {1 << 26} + r + {HALF} AS cell,
 degrees(atan(sinh({num(1.5 * s)} * r / {R}))) AS clat, degrees({num(S3 * s)} * (q + r / 2e0) / {R}) AS clon
FROM (SELECT *, unnest(range(CAST(floor(x0 - r / 2e0) AS BIGINT) - 1, CAST(ceil(x1 - r / 2e0) AS BIGINT) + 2)) AS q
FROM (SELECT *, unnest(range(r0, r1 + 1)) AS r FROM (SELECT Kode,
 CAST(floor({R} * asinh(tan(radians(min(y1) - {m}))) / {num(1.5 * s)}) AS BIGINT) - 1 AS r0,
 CAST(ceil({R} * asinh(tan(radians(max(y1) + {m}))) / {num(1.5 * s)}) AS BIGINT) + 1 AS r1,
 {R} * radians(min(x1) - {m}) / {num(S3 * s)} AS x0, {R} * radians(max(x1) + {m}) / {num(S3 * s)} AS x1
FROM edges GROUP BY Kode) a_) b_) c_"""


FILLED = f"""SELECT c.Kode, c.cell FROM cand c JOIN edges e ON c.Kode = e.Kode AND {PARITY.format(lat='c.clat', lon='c.clon')}
GROUP BY c.Kode, c.cell HAVING count(*) % 2 = 1"""


def fill_ctes(res: int) -> dict[str, str]:
    return {**OUTLINES, "cand": candidates(res), "filled": FILLED}


def buffer_ctes(res: int, metres: float, margin_deg: float) -> dict[str, str]:
    """Cells by brute force: inside, or within the distance of any edge."""
    ax, ay = f"radians(x1 - clon) * {SPHERE} * cos(radians(clat))", f"radians(y1 - clat) * {SPHERE}"
    dx, dy = f"radians(x2 - x1) * {SPHERE} * cos(radians(clat))", f"radians(y2 - y1) * {SPHERE}"
    return {
        **OUTLINES,
        "cand": candidates(res, margin_deg),
        "filled": FILLED,
        "near": f"""SELECT DISTINCT cell FROM (SELECT cell, ax, ay, dx, dy, greatest(0e0, least(1e0, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) AS t
 FROM (SELECT c.cell, {ax} AS ax, {ay} AS ay, {dx} AS dx, {dy} AS dy FROM cand c JOIN edges e ON c.Kode = e.Kode) a_) b_
 WHERE sqrt((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy)) <= {num(metres)}""",
        "buffered": "SELECT cell AS boundary_h3 FROM filled UNION SELECT cell FROM near",
    }


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ---- scans and sinks -----------------------------------------------------------
add("parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1997-01-01'")
add("csv_scan_complete", ctes("register") + "SELECT * FROM register WHERE ShiptypeLevel5 <> 'HOUSEHOLD'")
add("register_csv_scan", ctes("register") + "SELECT * FROM register")
IN_PERIOD = "dt_pos_utc >= '2024-01-05' AND dt_pos_utc < '2024-01-21'"
SHORT = "dt_pos_utc >= '2024-01-05' AND dt_pos_utc < '2024-01-10'"
add("region_scan", ctes("pings", "zone_cells") + f"""SELECT event_id, mmsi, H3_int_index_8 FROM pings
WHERE {IN_PERIOD} AND H3_int_index_8 IN (SELECT cell FROM zone_cells WHERE zone = 'strait')""")
add("ship_scan", ctes("pings") + f"""SELECT event_id, mmsi FROM pings
WHERE {IN_PERIOD} AND mmsi IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
add("region_then_ship_scan", ctes("pings", "zone_cells") + f"""SELECT event_id, mmsi FROM pings WHERE {SHORT} AND mmsi IN (
SELECT mmsi FROM pings WHERE {SHORT} AND H3_int_index_8 IN (SELECT cell FROM zone_cells WHERE zone = 'strait'))""")
add("ingest", ctes("aoi", pings=grid_pings(), **fill_ctes(8)) + f"""SELECT event_id, mmsi FROM pings WHERE {SHORT} AND mmsi IN (
SELECT mmsi FROM pings WHERE {SHORT} AND H3_int_index_8 IN (SELECT f.cell FROM filled f JOIN aoi USING (Kode) WHERE TERRITORY1 = 'ASIA'))""")
add("ingest_clustered", ORACLE["ingest"])
add("distinct_ships", "SELECT DISTINCT user_id AS mmsi FROM events")
add("areas_by_method", ctes("aoi", rings=RINGS) + "SELECT Kode, CAST(count(*) AS INTEGER) AS rings FROM rings WHERE method = 'Cluster' GROUP BY Kode")
add("parquet_sink", ctes("pings") + "SELECT event_id, mmsi, sog, CAST(dt_pos_utc AS DATE) AS day FROM pings")
add("accumulate_periods", ctes("pings") + """SELECT event_id, mmsi, dt_pos_utc,
CASE WHEN dt_pos_utc < '2024-01-16' THEN 'first' ELSE 'second' END AS period FROM pings WHERE dt_pos_utc < '2024-02-01' """)
add("stored_cells", ctes("aoi", **fill_ctes(9)) + "SELECT DISTINCT cell FROM filled")

# ---- projections, filters, labels ----------------------------------------------
add("distinct_rows", ctes("pings") + "SELECT DISTINCT mmsi, site, nav_status, sog FROM pings")
add("keep_listed_columns", ctes("pings") + "SELECT event_id, sog FROM pings")
add("drop_listed_columns", ctes("pings") + "SELECT event_id, draught, site FROM pings")
add("register_conflicts", ctes("register") + "SELECT MaritimeMobileServiceIdentityMMSINumber, flag_country AS ihs_flag_country FROM register")
MATCH = """SELECT p.event_id, p.mmsi, CAST(CASE WHEN m.n IS NOT NULL AND m.imo_no = p.imo THEN 1 WHEN m.n IS NOT NULL THEN 2 WHEN i.n IS NOT NULL THEN 3
 WHEN v.n IS NOT NULL THEN 4 ELSE 9 END AS INTEGER) AS ihs_matchtype, coalesce(m.ShipName, i.ShipName, v.ShipName) AS ShipName,
 p.* EXCLUDE (event_id, mmsi)
FROM pings p
LEFT JOIN (SELECT MaritimeMobileServiceIdentityMMSINumber AS n, LRIMOShipNo AS imo_no, ShipName FROM register) m ON p.mmsi = m.n AND m.n <> 0
LEFT JOIN (SELECT LRIMOShipNo AS n, ShipName FROM register) i ON p.imo = i.n
LEFT JOIN (SELECT ShipName AS n, ShipName FROM register) v ON p.vessel_name = v.n"""
add("register_match", ctes("pings", "register", matched=MATCH) + "SELECT event_id, mmsi, ihs_matchtype, ShipName FROM matched")
add("matched_pings", ctes("pings", "register", matched=MATCH) + "SELECT event_id, mmsi, ihs_matchtype, ShipName FROM matched WHERE ihs_matchtype <> 9")


def fixed(column: str, index: int) -> str:
    last = {f[0]: f[index] for f in FIXES if f[index]}
    return f"CASE vessel_name {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in last.items())} ELSE {column} END AS {column}"


add("type_overrides", ctes("pings") + f"SELECT event_id, vessel_name, {fixed('vessel_type_main', 1)}, {fixed('vessel_type_sub', 2)} FROM pings")
add("box_filter", ctes("pings") + """SELECT event_id, longitude AS x, latitude AS y FROM pings
WHERE longitude > 103e0 AND latitude > -3e0 AND longitude < 112.01e0 AND latitude < 3.01e0""")
add("port_position", ctes("pings", "aoi_cells") + """SELECT event_id, Kode, CASE WHEN h3_ids_int IS NULL THEN 'out' ELSE 'in' END AS position
FROM pings LEFT JOIN aoi_cells ON H3_int_index_8 = h3_ids_int""")
add("owner_tags", ctes("pings") + f"""SELECT event_id, {home('GroupBeneficialOwnerCountryofDomicile')} AS status_country_domicile,
{home('GroupBeneficialOwnerCountryOfRegistration')} AS status_country_register, {home('flag_country')} AS status_country_flag FROM pings""")
add("report_period", ctes("pings") + """SELECT event_id, destination FROM pings WHERE destination = 'P3'
AND dt_pos_utc >= '2024-01-12' AND dt_pos_utc < '2024-01-13'""")
add("small_ports_left_out", ctes("pings") + f"SELECT event_id, 'BLW' AS Kode FROM pings WHERE site >= {len(SMALL_PORTS)}")
UNIX = "CAST(floor(epoch({})) AS BIGINT)"
add("unix_time", ctes("pings") + f"SELECT event_id, {UNIX.format('dt_pos_utc')} AS cluster_time FROM pings")
add("calendar_fields", ctes("pings") + f"""SELECT event_id, strftime(dt_pos_utc, '%Y-%m-%d') AS date_text, CAST(dt_pos_utc AS DATE) AS date,
CAST(year(dt_pos_utc) AS INTEGER) AS year, CAST(month(dt_pos_utc) AS INTEGER) AS month, CAST(day(dt_pos_utc) AS INTEGER) AS day,
{UNIX.format('dt_pos_utc')} AS stamp_unix FROM pings""")
add("port_names", ctes("pings", coded="""SELECT event_id, CASE mmsi % 7 WHEN 0 THEN 'BLW' WHEN 1 THEN 'NAM' WHEN 2 THEN 'LQA' WHEN 3 THEN 'ZZZ'
WHEN 4 THEN 'BIT' WHEN 5 THEN 'TTK' ELSE 'CLG' END AS code FROM pings""") + f"SELECT event_id, code, {port_name('code')} AS nama_pelabuhan FROM coded")
add("country_text", ctes("pings", "port_cells") + "SELECT event_id, Country AS country, nav_status AS plain FROM pings JOIN port_cells ON H3_int_index_8 = boundary_h3")
SHIP = "OVER (PARTITION BY mmsi ORDER BY dt_pos_utc, event_id)"
add("stay_estimates", ctes("pings", timed=f"""SELECT event_id, u, lag(u) OVER w AS t1, lead(u) OVER w AS t3, lead(u, 2) OVER w AS t4
FROM (SELECT *, {UNIX.format('dt_pos_utc')} AS u FROM pings) a_ WINDOW w AS (PARTITION BY mmsi ORDER BY dt_pos_utc, event_id)""") + """
SELECT event_id, CAST(round_even((t3 - u) / 3600e0, 0) AS INTEGER) AS time_lower, CAST(round_even((t4 - t1) / 3600e0, 0) AS INTEGER) AS time_upper FROM timed""")
add("observation_thresholds", ctes("pings") + """SELECT event_id, CASE WHEN vessel_type = 'Passenger' THEN 2 ELSE 10 END AS event_min,
CASE WHEN vessel_type = 'Passenger' THEN 2 ELSE 20 END AS ship_min FROM pings""")

# ---- joins ---------------------------------------------------------------------
add("pings_in_ports", ctes("pings", "port_cells") + "SELECT event_id, mmsi, Port_Country, boundary_h3 FROM pings JOIN port_cells ON H3_int_index_8 = boundary_h3")
BUFFER = buffer_ctes(8, 10000.0, 0.1)
add("buffer_tag", ctes("aoi", pings=grid_pings(), **BUFFER) + "SELECT event_id, boundary_h3 FROM pings LEFT JOIN buffered ON H3_int_index_8 = boundary_h3")
add("keep_in_buffer", ctes("aoi", pings=grid_pings(), **BUFFER) + "SELECT event_id, boundary_h3 FROM pings JOIN buffered ON H3_int_index_8 = boundary_h3")
add("buffer_run_tag", ctes("aoi", pings=grid_pings(), **BUFFER) + "SELECT event_id, boundary_h3 IS NOT NULL AS in_buffer FROM pings LEFT JOIN buffered ON H3_int_index_8 = boundary_h3")
add("keep_in_runs", ctes("aoi", pings=grid_pings(), **BUFFER) + "SELECT event_id, H3_int_index_8 FROM pings JOIN buffered ON H3_int_index_8 = boundary_h3")
TAGGED = """SELECT p.*, EXISTS (SELECT 1 FROM zone_cells z WHERE z.zone = 'strait' AND z.cell = p.H3_int_index_8) AS is_hormuz,
EXISTS (SELECT 1 FROM zone_cells z WHERE z.zone = 'home' AND z.cell = p.H3_int_index_8) AS is_indo FROM pings p"""
ZONED = ctes("pings", "zone_cells", tagged=TAGGED)
add("zone_flags", ZONED + "SELECT event_id, is_hormuz, is_indo FROM tagged")
VISIT_ROWS = """SELECT DISTINCT mmsi, vessel_name, Prov_ID, Kode AS Port, Hirarki_1, dt_pos_utc, flag_country AS fc_vessel,
GroupBeneficialOwnerCountryofDomicile, GroupBeneficialOwnerCountryOfRegistration, RegisteredOwnerCountryofDomicile,
vessel_type, vessel_type_main, vessel_type_sub, nav_status AS ns_vessel, draught, sog,
CASE WHEN h3_ids_int IS NULL THEN 'out' ELSE 'in' END AS position, latitude, longitude, H3_int_index_8
FROM pings LEFT JOIN aoi_cells ON H3_int_index_8 = h3_ids_int"""
SEEN = "SELECT * FROM visit_rows WHERE mmsi IN (SELECT mmsi FROM visit_rows WHERE position = 'in')"
add("ships_seen_in_port", ctes("pings", "aoi_cells", visit_rows=VISIT_ROWS, seen=SEEN) + "SELECT mmsi, dt_pos_utc, position FROM seen")
add("keyed_join_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
_WITH_REGISTER = "pings LEFT JOIN register ON mmsi = MaritimeMobileServiceIdentityMMSINumber"
add("keyed_join_left_all", ctes("pings", "register") + f"SELECT event_id, ShipName FROM {_WITH_REGISTER}")
add("keyed_join_left_nulls", ctes("pings", "register") + f"""SELECT event_id, MaritimeMobileServiceIdentityMMSINumber, ShipName FROM {_WITH_REGISTER}
WHERE MaritimeMobileServiceIdentityMMSINumber IS NULL""")
add("pings_with_register", ctes("pings", "register") + """SELECT event_id, ShipStatus, ShipName, ShiptypeLevel5, pings.flag_country
FROM register JOIN pings ON MaritimeMobileServiceIdentityMMSINumber = mmsi""")
add("pings_without_register", ctes("pings", "register") + """SELECT event_id, mmsi FROM pings
WHERE mmsi NOT IN (SELECT MaritimeMobileServiceIdentityMMSINumber FROM register)""")
add("points_in_areas", ctes("pings", "aoi", **OUTLINES, boxes="SELECT Kode, min(x1) AS xa, max(x1) AS xb, min(y1) AS ya, max(y1) AS yb FROM edges GROUP BY Kode",
 near="SELECT event_id, longitude, latitude, Kode FROM pings JOIN boxes ON longitude BETWEEN xa - 1e-9 AND xb + 1e-9 AND latitude BETWEEN ya - 1e-9 AND yb + 1e-9",
 judged=f"""SELECT n.Kode, n.event_id,
 count(*) FILTER (WHERE {PARITY.format(lat='n.latitude', lon='n.longitude')}) % 2 = 1 AS inside,
 bool_or(abs((e.x2 - e.x1) * (n.latitude - e.y1) - (e.y2 - e.y1) * (n.longitude - e.x1)) <= 1e-12 * (abs(e.x2 - e.x1) + abs(e.y2 - e.y1))
   AND n.longitude BETWEEN least(e.x1, e.x2) - 1e-12 AND greatest(e.x1, e.x2) + 1e-12
   AND n.latitude BETWEEN least(e.y1, e.y2) - 1e-12 AND greatest(e.y1, e.y2) + 1e-12) AS touching
 FROM near n JOIN edges e ON n.Kode = e.Kode GROUP BY n.Kode, n.event_id""") + "SELECT Kode, Prov_ID, event_id FROM judged JOIN aoi USING (Kode) WHERE inside OR touching")
add("ship_type_port_combinations", ctes("pings", "register", "port_cells") + """SELECT DISTINCT mmsi, ShipName, ShiptypeLevel5, Port AS port_name
FROM pings JOIN register ON mmsi = MaritimeMobileServiceIdentityMMSINumber JOIN port_cells ON H3_int_index_8 = boundary_h3""")

# ---- cleaning ------------------------------------------------------------------
add("enough_pings", ctes("pings") + "SELECT event_id, mmsi FROM pings QUALIFY count(*) OVER (PARTITION BY mmsi) >= 65")
add("active_ships", ctes("pings") + """SELECT event_id, mmsi FROM pings QUALIFY count(*) OVER (PARTITION BY mmsi) >= 10
AND count(*) FILTER (WHERE sog > 3) OVER (PARTITION BY mmsi) NOT BETWEEN 1 AND 19""")
_CLEAN = ", ".join(
    {"vessel_type_main": fixed("vessel_type_main", 1), "vessel_type_sub": fixed("vessel_type_sub", 2)}.get(c, c) for c in PING_COLUMNS
)
add("preprocess", ctes("pings", "register", matched=MATCH) + f"""SELECT {_CLEAN} FROM matched WHERE ihs_matchtype <> 9
AND mmsi IN (SELECT mmsi FROM matched WHERE ihs_matchtype <> 9 GROUP BY mmsi HAVING count(*) >= 10 AND count(*) FILTER (WHERE sog > 3) NOT BETWEEN 1 AND 19)""")

# ---- voyages -------------------------------------------------------------------
_CALL_ORDER = "PARTITION BY mmsi ORDER BY dt_pos_utc, event_id, Port_Country"
CALLS = f"""SELECT * FROM (SELECT *, lag(Port_Country) OVER ({_CALL_ORDER}) AS before_ FROM at_port) a_ WHERE before_ IS DISTINCT FROM Port_Country"""
LEGS = f"""SELECT mmsi, dt_pos_utc, vessel_type, Port_Country_Origin, Port_Country_Destination, lat_origin, lon_origin, lat_destination, lon_destination,
 Country_Origin, Country_Destination FROM (
 SELECT *, Port_Country AS Port_Country_Origin, lat AS lat_origin, lon AS lon_origin, Country AS Country_Origin,
 lead(Port_Country) OVER w AS Port_Country_Destination, lead(lat) OVER w AS lat_destination, lead(lon) OVER w AS lon_destination,
 lead(Country) OVER w AS Country_Destination FROM calls WINDOW w AS ({_CALL_ORDER})) b_ WHERE Port_Country_Destination IS NOT NULL"""
SIMPLE = ctes("pings", "port_cells", at_port="SELECT * FROM pings JOIN port_cells ON H3_int_index_8 = boundary_h3", calls=CALLS, legs=LEGS)
AREA_PORTS = f"""SELECT Kode AS Port, Country, cell AS boundary_h3, concat(Kode, ' - ', Country) AS Port_Country,
 {centre_lat('cell', 8)} AS lat, {centre_lon('cell', 8)} AS lon FROM filled JOIN aoi USING (Kode)"""
AREA_LEGS = ctes("aoi", pings=grid_pings(), **fill_ctes(8), ports=AREA_PORTS,
                 at_port="SELECT * FROM pings JOIN ports ON H3_int_index_8 = boundary_h3", calls=CALLS, legs=LEGS)
add("port_traffic_all", AREA_LEGS + """
SELECT Port_Country_Origin, Port_Country_Destination, round(lat_origin, 6) AS lat_origin, round(lon_origin, 6) AS lon_origin,
round(lat_destination, 6) AS lat_destination, round(lon_destination, 6) AS lon_destination, vessel_type, CAST(dt_pos_utc AS DATE) AS date, count(*) AS count
FROM legs WHERE Country_Destination <> Country_Origin AND (Country_Destination = 'Indonesia' OR Country_Origin = 'Indonesia')
GROUP BY ALL""")
INBOUND = "Country_Origin <> 'Indonesia' AND Country_Destination = 'Indonesia'"
OUTBOUND = "Country_Origin = 'Indonesia' AND Country_Destination <> 'Indonesia'"
for _name, _rule in (("inbound", INBOUND), ("outbound", OUTBOUND)):
    for _kind, _legs in (("", SIMPLE), ("_written", AREA_LEGS)):
        add(f"port_traffic_{_name}{_kind}", _legs + f"""SELECT Port_Country_Origin, Port_Country_Destination, vessel_type, CAST(dt_pos_utc AS DATE) AS date, count(*) AS count
FROM (SELECT * FROM legs WHERE {_rule} QUALIFY rank() OVER (PARTITION BY mmsi ORDER BY dt_pos_utc) = 1) f_ GROUP BY ALL""")
add("port_call_runs", SIMPLE + "SELECT mmsi, dt_pos_utc, Port_Country FROM calls")
add("ships_with_several_calls", SIMPLE + "SELECT mmsi, dt_pos_utc, Port_Country FROM calls QUALIFY count(*) OVER (PARTITION BY mmsi) > 1")
add("voyage_legs", SIMPLE + """SELECT mmsi, dt_pos_utc, Port_Country_Origin, Port_Country_Destination, lat_destination, lon_destination,
Country_Origin, Country_Destination FROM legs""")
add("home_routes", SIMPLE + """SELECT mmsi, dt_pos_utc, Country_Origin, Country_Destination FROM legs
WHERE Country_Origin <> Country_Destination AND 'Indonesia' IN (Country_Origin, Country_Destination)""")
add("first_inbound_legs", SIMPLE + f"""SELECT mmsi, dt_pos_utc, Port_Country_Origin, Port_Country_Destination FROM legs WHERE {INBOUND}
QUALIFY rank() OVER (PARTITION BY mmsi ORDER BY dt_pos_utc) = 1""")
add("port_list_union", ctes("aoi", **fill_ctes(8), ports=AREA_PORTS) + "SELECT Port, Country, boundary_h3, Port_Country, round(lat, 6) AS lat, round(lon, 6) AS lon FROM ports")

# ---- zones ---------------------------------------------------------------------
add("first_last_in_zone", ZONED + """SELECT mmsi, vessel_type, min(dt_pos_utc) AS first_detected_hormuz, max(dt_pos_utc) AS last_detected_hormuz
FROM tagged WHERE is_hormuz GROUP BY mmsi, vessel_type""")
add("ever_in_zone", ZONED + "SELECT mmsi, bool_or(is_hormuz) AS is_through_hormuz FROM tagged GROUP BY mmsi")
CHANGES = f"""SELECT mmsi, dt_pos_utc, coalesce(lag(is_hormuz) {SHIP} AND NOT is_hormuz, false) AS zone_exit,
coalesce(NOT lag(is_indo) {SHIP} AND is_indo, false) AS zone_entry FROM tagged"""
EDGE_CTES = ctes("pings", "zone_cells", tagged=TAGGED, changes=CHANGES)
add("zone_edges", EDGE_CTES + "SELECT * FROM changes WHERE zone_exit OR zone_entry")
add("time_travel", ctes("pings", "zone_cells", tagged=TAGGED, changes=CHANGES,
 entries="SELECT mmsi, min(dt_pos_utc) AS t_indo FROM changes WHERE zone_entry GROUP BY mmsi",
 exits="SELECT c.mmsi, max(dt_pos_utc) AS t_hormuz FROM changes c JOIN entries e ON c.mmsi = e.mmsi WHERE zone_exit AND dt_pos_utc < t_indo GROUP BY c.mmsi",
 facts="SELECT mmsi, vessel_type, flag_country, draught FROM pings QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY dt_pos_utc, event_id) = 1") + f"""
SELECT mmsi, vessel_type, flag_country, round(draught, 9) AS draught, t_hormuz, t_indo,
round(({UNIX.format('t_indo')} - {UNIX.format('t_hormuz')}) / 3600e0, 9) AS travel_time_hours
FROM exits JOIN entries USING (mmsi) JOIN facts USING (mmsi) WHERE t_indo > t_hormuz""")

# ---- visits --------------------------------------------------------------------
VISIT_WINDOW = "WINDOW w AS (PARTITION BY mmsi ORDER BY dt_pos_utc, Port NULLS FIRST)"


def one_pass(source: str) -> str:
    return f"""SELECT * EXCLUDE (p_, n_) FROM (SELECT *, lag(position) OVER w AS p_, lead(position) OVER w AS n_ FROM {source} {VISIT_WINDOW}) a_
WHERE p_ IS NULL OR n_ IS NULL OR (p_ <> position) <> (n_ <> position)"""


def visit_marks(source: str) -> str:
    return f"""SELECT * EXCLUDE (p_, n_, t_), CASE WHEN (position = 'in' AND p_ = 'out') OR (position = 'out' AND n_ = 'in') THEN 'masuk' ELSE '-' END AS masuk_pelabuhan,
CASE WHEN (position = 'in' AND n_ = 'out') OR (position = 'out' AND p_ = 'in') THEN 'keluar' ELSE '-' END AS keluar_pelabuhan,
date_diff('second', dt_pos_utc, t_) AS time
FROM (SELECT *, lag(position) OVER w AS p_, lead(position) OVER w AS n_, lead(dt_pos_utc) OVER w AS t_ FROM {source} {VISIT_WINDOW}) a_"""


EDGE_STEPS = {"seen": SEEN, "once": one_pass("seen"), "twice": one_pass("once")}
MARKED = {"visit_rows": VISIT_ROWS, **EDGE_STEPS, "activity": visit_marks("twice")}
add("visit_edges", ctes("pings", "aoi_cells", **MARKED) + "SELECT mmsi, dt_pos_utc, Port, position FROM twice")
add("port_visits", ctes("pings", "aoi_cells", **MARKED) + "SELECT * FROM activity")
CHANGED = {
    "kept": f"""SELECT * EXCLUDE (pp_, np_, p_, n_) FROM (SELECT *, lag(position) OVER w AS p_, lead(position) OVER w AS n_, lag(Port) OVER w AS pp_, lead(Port) OVER w AS np_
FROM twice {VISIT_WINDOW}) a_ WHERE position = 'out' OR pp_ IS DISTINCT FROM Port OR coalesce(p_ = 'out', false) OR coalesce(n_ = 'out', false)
OR (n_ IS NOT NULL AND np_ IS DISTINCT FROM Port)""",
    "changed": f"""SELECT * EXCLUDE (pp_, np_, p_, n_, t_),
CASE WHEN (position = 'in' AND (p_ = 'out' OR (p_ = 'in' AND pp_ IS DISTINCT FROM Port))) OR (position = 'out' AND n_ = 'in') THEN 'masuk' ELSE '-' END AS masuk_pelabuhan,
CASE WHEN (position = 'in' AND (n_ = 'out' OR (n_ = 'in' AND np_ IS DISTINCT FROM Port))) OR (position = 'out' AND p_ = 'in') THEN 'keluar' ELSE '-' END AS keluar_pelabuhan,
date_diff('second', dt_pos_utc, t_) AS time
FROM (SELECT *, lag(position) OVER w AS p_, lead(position) OVER w AS n_, lag(Port) OVER w AS pp_, lead(Port) OVER w AS np_, lead(dt_pos_utc) OVER w AS t_
FROM kept {VISIT_WINDOW}) b_""",
}
add("port_visits_by_port_change", ctes("pings", "aoi_cells", **MARKED, **CHANGED) + """SELECT * EXCLUDE (vessel_type_main, vessel_type_sub, Prov_ID, Hirarki_1,
RegisteredOwnerCountryofDomicile) FROM changed""")


def area_visits(method: str) -> dict[str, str]:
    steps_ = dict(MARKED)
    steps_["visit_rows"] = VISIT_ROWS.replace("aoi_cells", "area_cells")
    return {
        **fill_ctes(8),
        "area_cells": f"SELECT f.cell AS h3_ids_int, a.Kode, a.Prov_ID, a.Hirarki_1 FROM filled f JOIN aoi a USING (Kode) WHERE method = '{method}'",
        **steps_,
    }


add("port_visits_from_areas", ctes("aoi", pings=grid_pings(), **area_visits("Manual")) + "SELECT * FROM activity")
_BUF = buffer_ctes(8, 10000.0, 0.1)
_BUF["near"] = _BUF["near"].replace("cand c JOIN edges e ON c.Kode = e.Kode", "cand c JOIN edges e ON c.Kode = e.Kode WHERE c.Kode IN (SELECT Kode FROM aoi WHERE method = 'Cluster')")
_BUF["buffered"] = "SELECT cell AS boundary_h3 FROM filled JOIN aoi USING (Kode) WHERE method = 'Cluster' UNION SELECT cell FROM near"
_VIS = {k: v for k, v in area_visits("Cluster").items() if k not in _BUF}
add("port_visits_in_buffer", ctes("aoi", all_pings=grid_pings(), **_BUF,
 pings="SELECT * FROM all_pings WHERE H3_int_index_8 IN (SELECT boundary_h3 FROM buffered)", **_VIS) + """
SELECT mmsi, dt_pos_utc, Port, position, masuk_pelabuhan, keluar_pelabuhan, time FROM activity""")
ARRIVED = "masuk_pelabuhan = 'masuk' AND position = 'in' AND time >= 1800"
DEPARTED = f"""SELECT * REPLACE (CAST(dt_pos_utc AS DATE) AS dt_pos_utc, port1_ AS Port) FROM (SELECT *, lag(Port) OVER w AS port1_, lag(time, 2) OVER w AS time2_,
lag(position, 2) OVER w AS pos2_, lag(masuk_pelabuhan, 2) OVER w AS in2_ FROM activity {VISIT_WINDOW}) a_
WHERE position = 'out' AND keluar_pelabuhan = 'keluar' AND time2_ >= 1800 AND pos2_ = 'in' AND in2_ = 'masuk'"""
ACTIVITY = ctes("pings", "aoi_cells", **MARKED)
add("arrivals", ACTIVITY + f"SELECT mmsi, dt_pos_utc, Port, time FROM activity WHERE {ARRIVED}")
add("departures", ACTIVITY + "SELECT mmsi, dt_pos_utc, Port, time FROM activity WHERE keluar_pelabuhan = 'keluar' AND position = 'in'")
add("departures_after_stay", ctes("pings", "aoi_cells", **MARKED, departed=DEPARTED) + "SELECT mmsi, dt_pos_utc AS date, Port, latitude FROM departed")

# ---- reports -------------------------------------------------------------------
DOMICILE = home("GroupBeneficialOwnerCountryofDomicile") + " AS status_country_domicile"
DAY = "strftime(dt_pos_utc, '%Y-%m-%d') AS date"


def recap(source: str, rule: str, keys: str) -> str:
    return f"""SELECT *, {port_name('Port')} AS nama_pelabuhan FROM (SELECT {DAY}, Port, {DOMICILE}, vessel_type, fc_vessel{keys}, count(*) AS count
FROM {source} WHERE {rule} GROUP BY ALL) r_"""


WIDE = """, vessel_type_main, vessel_type_sub, GroupBeneficialOwnerCountryofDomicile, GroupBeneficialOwnerCountryOfRegistration,
RegisteredOwnerCountryofDomicile, ns_vessel, is_through_hormuz, first_detected_hormuz, last_detected_hormuz"""
HISTORY = """SELECT mmsi, bool_or(is_hormuz) AS is_through_hormuz, min(dt_pos_utc) FILTER (WHERE is_hormuz) AS first_detected_hormuz,
max(dt_pos_utc) FILTER (WHERE is_hormuz) AS last_detected_hormuz FROM tagged GROUP BY mmsi"""
FLAGGED = {**MARKED, "tagged": TAGGED, "history": HISTORY, "flagged": "SELECT * FROM activity LEFT JOIN history USING (mmsi)"}
FLAG_CTES = ctes("pings", "aoi_cells", "zone_cells", **FLAGGED)
add("activity_with_zone_history", FLAG_CTES + "SELECT mmsi, dt_pos_utc, Port, is_through_hormuz, first_detected_hormuz, last_detected_hormuz FROM flagged")
add("arrival_recap", ACTIVITY + recap("activity", ARRIVED, ""))
add("departure_recap", ctes("pings", "aoi_cells", **MARKED, departed=DEPARTED) + recap("departed", "month(dt_pos_utc) = 1", ""))
add("arrival_recap_with_zone", FLAG_CTES + f"""SELECT * REPLACE (strftime(first_detected_hormuz, '%Y-%m-%d') AS first_detected_hormuz,
strftime(last_detected_hormuz, '%Y-%m-%d') AS last_detected_hormuz) FROM ({recap('flagged', ARRIVED, WIDE)}) x_""")
add("departure_recap_with_zone", FLAG_CTES + recap("flagged", "keluar_pelabuhan = 'keluar' AND position = 'in' AND year(dt_pos_utc) = 2024", WIDE))
LATEST = f"""SELECT mmsi, {', '.join(SHIP_ATTRIBUTES)}, nav_status FROM pings
QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY dt_pos_utc DESC, event_id DESC) = 1"""
for _name, _flag in (("vessels_through_zone", "true"), ("vessels_not_through_zone", "false")):
    add(_name, ctes("pings", "aoi_cells", "zone_cells", **FLAGGED, latest=LATEST) + f"""
SELECT l.*, {port_name('Port')} AS nama_pelabuhan, {', '.join('latest.' + c for c in SHIP_ATTRIBUTES)} FROM (
SELECT mmsi, vessel_name, vessel_type, vessel_type_main, vessel_type_sub, fc_vessel, GroupBeneficialOwnerCountryofDomicile, GroupBeneficialOwnerCountryOfRegistration,
{DOMICILE}, Port, {DAY}, draught, ns_vessel, sog, latitude, longitude, H3_int_index_8, is_through_hormuz, first_detected_hormuz, last_detected_hormuz
FROM flagged WHERE {ARRIVED} AND is_through_hormuz = {_flag}
QUALIFY row_number() OVER (PARTITION BY mmsi, Port, CAST(dt_pos_utc AS DATE) ORDER BY dt_pos_utc) = 1) l LEFT JOIN latest ON l.mmsi = latest.mmsi""")
add("latest_ship_attributes", ctes("pings") + LATEST)
add("earliest_row_per_key", ctes("pings") + """SELECT mmsi, site, event_id, nav_status FROM pings
QUALIFY row_number() OVER (PARTITION BY mmsi, site ORDER BY dt_pos_utc, event_id) = 1""")
add("time_in_port_by_port", ACTIVITY + """SELECT Port, CAST(dt_pos_utc AS DATE) AS date, round(avg(time / 3600e0), 6) AS "Rata-rata (Jam)",
round(quantile_disc(time / 3600e0, 0.5), 6) AS "Median (Jam)" FROM activity WHERE masuk_pelabuhan = 'masuk' AND position = 'in' AND time IS NOT NULL GROUP BY ALL""")


# ---- stop events ---------------------------------------------------------------
def stop_ctes(compat: bool = False, source: str | None = None, depth: int = 3) -> dict[str, str]:
    """A ship's pings are walked one by one; ``anchor`` is the row number of the open event."""
    return {
        "grid": source or grid_pings(),
        "walk": f"""SELECT *, {cell_q('H3_int_index_8')} AS q, {cell_r('H3_int_index_8')} AS r, {UNIX.format('dt_pos_utc')} AS unix,
 row_number() OVER w AS rn, count(*) OVER (PARTITION BY mmsi) AS n, coalesce(sog < 1, false) AS slow
 FROM grid WINDOW w AS (PARTITION BY mmsi ORDER BY dt_pos_utc, event_id)""",
        "run": f"""SELECT mmsi, rn, CASE WHEN slow THEN rn ELSE 0 END AS anchor, CASE WHEN slow THEN q END AS aq, CASE WHEN slow THEN r END AS ar FROM walk WHERE rn = 1
 UNION ALL
 SELECT w.mmsi, w.rn,
 CASE WHEN run.anchor > 0 THEN CASE WHEN greatest(abs(w.q - aq), abs(w.r - ar), abs(w.q - aq + w.r - ar)) <= {depth} THEN run.anchor ELSE 0 END
      WHEN slow THEN w.rn ELSE 0 END,
 CASE WHEN run.anchor > 0 THEN aq WHEN slow THEN w.q END, CASE WHEN run.anchor > 0 THEN ar WHEN slow THEN w.r END
 FROM run JOIN walk w ON w.mmsi = run.mmsi AND w.rn = run.rn + 1""",
        "member": "SELECT w.*, anchor FROM walk w JOIN run USING (mmsi, rn) WHERE anchor > 0"
        + (" UNION ALL SELECT w.*, anchor FROM walk w JOIN run USING (mmsi, rn) WHERE anchor > 0 AND rn = n" if compat else ""),
        "modes": """SELECT mmsi, anchor, nav_status AS mode_nav_status, CAST(k AS INTEGER) AS obs_nav_status FROM (
 SELECT mmsi, anchor, nav_status, count(*) AS k, min(rn) AS seen FROM member GROUP BY ALL) a_
 QUALIFY row_number() OVER (PARTITION BY mmsi, anchor ORDER BY k DESC, seen DESC) = 1""",
        "sums": """SELECT mmsi, anchor, count(*) AS k, max(rn) AS last_rn, avg(latitude) AS avg_lat, avg(longitude) AS avg_lng,
 CAST(floor(sum(unix) / count(*)) AS BIGINT) AS avg_unix,
 coalesce(stddev_samp(latitude), 0) AS sd_lat_, coalesce(stddev_samp(longitude), 0) AS sd_lng_ FROM member GROUP BY mmsi, anchor""",
        "events_": """SELECT s.*, a.H3_int_index_8 AS h3_index_int, a.length, a.width, a.vessel_type, a.vessel_type_main, a.dt_pos_utc AS obs_time, a.flag_country,
 a.source, a.destination, a.unix AS unix_trigger, z.unix AS unix_disarm, a.latitude AS trigger_lat, a.longitude AS trigger_lng,
 z.latitude AS disarm_lat, z.longitude AS disarm_lng, a.n, f.vessel_type AS ship_type, mode_nav_status, obs_nav_status,
 coalesce((SELECT arg_min(g.imo, g.rn) FROM walk g WHERE g.mmsi = s.mmsi AND g.rn <= s.anchor AND g.imo IS NOT NULL), -1) AS imo,
 CASE WHEN a.rn = a.n THEN 3 WHEN a.rn = 1 THEN 1 ELSE 2 END AS state_initial, CASE WHEN z.rn = z.n THEN 3 WHEN z.rn = 1 THEN 1 ELSE 2 END AS state_final,
 CAST(round_even((z.unix - a.unix) / 3600e0, 0) AS INTEGER) AS lower_, CAST(round_even((coalesce(e.unix, z.unix) - coalesce(b.unix, a.unix)) / 3600e0, 0) AS INTEGER) AS upper_
 FROM sums s JOIN walk a ON a.mmsi = s.mmsi AND a.rn = s.anchor JOIN walk z ON z.mmsi = s.mmsi AND z.rn = s.last_rn
 JOIN walk f ON f.mmsi = s.mmsi AND f.rn = 1 JOIN modes m ON m.mmsi = s.mmsi AND m.anchor = s.anchor
 LEFT JOIN walk b ON b.mmsi = s.mmsi AND b.rn = s.anchor - 1 LEFT JOIN walk e ON e.mmsi = s.mmsi AND e.rn = s.last_rn + 1""",
    }


def point(lat: str, lng: str) -> str:
    return f"printf('POINT (%.9f %.9f)', {lng}, {lat})"


LINE = "printf('LINESTRING (%.9f %.9f, %.9f %.9f,%.9f %.9f)', trigger_lng, trigger_lat, avg_lng, avg_lat, disarm_lng, disarm_lat)"


def box(factor: str) -> str:
    xs = [f"avg_lng {s} {factor} * sd_lng_" for s in "-+"]
    ys = [f"avg_lat {s} {factor} * sd_lat_" for s in "-+"]
    corners = [(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]
    args = ", ".join(f"{xs[i]}, {ys[j]}" for i, j in corners)
    return f"printf('POLYGON((%.9f %.9f, %.9f %.9f, %.9f %.9f, %.9f %.9f, %.9f %.9f))', {args})"


def recursive(names: tuple[str, ...], parts: dict[str, str]) -> str:
    return ctes(*names, **parts).replace("WITH ", "WITH RECURSIVE ", 1)


def stop_table(compat: bool = False, geometry: str = LINE, rnd: bool = True) -> str:
    ok, need = ("k > CASE WHEN ship_type = 'Passenger' THEN 2 ELSE {} END".format(20 if compat else 10),
                "CASE WHEN ship_type = 'Passenger' THEN 2 ELSE {} END".format(10 if compat else 20))
    lower, upper = ("upper_", "lower_") if compat else ("lower_", "upper_")

    def r(x):
        return f"round({x}, 6)" if rnd else x
    return f"""SELECT h3_index_int, mmsi, imo, {r('length')} AS length, {r('width')} AS width, vessel_type, vessel_type_main, obs_time, flag_country, source, destination,
{lower} AS time_lower, {upper} AS time_upper, unix_trigger, avg_unix, unix_disarm,
CASE WHEN {ok} THEN {r('sd_lat_')} ELSE 0e0 END AS sd_lat, CASE WHEN {ok} THEN {r('sd_lng_')} ELSE 0e0 END AS sd_lng,
{r('trigger_lat')} AS trigger_lat, {r('trigger_lng')} AS trigger_lng, {r('avg_lat')} AS avg_lat, {r('avg_lng')} AS avg_lng,
{r('disarm_lat')} AS disarm_lat, {r('disarm_lng')} AS disarm_lng, mode_nav_status, obs_nav_status, state_initial, state_final, CAST(k AS INTEGER) AS obs_count,
CASE WHEN {ok} THEN 'valid' ELSE 'invalid' END AS is_valid,
CASE WHEN {ok} THEN {geometry} ELSE {point('trigger_lat', 'trigger_lng')} END AS geom_wkt,
CASE WHEN {ok} THEN {point('avg_lat', 'avg_lng')} ELSE {point('trigger_lat', 'trigger_lng')} END AS wkt_avg_pt
FROM events_ WHERE n > {need}"""


STOPS = {**stop_ctes(), "stopped": stop_table()}
add("stop_events", recursive((), STOPS) + "SELECT * FROM stopped")
add("stop_events_compat", recursive((), stop_ctes(compat=True)) + stop_table(compat=True))
add("stop_events_as_boxes", recursive((), {**stop_ctes(), "stopped": stop_table(geometry=box("2e0"))}) + "SELECT mmsi, unix_trigger, geom_wkt FROM stopped")


def metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2e0), 2e0) + cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin((radians({lon2}) - radians({lon1})) / 2e0), 2e0)")
    return f"2e0 * {SPHERE} * asin(least(1e0, sqrt({h})))"


def toward_zero(v: str, sd: str) -> str:
    return f"(CASE WHEN {v} > 0 THEN {v} - {sd} ELSE {v} + {sd} END)"


SPREAD_X = metres("avg_lat", "avg_lng", "avg_lat", toward_zero("avg_lng", "sd_lng_"))
SPREAD_Y = metres("avg_lat", "avg_lng", toward_zero("avg_lat", "sd_lat_"), "avg_lng")
add("stop_event_profiles", recursive((), stop_ctes()) + f"""SELECT h3_index_int, mmsi, imo, round(length, 9) AS length, round(width, 9) AS width, vessel_type, vessel_type_main, obs_time,
lower_ AS time_lower, upper_ AS time_upper, unix_trigger, avg_unix, unix_disarm,
CASE WHEN k >= 3 THEN round(sd_lat_, 9) ELSE 0e0 END AS sd_lat, CASE WHEN k >= 3 THEN round(sd_lng_, 9) ELSE 0e0 END AS sd_lng,
CASE WHEN k >= 3 THEN round({SPREAD_X}, 4) ELSE 0e0 END AS delta_x, CASE WHEN k >= 3 THEN round({SPREAD_Y}, 4) ELSE 0e0 END AS delta_y,
round(trigger_lat, 9) AS trigger_lat, round(trigger_lng, 9) AS trigger_lng, round(avg_lat, 9) AS avg_lat, round(avg_lng, 9) AS avg_lng,
round(disarm_lat, 9) AS disarm_lat, round(disarm_lng, 9) AS disarm_lng, mode_nav_status, obs_nav_status, CAST(k AS INTEGER) AS obs_count, state_initial, state_final,
{point('trigger_lat', 'trigger_lng')} AS wkt_trigger_pt, {point('avg_lat', 'avg_lng')} AS wkt_avg_pt, {point('disarm_lat', 'disarm_lng')} AS wkt_disarm_pt,
CASE WHEN k >= 3 THEN {LINE} ELSE 'LINESTRING EMPTY' END AS wkt_triline, CASE WHEN k >= 3 THEN {box('1e0')} ELSE 'POLYGON EMPTY' END AS wkt_sd_box,
CASE WHEN k >= 3 THEN 'valid' ELSE 'invalid' END AS is_valid FROM events_""")
_MANUAL = buffer_ctes(10, 10000.0, 0.1)
_MANUAL["edges"] = EDGES + " AND Kode IN (SELECT Kode FROM aoi WHERE method = 'Manual')"
add("stationary", recursive(("aoi",), {**_MANUAL, "all_pings": grid_pings(10), **stop_ctes(
 source="SELECT * REPLACE (H3_int_index_10 AS H3_int_index_8) FROM all_pings WHERE H3_int_index_10 IN (SELECT boundary_h3 FROM buffered)")}) + stop_table())
PORT_STOPS = {**STOPS, **fill_ctes(8), "port_stops": "SELECT stopped.*, aoi.Kode, aoi.Prov_ID FROM stopped JOIN filled ON h3_index_int = cell JOIN aoi USING (Kode)"}
add("stops_in_ports", recursive(("aoi",), PORT_STOPS) + """SELECT mmsi, unix_trigger, Kode, Prov_ID FROM port_stops
WHERE Kode IN (SELECT Kode FROM aoi WHERE method = 'Manual')""")
for _name, _rule, _as in (("stop_arrivals", "state_initial = 2 AND state_final IN (2, 3)", "kedatangan"),
                          ("stop_departures", "state_final = 2 AND state_initial IN (1, 2)", "keberangkatan")):
    add(_name, recursive(("aoi",), PORT_STOPS) + f"""SELECT *, {port_name('Kode')} AS nama_pelabuhan FROM (
SELECT Kode, CAST(obs_time AS DATE) AS tanggal, count(*) AS {_as} FROM port_stops WHERE {_rule} AND month(obs_time) = 1 GROUP BY ALL) a_""")
add("time_in_port_of_stops", recursive((), STOPS) + """SELECT vessel_type, CAST(day(obs_time) AS INTEGER) AS day, round(avg(time_lower), 6) AS "Rata-rata (Jam)",
quantile_disc(time_lower, 0.5) AS "Median (Jam)" FROM stopped GROUP BY ALL""")
add("stay_hours_summary", recursive((), STOPS) + """SELECT source, CAST(year(obs_time) AS INTEGER) AS year, CAST(month(obs_time) AS INTEGER) AS month,
CAST(day(obs_time) AS INTEGER) AS day, round(avg(time_lower), 6) AS rata_rata_durasi, quantile_disc(time_lower, 0.5) AS median_durasi FROM stopped GROUP BY ALL""")
add("stay_hours_by_period", recursive((), STOPS) + """SELECT source, round(avg(time_lower), 6) AS rata_rata_durasi,
CAST(quantile_disc(time_lower, 0.5) AS DOUBLE) AS median_durasi FROM stopped WHERE time_lower IS NOT NULL GROUP BY ALL""")
add("time_in_port_by_period", ACTIVITY + """SELECT Port, round(avg(time / 3600e0), 6) AS rata_rata_durasi, round(quantile_disc(time / 3600e0, 0.5), 6) AS median_durasi
FROM activity WHERE masuk_pelabuhan = 'masuk' AND position = 'in' AND time IS NOT NULL GROUP BY ALL""")
MODES = "SELECT mmsi, site, nav_status AS mode, count(*) AS frequency, min(dt_pos_utc) AS seen FROM pings GROUP BY ALL"
for _name, _rank in (("last", "row_number() OVER (PARTITION BY mmsi, site ORDER BY frequency DESC, seen DESC)"),
                     ("first", "row_number() OVER (PARTITION BY mmsi, site ORDER BY frequency DESC, seen)"),
                     ("all", "rank() OVER (PARTITION BY mmsi, site ORDER BY frequency DESC)")):
    add(f"status_mode_{_name}", ctes("pings", modes=MODES) + f"SELECT mmsi, site, mode, frequency FROM modes QUALIFY {_rank} = 1")
add("position_spread", ctes("pings", base="""SELECT mmsi, site, count(*) AS obs_count, avg(latitude) AS avg_lat, avg(longitude) AS avg_lng,
coalesce(stddev_samp(latitude), 0) AS sd_lat_, coalesce(stddev_samp(longitude), 0) AS sd_lng_ FROM pings GROUP BY mmsi, site""") + f"""
SELECT mmsi, site, obs_count, round(avg_lat, 9) AS avg_lat, round(avg_lng, 9) AS avg_lng, round(sd_lat_, 9) AS sd_lat, round(sd_lng_, 9) AS sd_lng,
CASE WHEN obs_count >= 3 THEN round({SPREAD_X}, 4) ELSE 0e0 END AS delta_x, CASE WHEN obs_count >= 3 THEN round({SPREAD_Y}, 4) ELSE 0e0 END AS delta_y FROM base""")

# ---- cells and geometry --------------------------------------------------------
_ALL_CELLS = with_cell(with_cell(with_cell(fixture("pings"), 5, "cell_5"), 8, "cell_8"), 10, "cell_10")
add("point_cells", f"SELECT event_id, cell_5, cell_8, cell_10 FROM ({_ALL_CELLS}) p_")
GRID = ctes(pings=grid_pings())
add("cell_texts", GRID + "SELECT event_id, lower(hex(H3_int_index_8)) AS cell_text, H3_int_index_8 AS cell FROM pings")
add("cell_centres", GRID + f"""SELECT DISTINCT H3_int_index_8, round({centre_lat('H3_int_index_8', 8)}, 6) AS lat,
round({centre_lon('H3_int_index_8', 8)}, 6) AS lon FROM pings""")
add("area_cells", ctes("aoi", **fill_ctes(10)) + "SELECT Kode, cell AS h3_ids_int FROM filled")
add("zone_union_cells", ctes("aoi", **fill_ctes(9)) + "SELECT DISTINCT f.cell FROM filled f JOIN aoi USING (Kode) WHERE TERRITORY1 = 'ASIA'")
add("zone_run_flags", ctes("aoi", pings=grid_pings(9), **fill_ctes(9)) + """SELECT event_id, H3_int_index_9 IN
(SELECT f.cell FROM filled f JOIN aoi USING (Kode) WHERE TERRITORY1 = 'ASIA') AS in_zone FROM pings""")
add("buffer_cells", ctes("aoi", **buffer_ctes(10, 10000.0, 0.1)) + "SELECT boundary_h3 FROM buffered")
add("cell_rings", GRID + f"""SELECT H3_int_index_8, H3_int_index_8 + dq * {1 << 26} + dr AS neighbour FROM (SELECT DISTINCT H3_int_index_8 FROM pings) c
CROSS JOIN range(-2, 3) a(dq) CROSS JOIN range(-2, 3) b(dr) WHERE greatest(abs(dq), abs(dr), abs(dq + dr)) <= 2""")
add("ring_membership", GRID + f"""SELECT event_id, coalesce({steps('H3_int_index_8', 'before_')} <= 1, false) AS near
FROM (SELECT *, lag(H3_int_index_8) {SHIP} AS before_ FROM pings) a_""")
_PAIRS = f"SELECT event_id, latitude, longitude, lag(latitude) {SHIP} AS lat0, lag(longitude) {SHIP} AS lon0 FROM pings"
_A = with_cell("SELECT * FROM pairs", 6, "cell_a", "lat0", "lon0")
add("point_grid_distances", ctes("pings", pairs=_PAIRS, pair_cells=with_cell(_A, 6, "cell_b")) + f"""SELECT event_id,
CASE WHEN lat0 IS NOT NULL THEN {steps('cell_a', 'cell_b')} END AS steps FROM pair_cells""")
add("resolution_checks", ctes("pings") + """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 9 ELSE 8 END AS resolution, event_id % 2 <> 0 AS same FROM pings""")
add("great_circle_metres", ctes("pings", pairs=_PAIRS) + f"""SELECT event_id, CASE WHEN lat0 IS NOT NULL THEN round({metres('lat0', 'lon0', 'latitude', 'longitude')}, 3) END AS metres,
CASE WHEN lat0 IS NOT NULL AND latitude + 100 <= 90 THEN {metres('lat0', 'lon0', '(latitude + 100)', 'longitude')} END AS out_of_range FROM pairs""")
add("wkt_texts", ctes("pings") + """SELECT event_id, printf('POINT (%.9f %.9f)', longitude, latitude) AS point,
printf('LINESTRING (%.9f %.9f, %.9f %.9f,%.9f %.9f)', longitude, latitude, sog, cog, width, Depth) AS line,
printf('POLYGON((%.9f %.9f, %.9f %.9f, %.9f %.9f, %.9f %.9f, %.9f %.9f))', longitude - 2e0 * Depth, latitude - 2e0 * sog, longitude - 2e0 * Depth, latitude + 2e0 * sog,
longitude + 2e0 * Depth, latitude + 2e0 * sog, longitude + 2e0 * Depth, latitude - 2e0 * sog, longitude - 2e0 * Depth, latitude - 2e0 * sog) AS box FROM pings""")
add("wkt_rings", ctes("aoi", rings=RINGS, vertices=VERTICES) + "SELECT Kode, CAST(ring AS INTEGER) AS ring, CAST(i AS INTEGER) AS i, lon, lat FROM vertices")

add("port_visits_from_areas_draft", ctes("aoi", pings=grid_pings(), **area_visits("Manual"), **CHANGED) + """SELECT * EXCLUDE (vessel_type_main, vessel_type_sub,
Prov_ID, Hirarki_1, RegisteredOwnerCountryofDomicile) FROM changed""")
add("arrival_recap_of_port", ACTIVITY + recap("activity", ARRIVED + " AND Port = 'BLW'", ""))
add("vessels_departed_through_zone", FLAG_CTES + f"""SELECT *, {port_name('Port')} AS nama_pelabuhan FROM (
SELECT mmsi, vessel_name, vessel_type, vessel_type_main, vessel_type_sub, fc_vessel, GroupBeneficialOwnerCountryofDomicile, GroupBeneficialOwnerCountryOfRegistration,
{DOMICILE}, Port, {DAY}, draught, ns_vessel, sog, latitude, longitude, H3_int_index_8, is_through_hormuz, first_detected_hormuz, last_detected_hormuz
FROM flagged WHERE keluar_pelabuhan = 'keluar' AND position = 'in' AND is_through_hormuz
QUALIFY row_number() OVER (PARTITION BY mmsi, Port, CAST(dt_pos_utc AS DATE) ORDER BY dt_pos_utc) = 1) l""")

# Ties in time are broken by all other columns, in the order of their names.
for _name, _plain, _full in (
    ("stop_events", "dt_pos_utc, event_id", "dt_pos_utc, H3_int_index_8, cog, destination, draught NULLS FIRST, event_id"),
    ("port_call_runs", "dt_pos_utc, event_id, Port_Country", "dt_pos_utc, Port_Country"),
    ("visit_edges", "dt_pos_utc, Port NULLS FIRST", "dt_pos_utc, Port NULLS FIRST"),
    ("zone_edges", "dt_pos_utc, event_id", "dt_pos_utc, is_hormuz, is_indo"),
):
    add(f"{_name}_tied", ORACLE[_name].replace("ts AS dt_pos_utc", "date_trunc('hour', ts) AS dt_pos_utc").replace(
        f"ORDER BY {_plain}", f"ORDER BY {_full}"))

# Nine in ten pings carry the number of one ship; how Spark cuts it up must not show.
for _name in ("stop_events", "port_call_runs", "visit_edges", "port_visits", "port_visits_by_port_change", "zone_edges"):
    add(f"{_name}_crowded", ORACLE[_name].replace("user_id AS mmsi", "CASE WHEN event_id % 10 < 9 THEN 1 ELSE user_id END AS mmsi"))

# The same rows in three periods, each starting from what the one before left behind.
for _name in ("voyage_legs", "port_visits", "stop_events"):
    add(f"{_name}_by_period", ORACLE[_name])

# Outputs of one run, written and read back.
for _name in ("port_traffic_all", "vessels_through_zone", "arrival_recap_with_zone"):
    add(f"{_name}_written", ORACLE[_name])
