"""Every registered query: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.functions import geo, grid, labels, ports
from fairlead.operators import areas, clean, columns, joins, reports, sequence, stats, stops, visits, voyages, zones
from fairlead.plans import jobs, periods
from fairlead.schemas import SHIP_ATTRIBUTES
from fairlead.sources import layout, readers, writers
from queries.fixture import SLICE, table, view, work_folder

TIE = ["event_id"]
ORDER = ["dt_pos_utc", "event_id"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round doubles, so the last bits of two math libraries do not matter."""
    return df.select(
        [
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rounded_spread(df: DataFrame) -> DataFrame:
    """Degrees to nine digits, metres to four."""
    return rounded(df, 9, ("delta_x", "delta_y")).withColumns(
        {c: F.round(c, 4) for c in ("delta_x", "delta_y")}
    )


# ---- shared inputs -------------------------------------------------------------


def pings(spark, sf) -> DataFrame:
    return view(spark, sf, "pings")


def grid_pings(spark, sf, resolution: int = 8) -> DataFrame:
    # The cell is a generated value: inlined where it is used, it makes methods too large for the JVM to compile.
    cell = grid.cell_at("latitude", "longitude", resolution)
    return areas.settle(pings(spark, sf), _at=cell).withColumn(f"H3_int_index_{resolution}", F.col("_at")).drop("_at")


def tied_pings(spark, sf) -> DataFrame:
    """Pings stamped by the hour only, so that many of a ship's pings share their time."""
    p = pings(spark, sf)
    return p.withColumn("dt_pos_utc", F.date_trunc("hour", "dt_pos_utc").cast(p.schema["dt_pos_utc"].dataType))


def crowded_pings(spark, sf) -> DataFrame:
    """Pings of which nine in ten carry one ship's number, as a shared or broken transponder would send them."""
    return pings(spark, sf).withColumn("mmsi", F.when(F.col("event_id") % 10 < 9, 1).otherwise(F.col("mmsi")).cast("bigint"))


#: Slices of a month, so that the crowded ship overfills them, and parts of a few hundred pings.
CUT = sequence.Slicing(30 * 86400, 400)


def aoi(spark, sf) -> DataFrame:
    return areas.load_wkt(view(spark, sf, "aoi"), "wkt")


def zone(spark, sf, name: str) -> DataFrame:
    return view(spark, sf, "zone_cells").filter(F.col("zone") == name).select("cell")


def port_tagged(spark, sf) -> DataFrame:
    return joins.tag_ports(pings(spark, sf), view(spark, sf, "aoi_cells"))


def activity(spark, sf) -> DataFrame:
    return visits.port_visits(port_tagged(spark, sf), slice_seconds=SLICE)


def strait_tagged(spark, sf) -> DataFrame:
    return zones.tag_zone(pings(spark, sf), zone(spark, sf, "strait"), "is_hormuz")


def flagged_activity(spark, sf) -> DataFrame:
    return zones.flag_activity(activity(spark, sf), zones.zone_history(strait_tagged(spark, sf), "is_hormuz"))


def simple_calls(spark, sf) -> DataFrame:
    return voyages.port_calls(pings(spark, sf), view(spark, sf, "port_cells"), tiebreak=TIE, slice_seconds=SLICE)


def simple_legs(spark, sf) -> DataFrame:
    return voyages.legs(simple_calls(spark, sf), TIE, SLICE)


def area_ports(spark, sf) -> DataFrame:
    cells = areas.area_cells(aoi(spark, sf), ["Kode", "Country"], 8, "boundary_h3")
    return cells.select(
        F.col("Kode").alias("Port"), "Country", "boundary_h3", F.concat_ws(" - ", "Kode", "Country").alias("Port_Country")
    )


def stop_table(spark, sf, **options) -> DataFrame:
    return stops.stop_events(grid_pings(spark, sf), 8, TIE, slice_seconds=SLICE, **options)


def kept(spark, df: DataFrame) -> DataFrame:
    """A table that several periods read, written once."""
    return spark.read.schema(df.schema).parquet(writers.write_parquet(df, work_folder(spark)))


def port_stops(spark, sf) -> DataFrame:
    """Stop events in ports, counted by what the recaps look at."""
    cells = areas.area_cells(aoi(spark, sf), ["Kode"], 8)
    return joins.events_in_ports(reports.counted_stops(stop_table(spark, sf)), cells).drop("h3_ids_int")


# ---- scans and sinks -----------------------------------------------------------

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)


@query
def parquet_scan(spark, sf):
    orders = readers.read_parquet(spark, f"{sf}/orders.parquet", ORDERS_SCHEMA)
    return readers.in_period(orders, "1996-01-01", "1996-12-31", "o_orderdate").select("o_orderkey", "o_totalprice")


@query
def csv_scan_complete(spark, sf):
    path = work_folder(spark)
    source = view(spark, sf, "register").withColumn(
        "ShiptypeLevel5", F.nullif("ShiptypeLevel5", F.lit("HOUSEHOLD"))
    )
    source.write.mode("overwrite").option("header", True).csv(path)
    return readers.read_csv_complete(spark, path, source.schema)


@query
def register_csv_scan(spark, sf):
    path = work_folder(spark)
    source = view(spark, sf, "register")
    source.write.mode("overwrite").option("header", True).csv(path)
    return readers.read_register(spark, path, source.schema)


@query
def region_scan(spark, sf):
    current = readers.in_period(pings(spark, sf), "2024-01-05", "2024-01-20")
    return readers.pings_in_cells(current, zone(spark, sf, "strait"), "H3_int_index_8").select(
        "event_id", "mmsi", "H3_int_index_8"
    )


@query
def ship_scan(spark, sf):
    current = readers.in_period(pings(spark, sf), "2024-01-05", "2024-01-20")
    ships = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("mmsi"))
    return readers.pings_of_ships(current, ships).select("event_id", "mmsi")


@query
def region_then_ship_scan(spark, sf):
    return readers.pings_of_ships_seen_in(
        pings(spark, sf), zone(spark, sf, "strait"), "H3_int_index_8", "2024-01-05", "2024-01-09"
    ).select("event_id", "mmsi")


@query
def ingest(spark, sf):
    return jobs.ingest(
        grid_pings(spark, sf), aoi(spark, sf), "2024-01-05", "2024-01-09", resolution=8, territory="ASIA"
    ).select("event_id", "mmsi")


@query
def ingest_clustered(spark, sf):
    target = work_folder(spark)
    layout.write_clustered(grid_pings(spark, sf), target, 60)
    asia = aoi(spark, sf).filter("TERRITORY1 = 'ASIA'")
    return layout.pings_of_ships_seen_in(spark, target, asia, 8, "2024-01-05", "2024-01-09", target).select("event_id", "mmsi")


@query
def distinct_ships(spark, sf):
    return readers.distinct_ships(pings(spark, sf))


@query
def areas_by_method(spark, sf):
    path = writers.write_parquet(view(spark, sf, "aoi"), work_folder(spark))
    found = readers.read_areas(spark, path, "Cluster")
    return found.select("Kode", F.size("geom").alias("rings"))


@query
def parquet_sink(spark, sf):
    dated = pings(spark, sf).select("event_id", "mmsi", "sog", F.to_date("dt_pos_utc").alias("day"))
    path = writers.write_parquet(dated, work_folder(spark), ("day",))
    return readers.read_parquet(spark, path).select("event_id", "mmsi", "sog", F.col("day").cast("date").alias("day"))


@query
def accumulate_periods(spark, sf):
    rows = pings(spark, sf).select("event_id", "mmsi", "dt_pos_utc")
    path = work_folder(spark)
    for period, start, end in (
        ("first", "2024-01-01", "2024-01-15"), ("second", "2024-01-16", "2024-01-31"), ("first", "2024-01-01", "2024-01-15")
    ):
        writers.accumulate(spark, readers.in_period(rows, start, end), path, period)
    return writers.accumulated(spark, path)


LEG_COLUMNS = [
    "mmsi", "dt_pos_utc", "Port_Country_Origin", "Port_Country_Destination", "lat_destination", "lon_destination",
    "Country_Origin", "Country_Destination",
]
THIRDS = (("2024-01a", "2024-01-01", "2024-01-10"), ("2024-01b", "2024-01-11", "2024-01-20"), ("2024-01c", "2024-01-21", "2024-12-31"))


@query
def voyage_legs_by_period(spark, sf):
    target = work_folder(spark)
    for period, start, end in THIRDS:
        periods.add_voyages(
            readers.in_period(pings(spark, sf), start, end), view(spark, sf, "port_cells"), target, period, tiebreak=TIE, slice_seconds=SLICE
        )
    return periods.voyage_legs(spark, target).select(*LEG_COLUMNS)


@query
def port_visits_by_period(spark, sf):
    target = work_folder(spark)
    for period, start, end in THIRDS:
        periods.add_visits(readers.in_period(port_tagged(spark, sf), start, end), target, period, slice_seconds=SLICE)
    return periods.port_visits(spark, target, slice_seconds=SLICE)


@query
def stop_events_by_period(spark, sf):
    target = work_folder(spark)
    for period, start, end in (("a", "2024-01-01", "2024-01-09"), ("b", "2024-01-10", "2024-01-19"), ("c", "2024-01-20", "2024-12-31")):
        part = readers.in_period(grid_pings(spark, sf), start, end)
        periods.add_stops(part, target, period, 8, TIE, slice_seconds=86400)
    return rounded(periods.stop_events(spark, target))


@query
def stored_cells(spark, sf):
    cells = areas.zone_cells(aoi(spark, sf), 9)
    return writers.write_cells(cells, work_folder(spark))


# ---- projections, filters, labels ----------------------------------------------


@query
def distinct_rows(spark, sf):
    return pings(spark, sf).select("mmsi", "site", "nav_status", "sog").distinct()


@query
def keep_listed_columns(spark, sf):
    return columns.keep_columns(pings(spark, sf), ["sog", "event_id", "MMSI", "no_such_column"])


@query
def drop_listed_columns(spark, sf):
    keep = {"event_id", "draught", "site"}
    p = pings(spark, sf)
    return p.drop(*[c for c in p.columns if c not in keep], "no_such_column")


@query
def register_conflicts(spark, sf):
    renamed = joins.prefix_conflicts(view(spark, sf, "register"), pings(spark, sf))
    return renamed.select("MaritimeMobileServiceIdentityMMSINumber", "ihs_flag_country")


@query
def register_match(spark, sf):
    p = pings(spark, sf)
    r = joins.prefix_conflicts(view(spark, sf, "register"), p)
    return joins.match_register(
        p, r, "MaritimeMobileServiceIdentityMMSINumber", "LRIMOShipNo", "ShipName"
    ).select("event_id", "mmsi", "ihs_matchtype", "ShipName")


@query
def matched_pings(spark, sf):
    return columns.matched_only(register_match(spark, sf))


FIXES = [("V3", "Gas Tanker", "Lpg Tanker"), ("V5", "Bulk Carrier", None), ("V3", "Tug", None)]


@query
def type_overrides(spark, sf):
    return columns.override_types(pings(spark, sf), FIXES).select(
        "event_id", "vessel_name", "vessel_type_main", "vessel_type_sub"
    )


@query
def box_filter(spark, sf):
    return columns.in_box(pings(spark, sf), llx=103.0, lly=-3.0, urx=112.01, ury=3.01).select(
        "event_id", F.col("geom.lon").alias("x"), F.col("geom.lat").alias("y")
    )


@query
def port_position(spark, sf):
    return port_tagged(spark, sf).select("event_id", "Kode", labels.in_or_out("h3_ids_int").alias("position"))


@query
def owner_tags(spark, sf):
    return pings(spark, sf).select(
        "event_id",
        labels.home_or_foreign("GroupBeneficialOwnerCountryofDomicile").alias("status_country_domicile"),
        labels.home_or_foreign("GroupBeneficialOwnerCountryOfRegistration").alias("status_country_register"),
        labels.home_or_foreign("flag_country").alias("status_country_flag"),
    )


@query
def report_period(spark, sf):
    return columns.report_period(
        pings(spark, sf), "dt_pos_utc", port="P3", port_column="destination", day=12, month=1, year=2024
    ).select("event_id", "destination")


@query
def small_ports_left_out(spark, sf):
    codes = ports.SMALL_PORTS
    coded = pings(spark, sf).withColumn(
        "Kode",
        F.when(F.col("site") < len(codes), F.lower(F.element_at(F.array(*map(F.lit, codes)), F.least(F.col("site") + 1, F.lit(len(codes))).cast("int")))).otherwise("BLW"),
    )
    return ports.without_small_ports(coded, 8).select("event_id", "Kode")


@query
def unix_time(spark, sf):
    return columns.with_unix_time(pings(spark, sf)).select("event_id", "cluster_time")


@query
def calendar_fields(spark, sf):
    t = "dt_pos_utc"
    text = columns.as_timestamp(pings(spark, sf).withColumn("stamp", F.date_format(t, "yyyy-MM-dd HH:mm:ss")), "stamp")
    return text.select(
        "event_id", labels.date_text(t).alias("date_text"), F.to_date(t).alias("date"), F.year(t).alias("year"),
        F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.unix_timestamp("stamp").alias("stamp_unix"),
    )


@query
def port_names(spark, sf):
    codes = pings(spark, sf).withColumn(
        "code", F.element_at(F.array(*[F.lit(c) for c in ("BLW", "NAM", "LQA", "ZZZ", "BIT", "TTK", "CLG")]), (F.col("mmsi") % 7 + 1).cast("int"))
    )
    return codes.select("event_id", "code", ports.port_name("code").alias("nama_pelabuhan"))


@query
def country_text(spark, sf):
    calls = joins.pings_in_ports(pings(spark, sf), view(spark, sf, "port_cells"), "H3_int_index_8")
    return calls.select(
        "event_id", labels.country_of("Port_Country").alias("country"), labels.country_of("nav_status").alias("plain")
    )


@query
def stay_estimates(spark, sf):
    seen = sequence.neighbours(
        columns.with_unix_time(pings(spark, sf)).select("mmsi", *ORDER, "cluster_time"),
        ORDER,
        back={"t1": ("cluster_time", 1)},
        ahead={"t3": ("cluster_time", 1), "t4": ("cluster_time", 2)},
        slice_seconds=SLICE,
    )
    lower, upper = labels.stay_estimates("t1", "cluster_time", "t3", "t4")
    return seen.select("event_id", lower.alias("time_lower"), upper.alias("time_upper"))


@query
def observation_thresholds(spark, sf):
    event_min, ship_min = labels.observation_thresholds(F.upper("vessel_type"))
    return pings(spark, sf).select("event_id", event_min.alias("event_min"), ship_min.alias("ship_min"))


# ---- joins ---------------------------------------------------------------------


@query
def pings_in_ports(spark, sf):
    return joins.pings_in_ports(pings(spark, sf), view(spark, sf, "port_cells"), "H3_int_index_8").select(
        "event_id", "mmsi", "Port_Country", "boundary_h3"
    )


@query
def buffer_tag(spark, sf):
    cells = areas.buffer_cells(aoi(spark, sf), 10000.0, 8)
    return joins.tag_buffer(grid_pings(spark, sf), cells).select("event_id", "boundary_h3")


@query
def keep_in_buffer(spark, sf):
    cells = areas.buffer_cells(aoi(spark, sf), 10000.0, 8)
    return joins.keep_in_buffer(grid_pings(spark, sf), cells).select("event_id", "boundary_h3")


@query
def buffer_run_tag(spark, sf):
    runs = areas.buffer_runs(aoi(spark, sf), 10000.0, 8)
    return joins.tag_runs(grid_pings(spark, sf), runs, "in_buffer", 8).select("event_id", "in_buffer")


@query
def keep_in_runs(spark, sf):
    runs = areas.buffer_runs(aoi(spark, sf), 10000.0, 8)
    return joins.keep_in_runs(grid_pings(spark, sf), runs, 8).select("event_id", "H3_int_index_8")


@query
def zone_run_flags(spark, sf):
    asia = areas.zone_runs(aoi(spark, sf).filter("TERRITORY1 = 'ASIA'"), 9)
    return zones.tag_zone_runs(grid_pings(spark, sf, 9), asia, "in_zone", 9).select("event_id", "in_zone")


@query
def zone_flags(spark, sf):
    tagged = zones.tag_zone(strait_tagged(spark, sf), zone(spark, sf, "home"), "is_indo")
    return tagged.select("event_id", "is_hormuz", "is_indo")


@query
def ships_seen_in_port(spark, sf):
    rows = visits.visit_pings(port_tagged(spark, sf))
    return visits.ships_seen_in_port(rows).select("mmsi", "dt_pos_utc", "position")


@query
def keyed_join_inner(spark, sf):
    j = joins.keyed_join(table(spark, sf, "orders"), table(spark, sf, "customer"), "o_custkey", "c_custkey", "INNER")
    return j.select("o_orderkey", "c_name")


@query
def keyed_join_left_all(spark, sf):
    number = "MaritimeMobileServiceIdentityMMSINumber"
    j = joins.keyed_join(pings(spark, sf).select("event_id", "mmsi"), view(spark, sf, "register"), "mmsi", number, "LEFT", "All")
    return j.select("event_id", "ShipName")


@query
def keyed_join_left_nulls(spark, sf):
    number = "MaritimeMobileServiceIdentityMMSINumber"
    j = joins.keyed_join(pings(spark, sf).select("event_id", "mmsi"), view(spark, sf, "register"), "mmsi", number, "LEFT", "NullsOnly")
    return j.select("event_id", number, "ShipName")


@query
def pings_with_register(spark, sf):
    return joins.pings_with_register(pings(spark, sf), view(spark, sf, "register")).select(
        "event_id", "ShipStatus", "ShipName", "ShiptypeLevel5", "flag_country"
    )


@query
def pings_without_register(spark, sf):
    return joins.pings_without_register(pings(spark, sf), view(spark, sf, "register")).select("event_id", "mmsi")


@query
def points_in_areas(spark, sf):
    found = areas.points_in_areas(pings(spark, sf).select("event_id", "longitude", "latitude"), aoi(spark, sf).select("Kode", "Prov_ID", "geom"), 10)
    return found.select("Kode", "Prov_ID", "event_id")


@query
def ship_type_port_combinations(spark, sf):
    named = joins.pings_with_register(pings(spark, sf), view(spark, sf, "register"))
    at_port = named.join(
        joins.sized(view(spark, sf, "port_cells").withColumnRenamed("Port", "port_name")),
        F.col("H3_int_index_8") == F.col("boundary_h3"),
    )
    return joins.ship_type_port_combinations(at_port)


# ---- cleaning ------------------------------------------------------------------


@query
def enough_pings(spark, sf):
    return clean.enough_pings(pings(spark, sf), 65).select("event_id", "mmsi")


@query
def active_ships(spark, sf):
    return clean.active_ships_only(pings(spark, sf)).select("event_id", "mmsi")


@query
def preprocess(spark, sf):
    p = pings(spark, sf)
    return jobs.preprocess(
        p.unionByName(p), view(spark, sf, "register"), "MaritimeMobileServiceIdentityMMSINumber", "LRIMOShipNo",
        "ShipName", FIXES,
    )


# ---- voyages -------------------------------------------------------------------


@query
def port_traffic_all(spark, sf):
    home = area_ports(spark, sf).filter("Country = 'Indonesia'")
    foreign = area_ports(spark, sf).filter("Country <> 'Indonesia'")
    return rounded(jobs.port_traffic(grid_pings(spark, sf), home, foreign, TIE, SLICE)["all"])


@query
def port_traffic_inbound(spark, sf):
    return voyages.traffic_inbound(simple_legs(spark, sf))


@query
def port_traffic_outbound(spark, sf):
    return voyages.traffic_outbound(simple_legs(spark, sf))


def _traffic_written(spark, sf, name):
    home, foreign = (area_ports(spark, sf).filter(f"Country {sign} 'Indonesia'") for sign in ("=", "<>"))
    return jobs.write_port_traffic(grid_pings(spark, sf), home, foreign, work_folder(spark), TIE, SLICE)[name]


@query
def port_traffic_all_written(spark, sf):
    return rounded(_traffic_written(spark, sf, "all"))


@query
def port_traffic_inbound_written(spark, sf):
    return _traffic_written(spark, sf, "inbound")


@query
def port_traffic_outbound_written(spark, sf):
    return _traffic_written(spark, sf, "outbound")


@query
def port_call_runs(spark, sf):
    return simple_calls(spark, sf).select("mmsi", "dt_pos_utc", "Port_Country")


@query
def ships_with_several_calls(spark, sf):
    return voyages.ships_with_several_calls(simple_calls(spark, sf)).select("mmsi", "dt_pos_utc", "Port_Country")


@query
def voyage_legs(spark, sf):
    return simple_legs(spark, sf).select(*LEG_COLUMNS)


@query
def home_routes(spark, sf):
    return voyages.international(simple_legs(spark, sf)).select(
        "mmsi", "dt_pos_utc", "Country_Origin", "Country_Destination"
    )


@query
def first_inbound_legs(spark, sf):
    first = sequence.first_by_rank(voyages.inbound(simple_legs(spark, sf)), "mmsi", "dt_pos_utc")
    return first.select("mmsi", "dt_pos_utc", "Port_Country_Origin", "Port_Country_Destination")


@query
def port_list_union(spark, sf):
    home = area_ports(spark, sf).filter("Country = 'Indonesia'")
    foreign = area_ports(spark, sf).filter("Country <> 'Indonesia'").select(
        "boundary_h3", "Port_Country", "Country", "Port"
    )
    return rounded(voyages.with_centres(voyages.union_ports(home, foreign)))


# ---- zones ---------------------------------------------------------------------


@query
def first_last_in_zone(spark, sf):
    return zones.first_last_in_zone(strait_tagged(spark, sf), "is_hormuz", ("mmsi", "vessel_type"))


@query
def ever_in_zone(spark, sf):
    return zones.ever_in_zone(strait_tagged(spark, sf), "is_hormuz")


@query
def activity_with_zone_history(spark, sf):
    return flagged_activity(spark, sf).select(
        "mmsi", "dt_pos_utc", "Port", "is_through_hormuz", "first_detected_hormuz", "last_detected_hormuz"
    )


@query
def zone_edges(spark, sf):
    tagged = zones.tag_zone(strait_tagged(spark, sf), zone(spark, sf, "home"), "is_indo")
    return zones.zone_edges(tagged, "is_hormuz", "is_indo", TIE, SLICE).select(
        "mmsi", "dt_pos_utc", F.col("exit").alias("zone_exit"), F.col("entry").alias("zone_entry")
    )


@query
def time_travel(spark, sf):
    return rounded(
        jobs.time_travel(
            pings(spark, sf), zone(spark, sf, "strait"), zone(spark, sf, "home"), tiebreak=TIE, slice_seconds=SLICE
        ),
        9,
    )


# ---- visits --------------------------------------------------------------------


@query
def visit_edges(spark, sf):
    rows = visits.edge_rows(visits.visit_pings(port_tagged(spark, sf)), slice_seconds=SLICE)
    return rows.select("mmsi", "dt_pos_utc", "Port", "position")


@query
def port_visits(spark, sf):
    return activity(spark, sf)


@query
def port_visits_by_port_change(spark, sf):
    return visits.port_visits_by_port_change(port_tagged(spark, sf), slice_seconds=SLICE)


@query
def port_visits_from_areas(spark, sf):
    keys = aoi(spark, sf).select("Kode", "Prov_ID", "Hirarki_1", "method", "geom")
    return jobs.boundary(grid_pings(spark, sf), keys, "Manual", 8, slice_seconds=SLICE)


@query
def port_visits_from_areas_draft(spark, sf):
    keys = aoi(spark, sf).select("Kode", "Prov_ID", "Hirarki_1", "method", "geom")
    return jobs.boundary(grid_pings(spark, sf), keys, "Manual", 8, draft=True, slice_seconds=SLICE)


@query
def port_visits_in_buffer(spark, sf):
    keys = aoi(spark, sf).select("Kode", "Prov_ID", "Hirarki_1", "method", "geom")
    return jobs.boundary(
        grid_pings(spark, sf), keys, "Cluster", 8, 10000.0, buffer_mode="filter", slice_seconds=SLICE
    ).select("mmsi", "dt_pos_utc", "Port", "position", "masuk_pelabuhan", "keluar_pelabuhan", "time")


@query
def arrivals(spark, sf):
    return visits.arrivals(activity(spark, sf), 30).select("mmsi", "dt_pos_utc", "Port", "time")


@query
def departures(spark, sf):
    return visits.departures(activity(spark, sf)).select("mmsi", "dt_pos_utc", "Port", "time")


@query
def departures_after_stay(spark, sf):
    return visits.departures(activity(spark, sf), 30, slice_seconds=SLICE).select(
        "mmsi", F.col("dt_pos_utc").alias("date"), "Port", "latitude"
    )


# ---- reports -------------------------------------------------------------------


@query
def arrival_recap(spark, sf):
    return reports.recap_visits(activity(spark, sf), port_time_limit=30)


@query
def arrival_recap_of_port(spark, sf):
    return reports.recap_visits(activity(spark, sf), port_code="BLW", port_time_limit=30)


@query
def vessels_departed_through_zone(spark, sf):
    return reports.vessel_list(flagged_activity(spark, sf), True, "departed", slice_seconds=SLICE)


@query
def departure_recap(spark, sf):
    return reports.recap_visits(activity(spark, sf), "departed", month_obs=1, port_time_limit=30, slice_seconds=SLICE)


@query
def arrival_recap_with_zone(spark, sf):
    tables = jobs.port_call(
        pings(spark, sf), activity(spark, sf), zone(spark, sf, "strait"), tiebreak=TIE, slice_seconds=SLICE
    )
    return tables["arrival_recap"]


@query
def departure_recap_with_zone(spark, sf):
    return reports.recap_visits_with_zone(
        flagged_activity(spark, sf), "departed", year_obs=2024, port_time_limit=0, slice_seconds=SLICE
    )


def _vessels(spark, sf, name):
    tables = jobs.port_call(
        pings(spark, sf), activity(spark, sf), zone(spark, sf, "strait"), tiebreak=TIE, slice_seconds=SLICE
    )
    return tables[name]


@query
def vessels_through_zone(spark, sf):
    return _vessels(spark, sf, "through")


@query
def vessels_not_through_zone(spark, sf):
    return _vessels(spark, sf, "not_through")


def _calls_written(spark, sf, name):
    return jobs.write_port_call(
        pings(spark, sf), activity(spark, sf), zone(spark, sf, "strait"), work_folder(spark), tiebreak=TIE, slice_seconds=SLICE
    )[name]


@query
def vessels_through_zone_written(spark, sf):
    return _calls_written(spark, sf, "through")


@query
def arrival_recap_with_zone_written(spark, sf):
    return _calls_written(spark, sf, "arrival_recap")


@query
def latest_ship_attributes(spark, sf):
    return sequence.latest_per_ship(pings(spark, sf), [*SHIP_ATTRIBUTES, "nav_status"], ORDER)


@query
def earliest_row_per_key(spark, sf):
    return sequence.earliest_per_key(pings(spark, sf), ["mmsi", "site"], ORDER).select(
        "mmsi", "site", "event_id", "nav_status"
    )


@query
def time_in_port_by_port(spark, sf):
    return rounded(reports.summarize_time_in_port(activity(spark, sf), ["Port", "date"], "boundary"))


@query
def time_in_port_of_stops(spark, sf):
    return rounded(reports.summarize_time_in_port(stop_table(spark, sf), ["vessel_type", "day"], "stationary"))


@query
def stay_hours_summary(spark, sf):
    return rounded(reports.summarize_stay_hours(stop_table(spark, sf), ["source", "year", "month", "day"]))


@query
def stay_hours_by_period(spark, sf):
    target, found = work_folder(spark), kept(spark, stop_table(spark, sf))
    for period, rule in (("a", "day(obs_time) <= 8"), ("b", "day(obs_time) between 9 and 17"), ("c", "day(obs_time) > 17")):
        periods.add_durations(reports.stop_sketches(found.filter(rule), ["source", "vessel_type", "day"]), target, period)
    return rounded(periods.durations(spark, target, ["source"]))


@query
def time_in_port_by_period(spark, sf):
    target, found = work_folder(spark), kept(spark, activity(spark, sf))
    for period, rule in (("a", "day(dt_pos_utc) <= 10"), ("b", "day(dt_pos_utc) > 10")):
        periods.add_durations(reports.visit_sketches(found.filter(rule), ["Port", "date"]), target, period)
    return rounded(periods.durations(spark, target, ["Port"]))


# ---- stop events ---------------------------------------------------------------


@query
def stop_events(spark, sf):
    return rounded(stop_table(spark, sf))


@query
def stop_events_compat(spark, sf):
    return rounded(stop_table(spark, sf, compat=True))


@query
def stop_events_as_boxes(spark, sf):
    return stop_table(spark, sf, geometry="box", factor=2.0).select("mmsi", "unix_trigger", "geom_wkt")


@query
def stop_event_profiles(spark, sf):
    found = stops.stop_event_profiles(grid_pings(spark, sf), 3, 8, TIE, slice_seconds=SLICE)
    return rounded_spread(found)


@query
def stationary(spark, sf):
    found = stops.stationary(
        grid_pings(spark, sf, 10), aoi(spark, sf).filter("method = 'Manual'"), tiebreak=TIE, slice_seconds=SLICE
    )
    return rounded(found)


@query
def stops_in_ports(spark, sf):
    return stops.stops_in_ports(stop_table(spark, sf), aoi(spark, sf), ["Kode", "Prov_ID"], 8).select(
        "mmsi", "unix_trigger", "Kode", "Prov_ID"
    )


@query
def stop_arrivals(spark, sf):
    return reports.recap_stops(port_stops(spark, sf), "arrival", month_obs=1, events="events")


@query
def stop_departures(spark, sf):
    return reports.recap_stops(port_stops(spark, sf), "departed", year_obs=2024, events="events")


@query
def status_mode_last(spark, sf):
    return stats.mode_per_key(pings(spark, sf), ["mmsi", "site"], "nav_status", F.struct(*ORDER), 1)


@query
def status_mode_first(spark, sf):
    return stats.mode_per_key(pings(spark, sf), ["mmsi", "site"], "nav_status", F.struct(*ORDER), 0)


@query
def status_mode_all(spark, sf):
    return stats.mode_per_key(pings(spark, sf), ["mmsi", "site"], "nav_status", F.struct(*ORDER), "all")


@query
def position_spread(spark, sf):
    return rounded_spread(stats.group_spread(pings(spark, sf), ["mmsi", "site"], "latitude", "longitude", 3))


# ---- cells and geometry --------------------------------------------------------


@query
def point_cells(spark, sf):
    return pings(spark, sf).select(
        "event_id",
        grid.cell_at("latitude", "longitude", 5).alias("cell_5"),
        grid.cell_at("latitude", "longitude", 8).alias("cell_8"),
        grid.cell_at("latitude", "longitude", 10).alias("cell_10"),
    )


@query
def cell_texts(spark, sf):
    g = grid_pings(spark, sf)
    return g.select(
        "event_id", grid.cell_to_text("H3_int_index_8").alias("cell_text"),
        grid.text_to_cell(grid.cell_to_text("H3_int_index_8")).alias("cell"),
    )


@query
def cell_centres(spark, sf):
    c = grid_pings(spark, sf).select("H3_int_index_8").distinct()
    centre = grid.centre("H3_int_index_8")
    return rounded(c.select("H3_int_index_8", centre["lat"].alias("lat"), centre["lon"].alias("lon")))


@query
def area_cells(spark, sf):
    return areas.port_cells(aoi(spark, sf), ["Kode"], 10)


@query
def zone_union_cells(spark, sf):
    return areas.zone_cells(aoi(spark, sf).filter("TERRITORY1 = 'ASIA'"), 9)


@query
def buffer_cells(spark, sf):
    return areas.buffer_cells(aoi(spark, sf), 10000.0, 10)


@query
def cell_rings(spark, sf):
    c = grid_pings(spark, sf).select("H3_int_index_8").distinct()
    return c.select("H3_int_index_8", F.explode(grid.ring("H3_int_index_8", 2)).alias("neighbour"))


@query
def ring_membership(spark, sf):
    seen = sequence.neighbours(
        grid_pings(spark, sf).select("mmsi", *ORDER, "H3_int_index_8"), ORDER,
        back={"before": ("H3_int_index_8", 1)}, slice_seconds=SLICE,
    )
    return seen.select("event_id", grid.within_ring("H3_int_index_8", "before", 1).alias("near"))


@query
def point_grid_distances(spark, sf):
    seen = sequence.neighbours(
        pings(spark, sf).select("mmsi", *ORDER, "latitude", "longitude"), ORDER,
        back={"lat0": ("latitude", 1), "lon0": ("longitude", 1)}, slice_seconds=SLICE,
    )
    return seen.select(
        "event_id", grid.point_grid_distance("lat0", "lon0", "latitude", "longitude", 6).alias("steps")
    )


@query
def resolution_checks(spark, sf):
    mixed = F.when(F.col("event_id") % 2 == 0, grid.cell_at("latitude", "longitude", 9)).otherwise(
        grid.cell_at("latitude", "longitude", 8)
    )
    g = grid_pings(spark, sf).withColumn("other", mixed)
    return g.select(
        "event_id", grid.resolution_of("other").alias("resolution"),
        grid.same_resolution("H3_int_index_8", "other").alias("same"),
    )


@query
def great_circle_metres(spark, sf):
    seen = sequence.neighbours(
        pings(spark, sf).select("mmsi", *ORDER, "latitude", "longitude"), ORDER,
        back={"lat0": ("latitude", 1), "lon0": ("longitude", 1)}, slice_seconds=SLICE,
    )
    return seen.select(
        "event_id", F.round(geo.haversine_m("lat0", "lon0", "latitude", "longitude"), 3).alias("metres"),
        geo.haversine_m("lat0", "lon0", F.col("latitude") + 100.0, "longitude").alias("out_of_range"),
    )


@query
def wkt_texts(spark, sf):
    return pings(spark, sf).select(
        "event_id",
        geo.point_wkt("latitude", "longitude").alias("point"),
        geo.tri_line_wkt("latitude", "longitude", "cog", "sog", "Depth", "width").alias("line"),
        geo.spread_box_wkt("latitude", "longitude", "sog", "Depth", 2.0).alias("box"),
    )


@query
def wkt_rings(spark, sf):
    g = aoi(spark, sf).select("Kode", F.posexplode("geom").alias("ring", "points"))
    return g.select("Kode", "ring", F.posexplode("points").alias("i", "p")).select(
        "Kode", "ring", "i", F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat")
    )


# ---- pings that share their time, with default orders ----------------------------


@query
def stop_events_tied(spark, sf):
    placed = tied_pings(spark, sf).withColumn("H3_int_index_8", grid.cell_at("latitude", "longitude", 8))
    return rounded(stops.stop_events(placed, 8, slice_seconds=SLICE))


@query
def port_call_runs_tied(spark, sf):
    calls = voyages.port_calls(tied_pings(spark, sf), view(spark, sf, "port_cells"), slice_seconds=SLICE)
    return calls.select("mmsi", "dt_pos_utc", "Port_Country")


@query
def visit_edges_tied(spark, sf):
    rows = visits.visit_pings(joins.tag_ports(tied_pings(spark, sf), view(spark, sf, "aoi_cells")))
    return visits.edge_rows(rows, slice_seconds=SLICE).select("mmsi", "dt_pos_utc", "Port", "position")


@query
def zone_edges_tied(spark, sf):
    tagged = zones.tag_zone(tied_pings(spark, sf), zone(spark, sf, "strait"), "is_hormuz")
    tagged = zones.tag_zone(tagged, zone(spark, sf, "home"), "is_indo")
    return zones.zone_edges(tagged, "is_hormuz", "is_indo", slice_seconds=SLICE).select(
        "mmsi", "dt_pos_utc", F.col("exit").alias("zone_exit"), F.col("entry").alias("zone_entry")
    )


# ---- one ship with most pings, cut into parts of equal count -----------------------


@query
def stop_events_crowded(spark, sf):
    placed = crowded_pings(spark, sf).withColumn("H3_int_index_8", grid.cell_at("latitude", "longitude", 8))
    return rounded(stops.stop_events(placed, 8, TIE, slice_seconds=CUT))


@query
def port_call_runs_crowded(spark, sf):
    calls = voyages.port_calls(crowded_pings(spark, sf), view(spark, sf, "port_cells"), tiebreak=TIE, slice_seconds=CUT)
    return calls.select("mmsi", "dt_pos_utc", "Port_Country")


@query
def visit_edges_crowded(spark, sf):
    rows = visits.visit_pings(joins.tag_ports(crowded_pings(spark, sf), view(spark, sf, "aoi_cells")))
    return visits.edge_rows(rows, slice_seconds=CUT).select("mmsi", "dt_pos_utc", "Port", "position")


@query
def port_visits_crowded(spark, sf):
    return visits.port_visits(joins.tag_ports(crowded_pings(spark, sf), view(spark, sf, "aoi_cells")), slice_seconds=CUT)


@query
def port_visits_by_port_change_crowded(spark, sf):
    tagged = joins.tag_ports(crowded_pings(spark, sf), view(spark, sf, "aoi_cells"))
    return visits.port_visits_by_port_change(tagged, slice_seconds=CUT)


@query
def zone_edges_crowded(spark, sf):
    tagged = zones.tag_zone(crowded_pings(spark, sf), zone(spark, sf, "strait"), "is_hormuz")
    tagged = zones.tag_zone(tagged, zone(spark, sf, "home"), "is_indo")
    return zones.zone_edges(tagged, "is_hormuz", "is_indo", TIE, CUT).select(
        "mmsi", "dt_pos_utc", F.col("exit").alias("zone_exit"), F.col("entry").alias("zone_entry")
    )
