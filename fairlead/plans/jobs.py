"""The standard jobs, end to end. Each takes and returns DataFrames; nothing passes
through the driver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions import grid, labels
from fairlead.operators import areas, clean, joins, reports, sequence, stops, visits, voyages, zones
from fairlead.schemas import PORT_RESOLUTION, REGION_RESOLUTION, SHIP_ATTRIBUTES
from fairlead.sources import readers, writers


def ingest(
    pings: DataFrame,
    region_areas: DataFrame,
    start: date | str,
    end: date | str,
    resolution: int = REGION_RESOLUTION,
    territory: str = labels.HOME_COUNTRY,
    territory_column: str = "TERRITORY1",
) -> DataFrame:
    """Every ping in the period of ships that were in the territory's areas."""
    region = region_areas.filter(F.col(territory_column) == territory)
    return readers.pings_of_ships_seen_in_runs(pings, areas.zone_runs(region, resolution), resolution, start, end)


preprocess = clean.preprocess


def port_traffic(
    pings: DataFrame,
    home_ports: DataFrame,
    foreign_ports: DataFrame,
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> dict[str, DataFrame]:
    """Route counts: all international, first inbound and first outbound legs."""
    ports = voyages.with_centres(voyages.union_ports(home_ports, foreign_ports))
    legs = voyages.international_legs(pings, ports, tiebreak=tiebreak, slice_seconds=slice_seconds)
    return {
        "all": voyages.traffic_all(legs).orderBy(F.desc("count")),
        "inbound": voyages.traffic_inbound(legs).orderBy(F.desc("count")),
        "outbound": voyages.traffic_outbound(legs).orderBy(F.desc("count")),
    }


def write_port_traffic(
    pings: DataFrame,
    home_ports: DataFrame,
    foreign_ports: DataFrame,
    folder: str,
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> dict[str, DataFrame]:
    """The outputs of :func:`port_traffic` as tables below ``folder``, read back. The pings are read and shuffled
    once: their international legs, some thousandths of them, are written first and all three outputs start from these."""
    ports = voyages.with_centres(voyages.union_ports(home_ports, foreign_ports))
    legs = voyages.international_legs(pings, ports, tiebreak=tiebreak, slice_seconds=slice_seconds)
    legs = _written(legs, folder, "legs")
    counts = {
        "all": voyages.traffic_all(legs), "inbound": voyages.traffic_inbound(legs), "outbound": voyages.traffic_outbound(legs)
    }
    return {name: _written(df.orderBy(F.desc("count")), folder, name) for name, df in counts.items()}


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = writers.write_parquet(df, f"{folder.rstrip('/')}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boundary(
    pings: DataFrame,
    aoi: DataFrame,
    method: str = "Manual",
    resolution: int = PORT_RESOLUTION,
    buffer_radius_m: float = 10000.0,
    buffer_mode: str = "tag",
    draft: bool = False,
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> DataFrame:
    """Port visits from area outlines. ``buffer_mode="tag"`` looks at all pings, as the
    published results do; ``"filter"`` only at pings inside the buffer."""
    if buffer_mode not in ("tag", "filter"):
        raise ValueError("buffer_mode must be 'tag' or 'filter'")
    cell = joins.cell_column(resolution)
    joins.require(pings, cell)
    # Filled outlines only match cells of this lattice; others would silently match nothing.
    pings = pings.withColumn(cell, grid.own(cell))
    chosen = areas.select_method(aoi, method)
    if method == "Manual" and not draft:
        from fairlead.functions.ports import without_small_ports

        chosen = without_small_ports(chosen, resolution)
    if buffer_mode == "filter":
        pings = joins.keep_in_runs(pings, areas.buffer_runs(chosen, buffer_radius_m, resolution), resolution)
    keys = [c for c in chosen.columns if c not in ("geom", "method")]
    tagged = joins.tag_ports(pings, visits.outer_ports(areas.area_cells(chosen, keys, resolution)), resolution)
    detect = visits.port_visits_by_port_change if draft else visits.port_visits
    return detect(tagged, cell, slice_seconds=slice_seconds)


def port_call(
    pings: DataFrame,
    activity: DataFrame,
    strait_cells: DataFrame,
    port_time_limit: int = 30,
    cell: str = "H3_int_index_8",
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> dict[str, DataFrame]:
    """Strait tags, ship lists through / not through the strait, and the arrival recap."""
    tagged = zones.tag_zone(pings, strait_cells, "is_hormuz", cell)
    flagged = zones.flag_activity(activity, zones.zone_history(tagged, "is_hormuz"))

    def listed(through: bool) -> DataFrame:
        rows = reports.vessel_list(
            flagged, through, port_time_limit=port_time_limit, slice_seconds=slice_seconds, cell=cell
        )
        return reports.with_latest_attributes(rows, pings, SHIP_ATTRIBUTES, tiebreak)

    recap = reports.recap_visits_with_zone(flagged, port_time_limit=port_time_limit, slice_seconds=slice_seconds)
    dates = {c: labels.date_text(c) for c in ("first_detected_hormuz", "last_detected_hormuz")}
    return {
        "tagged": tagged,
        "through": listed(True),
        "not_through": listed(False),
        "arrival_recap": recap.withColumns(dates),
    }


def write_port_call(
    pings: DataFrame,
    activity: DataFrame,
    strait_cells: DataFrame,
    folder: str,
    port_time_limit: int = 30,
    cell: str = "H3_int_index_8",
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> dict[str, DataFrame]:
    """The outputs of :func:`port_call` as tables below ``folder``, read back.

    The pings are read once, for the tagged table; one pass over its few needed columns gives the zone
    history and the latest attributes of every ship, and the visits with that history are written once for
    both lists and the recap.
    """
    tagged = _written(zones.tag_zone(pings, strait_cells, "is_hormuz", cell), folder, "tagged")
    ships = _written(reports.ship_facts(tagged, "is_hormuz", SHIP_ATTRIBUTES, tiebreak), folder, "ships")
    history = ships.drop(*SHIP_ATTRIBUTES)
    flagged = _written(zones.flag_activity(activity, history), folder, "flagged")

    def listed(through: bool) -> DataFrame:
        rows = reports.vessel_list(flagged, through, port_time_limit=port_time_limit, slice_seconds=slice_seconds, cell=cell)
        return reports.with_ship_attributes(rows, ships.select("mmsi", *SHIP_ATTRIBUTES))

    recap = reports.recap_visits_with_zone(flagged, port_time_limit=port_time_limit, slice_seconds=slice_seconds)
    dates = {c: labels.date_text(c) for c in ("first_detected_hormuz", "last_detected_hormuz")}
    outputs = {"through": listed(True), "not_through": listed(False), "arrival_recap": recap.withColumns(dates)}
    return {"tagged": tagged} | {name: _written(df, folder, name) for name, df in outputs.items()}


def time_travel(
    pings: DataFrame,
    strait_cells: DataFrame,
    home_cells: DataFrame,
    cell: str = "H3_int_index_8",
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> DataFrame:
    """Hours from the last strait exit to the first entry into home waters."""
    order = ["dt_pos_utc", *tiebreak]
    narrow = pings.select("mmsi", *order, cell)
    tagged = zones.tag_zone(zones.tag_zone(narrow, strait_cells, "is_hormuz", cell), home_cells, "is_indo", cell)
    edges = zones.zone_edges(tagged, "is_hormuz", "is_indo", tiebreak, slice_seconds)
    times = zones.transit_times(edges, slice_seconds)
    return zones.with_ship_facts(times, pings, ["vessel_type", "flag_country", "draught"], order)


stationary = stops.stationary
stationary_in_port = stops.stops_in_ports
