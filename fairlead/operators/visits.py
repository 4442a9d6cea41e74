"""Port visits: reduce a ship's pings to the edges of its stays in ports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions import labels
from fairlead.operators import columns, sequence

VISIT_ORDER = ("dt_pos_utc", "Port")


def visit_pings(tagged: DataFrame, cell: str = "H3_int_index_8") -> DataFrame:
    """Port-tagged pings in the activity layout. ``h3_ids_int`` null means outside."""
    return tagged.select(
        "mmsi",
        "vessel_name",
        columns.pick_variant(tagged, "Prov_ID", "kd_prov"),
        columns.pick_variant(tagged, "Kode", "kode").alias("Port"),
        columns.pick_variant(tagged, "Hirarki_1", "kode_hirar"),
        "dt_pos_utc",
        F.col("flag_country").alias("fc_vessel"),
        "GroupBeneficialOwnerCountryofDomicile",
        "GroupBeneficialOwnerCountryOfRegistration",
        "RegisteredOwnerCountryofDomicile",
        "vessel_type",
        "vessel_type_main",
        "vessel_type_sub",
        F.col("nav_status").alias("ns_vessel"),
        "draught",
        "sog",
        labels.in_or_out("h3_ids_int").alias("position"),
        "latitude",
        "longitude",
        cell,
    )


def ships_seen_in_port(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Rows (by default of ``df`` itself) of ships with at least one ping of ``df`` in a port."""
    ships = df.filter(F.col("position") == "in").select("mmsi").distinct()
    return (df if rows is None else rows).join(ships, "mmsi", "left_semi")


def distinct_pings(
    df: DataFrame, slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS, order: Sequence[str] = VISIT_ORDER
) -> DataFrame:
    """Full-row dedup on the (ship, slice) partitioning the next step needs anyway, so
    the dedup brings no shuffle of its own. ``_slice`` stays, for that step to find."""
    return sequence.with_slices(df, order, slice_seconds).repartition("mmsi", "_slice").dropDuplicates()


def keep_edges(
    df: DataFrame,
    order: Sequence[str] = VISIT_ORDER,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
    keep_slice: bool = False,
) -> DataFrame:
    """Keep a ship's first and last row, and rows with exactly one neighbour on the
    other side of the port limit."""
    prev_other = F.col("_prev") != F.col("position")
    next_other = F.col("_next") != F.col("position")
    return sequence.neighbours(
        df,
        order,
        back={"_prev": ("position", 1)},
        ahead={"_next": ("position", 1)},
        slice_seconds=slice_seconds,
        keep=F.coalesce(prev_other != next_other, F.lit(True)),
        keep_slice=keep_slice,
    ).drop("_prev", "_next")


def edge_rows(
    pings: DataFrame, order: Sequence[str] = VISIT_ORDER, slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS
) -> DataFrame:
    """Exactly two passes of :func:`keep_edges` over ships seen in port; the second
    pass looks at the neighbours the first one left.

    The ship test is per ship, so it can wait until the passes have cut the rows down:
    done first, it would shuffle every ping by ship.
    """
    # Both passes work in the same slices: rows that are left are at most as many.
    once = keep_edges(distinct_pings(pings, slice_seconds, order), order, keep_slice=True)
    slice_seconds = sequence.plain(slice_seconds)
    return ships_seen_in_port(pings, keep_edges(once, order, slice_seconds))


def port_visits(
    tagged: DataFrame,
    cell: str = "H3_int_index_8",
    order: Sequence[str] = VISIT_ORDER,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Visit edges with arrival / departure marks and seconds to the next row."""
    edges = edge_rows(visit_pings(tagged, cell), order, slice_seconds)
    slice_seconds = sequence.plain(slice_seconds)
    seen = sequence.neighbours(
        edges,
        order,
        back={"_prev": ("position", 1)},
        ahead={"_next": ("position", 1), "_next_time": ("dt_pos_utc", 1)},
        slice_seconds=slice_seconds,
    )
    return marked(seen).drop("_prev", "_next", "_next_time")


def outer_ports(cells: DataFrame, cell: str = "h3_ids_int") -> DataFrame:
    """Port cells (before ``joins.tag_ports``) with the first and the last port of each cell, in the order of visits.

    A ping in a cell of many ports has a row for each. All of these but the first and last stand between rows
    inside a port, so none can be an edge, and no edge looks at them: port visits come out the same. Ports
    without a name stay all, as they stand among the rows outside every port.
    """
    variants = [("Kode", "kode"), ("Hirarki_1", "kode_hirar"), ("Prov_ID", "kd_prov")]
    # as visit_pings picks them and sorts by them; what it leaves out comes last
    first = [next(c for c in names if c in cells.columns) for names in variants]
    port = first[0]
    place = F.struct(*first, *[c for c in cells.columns if c not in (*first, cell)])
    named_ports = cells.filter(F.col(port).isNotNull())
    ends = named_ports.groupBy(cell).agg(F.array_distinct(F.array(F.min(place), F.max(place))).alias("_ends"))
    outer = ends.select(cell, F.inline("_ends")).select(*cells.columns)
    return outer.unionByName(cells.filter(F.col(port).isNull()))


MARKS = ["masuk_pelabuhan", "keluar_pelabuhan", "time"]


def marked(seen: DataFrame) -> DataFrame:
    """Arrival and departure marks and seconds to the next row, from the neighbours in ``_prev``, ``_next``, ``_next_time``."""
    inside = F.col("position") == "in"
    arrives = F.when(inside, F.col("_prev") == "out").otherwise(F.col("_next") == "in")
    departs = F.when(inside, F.col("_next") == "out").otherwise(F.col("_prev") == "in")
    return seen.withColumns(
        {
            "masuk_pelabuhan": F.when(arrives, "masuk").otherwise("-"),
            "keluar_pelabuhan": F.when(departs, "keluar").otherwise("-"),
            "time": labels.seconds_between("_next_time", "dt_pos_utc"),
        }
    )


def port_visits_by_port_change(
    tagged: DataFrame,
    cell: str = "H3_int_index_8",
    order: Sequence[str] = VISIT_ORDER,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Draft variant that also ends a visit when the port changes without an outside ping.

    Inside rows: arrival if the row before is outside or in another port, departure
    if the row after is. Outside rows: arrival if the next row is inside, departure
    if the previous one is. A missing port never equals another.
    """
    dropped = ("vessel_type_main", "vessel_type_sub", "Prov_ID", "Hirarki_1", "RegisteredOwnerCountryofDomicile")
    edges = edge_rows(visit_pings(tagged, cell).drop("RegisteredOwnerCountryofDomicile"), order, slice_seconds)
    slice_seconds = sequence.plain(slice_seconds)
    beside = {
        "back": {"_prev": ("position", 1), "_prev_port": ("Port", 1)},
        "ahead": {"_next": ("position", 1), "_next_port": ("Port", 1)},
    }
    inside = F.col("position") == "in"
    same_prev = labels.or_false(F.col("_prev_port") == F.col("Port"))
    same_next = labels.or_false(F.col("_next_port") == F.col("Port"))
    at_out = labels.or_false((F.col("_prev") == "out") | (F.col("_next") == "out"))
    last_of_port_run = F.col("_next").isNotNull() & ~same_next
    change = ~inside | ~same_prev | at_out | last_of_port_run
    kept = sequence.neighbours(edges, order, **beside, slice_seconds=slice_seconds, keep=change)
    kept = kept.drop(*beside["back"], *beside["ahead"])
    beside["ahead"]["_next_time"] = ("dt_pos_utc", 1)
    seen = sequence.neighbours(kept, order, **beside, slice_seconds=slice_seconds)
    arrives = F.when(
        inside, (F.col("_prev") == "out") | ((F.col("_prev") == "in") & ~same_prev)
    ).otherwise(F.col("_next") == "in")
    departs = F.when(
        inside, (F.col("_next") == "out") | ((F.col("_next") == "in") & ~same_next)
    ).otherwise(F.col("_prev") == "in")
    return seen.withColumns(
        {
            "masuk_pelabuhan": F.when(arrives, "masuk").otherwise("-"),
            "keluar_pelabuhan": F.when(departs, "keluar").otherwise("-"),
            "time": labels.seconds_between("_next_time", "dt_pos_utc"),
        }
    ).drop(*beside["back"], *beside["ahead"], *dropped)


def arrivals(activity: DataFrame, min_minutes: int = 0) -> DataFrame:
    rows = activity.filter((F.col("masuk_pelabuhan") == "masuk") & (F.col("position") == "in"))
    return rows.filter(F.col("time") >= min_minutes * 60) if min_minutes > 0 else rows


def departures(
    activity: DataFrame,
    min_minutes: int = 0,
    order: Sequence[str] = VISIT_ORDER,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Departures; with a minimum stay the row is the first outside ping, it must
    follow an arrival row two places back that stayed long enough, and it takes the
    port of the row just before it."""
    if min_minutes <= 0:
        return activity.filter((F.col("keluar_pelabuhan") == "keluar") & (F.col("position") == "in"))
    stayed = (
        (F.col("position") == "out")
        & (F.col("keluar_pelabuhan") == "keluar")
        & (F.col("_time2") >= min_minutes * 60)
        & (F.col("_position2") == "in")
        & (F.col("_arrived2") == "masuk")
    )
    seen = sequence.neighbours(
        activity,
        order,
        back={
            "_port1": ("Port", 1),
            "_time2": ("time", 2),
            "_position2": ("position", 2),
            "_arrived2": ("masuk_pelabuhan", 2),
        },
        slice_seconds=sequence.plain(slice_seconds),
        keep=F.coalesce(stayed, F.lit(False)),
    )
    return (
        seen.withColumns({"Port": F.col("_port1"), "dt_pos_utc": F.to_date("dt_pos_utc")})
        .drop("_port1", "_time2", "_position2", "_arrived2")
    )


def movements(
    activity: DataFrame,
    kind: str = "arrival",
    min_minutes: int = 0,
    order: Sequence[str] = VISIT_ORDER,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    if kind == "arrival":
        return arrivals(activity, min_minutes)
    if kind == "departed":
        return departures(activity, min_minutes, order, slice_seconds)
    raise ValueError("activity must be 'arrival' or 'departed'")
