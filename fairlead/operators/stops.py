"""Stopped-ship events.

A ship's pings run through a small state machine: a slow ping opens an event and
anchors it to its cell, the event lasts while pings stay within ``depth`` steps of the
anchor, and the first ping outside closes it (and cannot open another). The anchor
depends on earlier decisions, so lag/lead cannot express it.

To keep one ship from being one task, its pings are cut into time slices and the
machine is run per slice:

1. every slice is summarised, in parallel, by what it does to each state it could be
   entered in. An open event can only survive a slice's first ping if its anchor is
   within ``depth`` steps of it, so there are few such states (37 for depth 3);
2. the summaries of a ship - one row per slice - are chained to find the state each
   slice really starts in;
3. every slice labels its own pings, again in parallel;
4. labelled pings are aggregated per event with ordinary partial aggregation.

The result is the same for every slice length and every partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions import geo, grid, labels
from fairlead.operators import areas, joins, sequence, slices, stats
from fairlead.operators.columns import with_unix_time
from fairlead.schemas import STOP_EVENT_COLUMNS

STOP_SPEED = 1.0
RING_DEPTH = 3


# Wide rows travel once; the summaries need only these.
_NARROW = ("mmsi", "_slice", "_cell", "_slow", "cluster_time", "vessel_type", "imo")
_FACTS = {
    "mmsi": "bigint", "_slice": "bigint", "_unix_before": "bigint", "_unix_after": "bigint", "_ship_pings": "bigint",
    "_ship_type": "string", "_imo_before": "bigint",
}


def placed_pings(
    pings: DataFrame, resolution: int, tiebreak: Sequence[str], slice_seconds: int | sequence.Slicing
) -> tuple[DataFrame, list[str]]:
    """Pings with ship, cell and time, their slice and what the machine looks at; and their total order."""
    cell = joins.cell_column(resolution)
    joins.require(pings, cell, "mmsi", "sog", "dt_pos_utc", "imo", "vessel_type")
    # Every column of the rows breaks ties, so both sorts below see one order.
    order = sequence.total_order(pings, ["dt_pos_utc", *tiebreak])
    timed = (
        pings
        if "cluster_time" in pings.columns
        else with_unix_time(pings)
    ).filter(F.col("mmsi").isNotNull() & F.col(cell).isNotNull() & F.col("dt_pos_utc").isNotNull())
    typed = timed.withColumns({"mmsi": F.col("mmsi").cast("bigint"), "imo": F.col("imo").cast("bigint")})
    rows = sequence.with_slices(typed, order, slice_seconds).withColumns(
        {
            "_cell": grid.own(cell),
            "_slow": F.coalesce(F.col("sog") < STOP_SPEED, F.lit(False)),
        }
    )
    return rows, order


def summaries(rows: DataFrame, order: Sequence[str], depth: int) -> DataFrame:
    """One row per slice: what it does to each state it could be entered in (``slices.SUMMARY``)."""
    sorted_rows = (
        rows.select(*dict.fromkeys([*_NARROW, *order]))
        .repartition("mmsi", "_slice")
        .sortWithinPartitions("mmsi", "_slice", *order)
        .select(*_NARROW)
    )
    return sorted_rows.mapInArrow(slices.summarise(grid.ring_offsets(depth), depth), slices.SUMMARY)


def chained(summary: DataFrame) -> DataFrame:
    """The state that each slice really starts in, with facts that need the whole ship. One row per slice."""
    along = Window.partitionBy("mmsi").orderBy("_slice")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    facts = summary.select(
        *slices.MACHINE,
        F.lag("_last_unix").over(along).alias("_unix_before"),
        F.lead("_first_unix").over(along).alias("_unix_after"),
        F.sum("_n").over(whole).alias("_ship_pings"),
        F.first("_type").over(whole).alias("_ship_type"),
        F.first("_imo", ignorenulls=True)
        .over(along.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_imo_before"),
    )
    state_schema = ", ".join(f"{n} {t}" for n, t in _FACTS.items()) + ", " + slices.STATE
    return facts.sortWithinPartitions("mmsi", "_slice").mapInArrow(slices.chain(list(_FACTS)), state_schema)


def labelled(rows: DataFrame, order: Sequence[str], state: DataFrame, depth: int) -> DataFrame:
    """The pings that belong to an event, from the state of each slice."""
    in_slice = Window.partitionBy("mmsi", "_slice").orderBy(*order)
    placed = (
        rows.repartition("mmsi", "_slice")
        .join(state, ["mmsi", "_slice"])
        .withColumns(
            {
                "_pos": F.row_number().over(in_slice) - F.lit(1),
                "_unix_prev": F.coalesce(F.lag("cluster_time").over(in_slice), F.col("_unix_before")),
                "_unix_next": F.coalesce(F.lead("cluster_time").over(in_slice), F.col("_unix_after")),
                "_imo_seen": F.coalesce(
                    F.col("_imo_before"),
                    F.first("imo", ignorenulls=True).over(
                        in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                    ),
                    F.lit(-1),
                ),
            }
        )
        .drop("_unix_before", "_unix_after", "_imo_before")
        .sortWithinPartitions("mmsi", "_slice", *order)
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return placed.mapInArrow(slices.label(depth), schema + ", _ev_slice bigint, _ev_pos int").drop(
        "in_slice", "in_pos", "in_cell", "_cell", "_slow"
    )


def label_events(
    pings: DataFrame,
    resolution: int = 10,
    tiebreak: Sequence[str] = (),
    depth: int = RING_DEPTH,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Pings that belong to a stop event, with the event's id (``_ev_slice``,
    ``_ev_pos`` beside ``mmsi``), the times of the ping's neighbours and ship facts.

    Pings without ship, cell or time cannot be placed: they belong to no event and do not
    count towards their ship's pings. Cells must be this package's own; others raise."""
    rows, order = placed_pings(pings, resolution, tiebreak, slice_seconds)
    return labelled(rows, order, chained(summaries(rows, order, depth)), depth)


EVENT = ["mmsi", "_ev_slice", "_ev_pos"]


def event_parts(labelled: DataFrame, repeat_last_ping: bool = False) -> DataFrame:
    """Rows per (event, status), a handful per event, that can be added to those of other pings."""
    ping = labelled
    if repeat_last_ping:
        again = F.when(F.col("_unix_next").isNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ping = ping.withColumn("_copy", F.explode(again)).drop("_copy")
    seq = F.struct("_slice", "_pos")
    state = F.when(F.col("_unix_next").isNull(), 3).when(F.col("_unix_prev").isNull(), 1).otherwise(2)
    anchor = F.struct(
        F.col("h3_index_int"), F.col("_imo_seen").alias("imo"), "length", "width", "vessel_type", "vessel_type_main",
        F.col("dt_pos_utc").alias("obs_time"), "flag_country", "source", "destination",
        F.col("cluster_time").alias("unix_trigger"), F.coalesce("_unix_prev", "cluster_time").alias("unix_prior"),
        F.col("latitude").alias("trigger_lat"), F.col("longitude").alias("trigger_lng"),
        state.alias("state_initial"), F.col("_ship_type"), F.col("_ship_pings"),
    )
    last = F.struct(
        F.col("cluster_time").alias("unix_disarm"), F.coalesce("_unix_next", "cluster_time").alias("unix_escape"),
        F.col("latitude").alias("disarm_lat"), F.col("longitude").alias("disarm_lng"), state.alias("state_final"),
    )

    def usable(c):
        return F.when(~F.isnan(c), F.col(c))

    return ping.groupBy(*EVENT, "nav_status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cluster_time").alias("_unix"),
        *[
            x
            for c in ("latitude", "longitude")
            for x in (
                F.count(usable(c)).alias(f"_n_{c}"),
                F.avg(usable(c)).alias(f"_mean_{c}"),
                F.var_pop(usable(c)).alias(f"_var_{c}"),
            )
        ],
        F.min(seq).alias("_seen"),
        F.max(seq).alias("_until"),
        F.min_by(anchor, seq).alias("_anchor"),
        F.max_by(last, seq).alias("_last"),
    )


COORDINATES = ("latitude", "longitude")


def merged_parts(parts: DataFrame) -> DataFrame:
    """One part per (event, status) of several: counts and sums add up, deviations are taken from the common mean."""
    same = Window.partitionBy(*EVENT, "nav_status")
    centred = parts.withColumns(
        {f"_all_{c}": F.sum(F.col(f"_n_{c}") * F.col(f"_mean_{c}")).over(same) / F.nullif(F.sum(f"_n_{c}").over(same), F.lit(0)) for c in COORDINATES}
    )

    def deviation(c):
        gap = F.col(f"_mean_{c}") - F.col(f"_all_{c}")
        return F.sum(F.col(f"_n_{c}") * (F.col(f"_var_{c}") + gap * gap)) / F.nullif(F.sum(f"_n_{c}"), F.lit(0))

    return (
        centred.groupBy(*EVENT, "nav_status")
        .agg(
            F.sum("n").alias("n"),
            F.sum("_unix").alias("_unix"),
            *[
                x
                for c in COORDINATES
                for x in (F.sum(f"_n_{c}").alias(f"_n_{c}"), F.first(f"_all_{c}").alias(f"_mean_{c}"), deviation(c).alias(f"_var_{c}"))
            ],
            F.min_by("_anchor", "_seen").alias("_anchor"),
            F.max_by("_last", "_until").alias("_last"),
            F.min("_seen").alias("_seen"),
            F.max("_until").alias("_until"),
        )
        .select(*parts.columns)
    )


def event_facts(parts: DataFrame) -> DataFrame:
    """One row per event: anchor and last ping, counts, means, deviations, mode.

    Made from :func:`event_parts`, one per (event, status), so an event holding most of a ship's
    pings costs partial aggregation only.
    """
    w = Window.partitionBy(*EVENT)
    centred = parts.withColumns(
        {
            f"_all_{c}": F.sum(F.col(f"_n_{c}") * F.coalesce(f"_mean_{c}", F.lit(0.0))).over(w)
            / F.nullif(F.sum(f"_n_{c}").over(w), F.lit(0))
            for c in COORDINATES
        }
    )

    def squares(c):
        gap = F.col(f"_mean_{c}") - F.col(f"_all_{c}")
        return F.sum(F.col(f"_n_{c}") * (F.col(f"_var_{c}") + gap * gap))

    def deviation(c):
        used = F.sum(f"_n_{c}")
        sd = F.when(used > 1, F.sqrt(squares(c) / (used - F.lit(1)))).otherwise(F.lit(float("nan")))
        return F.when(F.sum("n") > 1, sd).otherwise(F.lit(0.0))

    return (
        centred.groupBy(*EVENT)
        .agg(
            F.sum("n").cast("int").alias("obs_count"),
            F.floor(F.sum("_unix") / F.sum("n")).alias("avg_unix"),
            F.first("_all_latitude").alias("avg_lat"),
            F.first("_all_longitude").alias("avg_lng"),
            deviation("latitude").alias("_sd_lat"),
            deviation("longitude").alias("_sd_lng"),
            F.max_by(F.struct("nav_status", "n"), F.struct("n", "_seen")).alias("_mode"),
            F.min_by("_anchor", "_seen").alias("_anchor"),
            F.max_by("_last", "_until").alias("_last"),
        )
        .select(
            "mmsi", "obs_count", "avg_unix", "avg_lat", "avg_lng", "_sd_lat", "_sd_lng",
            F.col("_mode.nav_status").alias("mode_nav_status"),
            F.col("_mode.n").cast("int").alias("obs_nav_status"),
            "_anchor.*", "_last.*",
        )
    )


def _estimates(facts: DataFrame, swapped: bool) -> dict:
    lower, upper = labels.stay_estimates("unix_prior", "unix_trigger", "unix_disarm", "unix_escape")
    return {"time_lower": upper, "time_upper": lower} if swapped else {"time_lower": lower, "time_upper": upper}


def _thresholds(swapped: bool) -> tuple:
    event_min, ship_min = labels.observation_thresholds("_ship_type")
    return (ship_min, event_min) if swapped else (event_min, ship_min)


GEOMETRIES = ("box", "tri-line", "point")


def stop_events(
    pings: DataFrame,
    resolution: int = 10,
    tiebreak: Sequence[str] = (),
    geometry: str = "tri-line",
    factor: float = 1.0,
    compat: bool = False,
    depth: int = RING_DEPTH,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Stop events in the 32-column layout.

    An event is valid when it holds more pings than its ship type needs; ships with
    too few pings are skipped. ``compat`` reproduces three known slips of the
    published method: the two thresholds are exchanged, lower and upper estimates are
    exchanged, and a ship's last ping counts twice when its event is still open.
    """
    if geometry not in GEOMETRIES:
        raise ValueError(f"geometry must be one of {GEOMETRIES}")
    _, ship_min = _thresholds(compat)
    labelled = label_events(pings, resolution, tiebreak, depth, slice_seconds).filter(F.col("_ship_pings") > ship_min)
    labelled = labelled.withColumn("h3_index_int", F.col(joins.cell_column(resolution)))
    return finished(event_facts(event_parts(labelled, repeat_last_ping=compat)), geometry, factor, compat)


def finished(facts: DataFrame, geometry: str = "tri-line", factor: float = 1.0, compat: bool = False) -> DataFrame:
    """Facts of events as the 32 columns."""
    event_min, _ = _thresholds(compat)
    facts = facts.withColumn("_valid", F.col("obs_count") > event_min)
    shapes = {
        "box": geo.spread_box_wkt("avg_lat", "avg_lng", "_sd_lat", "_sd_lng", factor),
        "tri-line": geo.tri_line_wkt("trigger_lat", "trigger_lng", "avg_lat", "avg_lng", "disarm_lat", "disarm_lng"),
        "point": geo.point_wkt("trigger_lat", "trigger_lng"),
    }
    trigger = geo.point_wkt("trigger_lat", "trigger_lng")
    out = facts.withColumns(
        {
            **_estimates(facts, compat),
            "sd_lat": F.when(F.col("_valid"), F.col("_sd_lat")).otherwise(F.lit(0.0)),
            "sd_lng": F.when(F.col("_valid"), F.col("_sd_lng")).otherwise(F.lit(0.0)),
            "is_valid": F.when(F.col("_valid"), "valid").otherwise("invalid"),
            "geom_wkt": F.when(F.col("_valid"), shapes[geometry]).otherwise(trigger),
            "wkt_avg_pt": F.when(F.col("_valid"), geo.point_wkt("avg_lat", "avg_lng")).otherwise(trigger),
        }
    )
    return out.select(*[F.col(c).cast(t) if t else F.col(c) for c, t in STOP_EVENT_COLUMNS.items()])


# The published column order.
FULL_EVENT_COLUMNS = [
    "h3_index_int", "mmsi", "imo", "length", "width", "vessel_type", "vessel_type_main", "obs_time", "time_lower",
    "time_upper", "unix_trigger", "avg_unix", "unix_disarm", "sd_lat", "sd_lng", "delta_x", "delta_y", "trigger_lat",
    "trigger_lng", "avg_lat", "avg_lng", "disarm_lat", "disarm_lng", "mode_nav_status", "obs_nav_status",
    "obs_count", "state_initial", "state_final", "wkt_trigger_pt", "wkt_avg_pt", "wkt_disarm_pt", "wkt_triline",
    "wkt_sd_box", "is_valid",
]


def stop_event_profiles(
    pings: DataFrame,
    min_observations: int = 10,
    resolution: int = 10,
    tiebreak: Sequence[str] = (),
    factor: float = 1.0,
    depth: int = RING_DEPTH,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Stop events in the 34-column layout: spread in metres and five geometries;
    valid from ``min_observations`` pings on. No ship is skipped."""
    labelled = label_events(pings, resolution, tiebreak, depth, slice_seconds)
    labelled = labelled.withColumn("h3_index_int", F.col(joins.cell_column(resolution)))
    facts = event_facts(event_parts(labelled)).withColumn("_valid", F.col("obs_count") >= min_observations)
    x, y = stats.spread_metres("avg_lat", "avg_lng", "_sd_lat", "_sd_lng")
    ok, zero = F.col("_valid"), F.lit(0.0)
    line = geo.tri_line_wkt("trigger_lat", "trigger_lng", "avg_lat", "avg_lng", "disarm_lat", "disarm_lng")
    box = geo.spread_box_wkt("avg_lat", "avg_lng", "_sd_lat", "_sd_lng", factor)
    out = facts.withColumns(
        {
            **_estimates(facts, False),
            "sd_lat": F.when(ok, F.col("_sd_lat")).otherwise(zero),
            "sd_lng": F.when(ok, F.col("_sd_lng")).otherwise(zero),
            "delta_x": F.when(ok, x).otherwise(zero),
            "delta_y": F.when(ok, y).otherwise(zero),
            "wkt_trigger_pt": geo.point_wkt("trigger_lat", "trigger_lng"),
            "wkt_avg_pt": geo.point_wkt("avg_lat", "avg_lng"),
            "wkt_disarm_pt": geo.point_wkt("disarm_lat", "disarm_lng"),
            "wkt_triline": F.when(ok, line).otherwise("LINESTRING EMPTY"),
            "wkt_sd_box": F.when(ok, box).otherwise("POLYGON EMPTY"),
            "is_valid": F.when(ok, "valid").otherwise("invalid"),
        }
    )
    return out.select(*FULL_EVENT_COLUMNS)


def stationary(
    pings: DataFrame,
    aoi: DataFrame,
    resolution: int = 10,
    buffer_radius_m: float = 10000.0,
    tiebreak: Sequence[str] = (),
    compat: bool = False,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Reduce pings to the buffer around the ports, then detect stop events."""
    from fairlead.functions.ports import without_small_ports

    runs = areas.buffer_runs(without_small_ports(aoi, resolution), buffer_radius_m, resolution)
    near = joins.keep_in_runs(pings, runs, resolution)
    return stop_events(near, resolution, tiebreak, compat=compat, slice_seconds=slice_seconds)


def stops_in_ports(
    events: DataFrame, aoi: DataFrame, keys: Sequence[str], resolution: int = 8, method: str = "Manual"
) -> DataFrame:
    """Stop events joined to the ports of one delineation (``method``) whose cells hold the anchor.

    ``resolution`` is that of the events' cells. An area table without a ``method`` column is one
    delineation already."""
    chosen = areas.select_method(aoi, method) if "method" in aoi.columns else aoi
    cells = areas.area_cells(chosen, keys, resolution)
    if "kode" in cells.columns and "Kode" not in cells.columns:
        cells = cells.withColumnRenamed("kode", "Kode")
    return joins.events_in_ports(events, cells).drop("h3_ids", "h3_ids_int")
