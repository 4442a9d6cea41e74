"""Results kept up to date period by period, reading only the new period's pings.

What a ship was doing at the end of a period is written beside the results, a few rows a ship: its last
port call, the last pings whose fate depends on what follows, the visit edges that still wait for a neighbour.
The next period starts from there, so voyages and visits that cross the boundary come out as from one run
over the whole history. Results that nothing can change any more are written once, by period;
what may still change is derived from the small state when it is read.

Layout below ``target``: one folder per table, partitioned by period (:func:`writers.accumulate`). A period
run again replaces its own partitions; periods are plain names that sort in the order of time, each later
than those before it, and no ping of a period is older than a ping of an earlier one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.functions import labels
from fairlead.operators import joins, reports, sequence, slices, stops, visits, voyages
from fairlead.sources import writers

PERIOD = "period"


def _table(spark: SparkSession, target: str, name: str, before: str | None = None, only_last: bool = False) -> DataFrame | None:
    """A table of the accumulation without its period column: all periods, or those before one, or the last of these."""
    path = f"{target.rstrip('/')}/{name}"
    if not writers.exists(spark, path):
        return None
    # the names of the partitions are read, not the rows
    have = sorted(p for p in writers.partitions(spark, path, PERIOD) if before is None or p < before)
    chosen = have[-1:] if only_last else have
    if not chosen:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/{PERIOD}={p}" for p in chosen]).drop(PERIOD)


def _add(df: DataFrame, target: str, name: str, period: str) -> DataFrame:
    """Write one table's part of a period; its rows, read back."""
    spark, path = df.sparkSession, f"{target.rstrip('/')}/{name}"
    writers.accumulate(spark, df, path, period, PERIOD)
    return spark.read.schema(df.schema).parquet(f"{path}/{PERIOD}={period}")


# ---- voyages ---------------------------------------------------------------------

CALL_STATE, LEGS = "last_calls", "legs"


def add_voyages(
    pings: DataFrame,
    ports: DataFrame,
    target: str,
    period: str,
    cell: str = "H3_int_index_8",
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> None:
    """Add the voyage legs that end in a period; ``pings`` are the period's, ``ports`` as for ``voyages.port_calls``.

    A ship's state is its last port call: the port that a first ping there would not change, and the
    origin of the next leg.
    """
    spark = pings.sparkSession
    before = _table(spark, target, CALL_STATE, period, only_last=True)
    inside = voyages.in_port_pings(pings, ports, cell, tiebreak)
    if before is not None:
        inside = inside.unionByName(before)
    order = ["dt_pos_utc", *tiebreak, "Port_Country"]
    calls = sequence.first_of_runs(inside, "Port_Country", order, slice_seconds=slice_seconds)
    # Few rows are left: kept once, for the legs and for the state.
    calls = _add(calls, target, "calls", period)
    _add(voyages.legs(calls, tiebreak, slice_seconds), target, LEGS, period)
    _add(sequence.latest_per_ship(calls, [c for c in calls.columns if c != "mmsi"], order).select(*calls.columns), target, CALL_STATE, period)


def voyage_legs(spark: SparkSession, target: str) -> DataFrame:
    """All legs so far, as from one run over all periods."""
    found = _table(spark, target, LEGS)
    if found is None:
        raise ValueError(f"no voyages at {target}")
    return found


# ---- visits ----------------------------------------------------------------------

VISIT_STATE, VISITS, SEEN = "open_edges", "visits", "ships_in_port"
#: A row of the state is known only as the neighbour of one that waits for what follows it.
CONTEXT, WAITING, NEW = 0, 1, 2


def _beside(rows: DataFrame, tail: DataFrame | None, order: Sequence[str], keep_edges: bool, slice_seconds) -> DataFrame:
    """Rows of a pass with their neighbours: those decided and kept (``_done``), and the last two of each ship.

    A row is decided once its next row is known. ``keep_edges`` drops rows with no or two neighbours
    on the other side of the port limit; without it every row is kept.
    """
    both = rows.withColumn("_role", F.lit(NEW))
    if tail is not None:
        both = both.unionByName(tail)
    edge = F.coalesce((F.col("_prev") != F.col("position")) != (F.col("_next") != F.col("position")), F.lit(True))
    done = (F.col("_role") > CONTEXT) & F.col("_next").isNotNull() & (edge if keep_edges else F.lit(True))
    seen = sequence.neighbours(
        both,
        order,
        back={"_prev": ("position", 1)},
        ahead={"_next": ("position", 1), "_next_time": ("dt_pos_utc", 1), "_after": ("position", 2)},
        slice_seconds=slice_seconds,
        keep=F.coalesce(done, F.lit(False)) | F.col("_after").isNull(),
    )
    return seen.withColumn("_done", done)


def _tail(seen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The last two rows of each ship: the last one waits, the one before it is its neighbour."""
    role = F.when(F.col("_next").isNull(), F.lit(WAITING)).otherwise(F.lit(CONTEXT))
    return seen.filter(F.col("_after").isNull()).withColumn("_role", role).select(*columns, "_role")


def add_visits(
    tagged: DataFrame,
    target: str,
    period: str,
    cell: str = "H3_int_index_8",
    order: Sequence[str] = visits.VISIT_ORDER,
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> None:
    """Add the port visits of a period; ``tagged`` are the period's pings after ``joins.tag_ports``.

    Each of the two passes over edges, and the marking after them, leaves at most two rows a ship that
    the next period needs.
    """
    spark = tagged.sparkSession
    state = _table(spark, target, VISIT_STATE, period, only_last=True)
    rows = visits.visit_pings(tagged, cell)
    columns = rows.columns

    def tail(level: int) -> DataFrame | None:
        return None if state is None else state.filter(F.col("_level") == level).drop("_level")

    once = visits.distinct_pings(rows, slice_seconds, order).drop("_slice")
    # Only edges and the ends of ships pass the first step; all else is derived from these.
    first = _add(_beside(once, tail(1), order, True, slice_seconds), target, "first_pass", period)
    short = sequence.plain(slice_seconds)
    second = _beside(first.filter("_done").select(*columns), tail(2), order, True, short)
    second = _add(second, target, "second_pass", period)
    third = _beside(second.filter("_done").select(*columns), tail(3), order, False, short)
    third = _add(third, target, "third_pass", period)
    _add(visits.marked(third.filter("_done")).select(*columns, *visits.MARKS), target, VISITS, period)
    ends = [_tail(seen, columns).withColumn("_level", F.lit(k + 1)) for k, seen in enumerate((first, second, third))]
    _add(ends[0].unionByName(ends[1]).unionByName(ends[2]), target, VISIT_STATE, period)
    # From all pings: a single ping in port leaves no edge, but it shows that the ship was there.
    _add(rows.filter(F.col("position") == "in").select("mmsi").distinct(), target, SEEN, period)


def port_visits(
    spark: SparkSession, target: str, order: Sequence[str] = visits.VISIT_ORDER, slice_seconds: int = sequence.DEFAULT_SLICE_SECONDS
) -> DataFrame:
    """All visit edges so far with their marks, as from one run over all periods.

    Rows that still wait for a neighbour are finished as if nothing followed: the state holds all they need.
    """
    found, state, seen = (_table(spark, target, name, only_last=name == VISIT_STATE) for name in (VISITS, VISIT_STATE, SEEN))
    if found is None or state is None or seen is None:
        raise ValueError(f"no visits at {target}")
    columns = [c for c in found.columns if c not in visits.MARKS]

    def level(k: int) -> DataFrame:
        return state.filter(F.col("_level") == k).drop("_level")

    def last(tail: DataFrame, rows: DataFrame) -> DataFrame:
        """Neighbours among a level's tail and the rows that come to it at the end."""
        both = tail.unionByName(rows.select(*columns).withColumn("_role", F.lit(NEW)))
        return sequence.neighbours(
            both,
            order,
            back={"_prev": ("position", 1)},
            ahead={"_next": ("position", 1), "_next_time": ("dt_pos_utc", 1)},
            slice_seconds=slice_seconds,
        ).filter(F.col("_role") > CONTEXT)

    # The last ping of a ship is an edge in either pass.
    waiting = level(1).filter(F.col("_role") == WAITING)
    edge = F.coalesce((F.col("_prev") != F.col("position")) != (F.col("_next") != F.col("position")), F.lit(True))
    kept = last(level(2), waiting).filter(edge)
    rest = visits.marked(last(level(3), kept)).select(*columns, *visits.MARKS)
    return found.select(*columns, *visits.MARKS).unionByName(rest).join(seen.distinct(), "mmsi", "left_semi")


# ---- stop events -----------------------------------------------------------------

EVENTS, OPEN_EVENTS, SHIPS = "events", "open_events", "ships"
#: The slice number of a row that stands after all slices of a ship, to read the state it is left in.
END = (1 << 62) - 1


def _ends(summary: DataFrame) -> DataFrame:
    """An empty slice at the end of each ship."""
    nothing = {f.split(" ")[0]: F.lit(None).cast(f.split(" ")[1]) for f in slices.SUMMARY.split(", ")}
    nothing |= {c: F.array().cast(t) for c, t in (("stays", "array<bigint>"), ("other", "array<bigint>"), ("other_pos", "array<int>"), ("other_cell", "array<bigint>"))}
    nothing |= {c: F.lit(slices.NONE) for c in ("none_pos", "far_pos")} | {c: F.lit(slices.NONE).cast("bigint") for c in ("none_cell", "far_cell")}
    nothing |= {"_slice": F.lit(END), "_n": F.lit(0).cast("bigint")}
    del nothing["mmsi"]
    return summary.select("mmsi").distinct().select("mmsi", *[c.alias(n) for n, c in nothing.items()]).select(*summary.columns)


def add_stops(
    pings: DataFrame,
    target: str,
    period: str,
    resolution: int = 10,
    tiebreak: Sequence[str] = (),
    depth: int = stops.RING_DEPTH,
    slice_seconds: int | sequence.Slicing = sequence.EVEN,
) -> None:
    """Add the stop events of a period. Periods must begin at a multiple of the slice length; others raise.

    A ship's state is one row: the anchor of its open event if there is one, its last time, its number of
    pings, its type and IMO. It acts as a slice before the period's own. Of an open event the parts per status
    are kept, one row each however long it lasts; the next period adds to them.
    """
    spark = pings.sparkSession
    before = _table(spark, target, SHIPS, period, only_last=True)
    rows, order = stops.placed_pings(pings, resolution, tiebreak, slice_seconds)
    summary = stops.summaries(rows, order, depth)
    if before is not None:
        old = F.col("_old_last")
        cut = F.raise_error(F.lit("a period must begin at a multiple of the slice length, after the periods before it")).cast("bigint")
        later = F.when(old.isNull() | (F.col("_slice") > old), F.col("_slice")).otherwise(cut)
        columns = summary.columns
        summary = summary.join(before.select("mmsi", F.col("_last_slice").alias("_old_last")), "mmsi", "left").withColumn("_slice", later)
        summary = summary.select(*columns).unionByName(before.select(*columns))
    summary = _add(summary, target, "slices", period)
    # Written for its three uses: the pings' labels, the new state, and what follows an open event.
    state = _add(stops.chained(summary.unionByName(_ends(summary))), target, "entered", period)
    left = state.filter(F.col("_slice") == END)
    is_open = F.col("in_pos") != slices.NONE
    carried = summary.filter(F.col("_slice") < END).groupBy("mmsi").agg(F.max("_slice").alias("_last_slice"))
    empty = F.array()
    ships = left.join(carried, "mmsi").select(
        "mmsi",
        F.when(is_open, F.col("in_slice")).otherwise(F.col("_last_slice")).alias("_slice"),
        F.col("in_pos").alias("none_pos"),
        F.col("in_cell").alias("none_cell"),
        F.lit(slices.NONE).alias("far_pos"),
        F.lit(slices.NONE).cast("bigint").alias("far_cell"),
        empty.cast("array<bigint>").alias("stays"),
        empty.cast("array<bigint>").alias("other"),
        empty.cast("array<int>").alias("other_pos"),
        empty.cast("array<bigint>").alias("other_cell"),
        F.col("_ship_pings").alias("_n"),
        F.lit(None).cast("bigint").alias("_first_unix"),
        F.col("_unix_before").alias("_last_unix"),
        F.col("_ship_type").alias("_type"),
        F.col("_imo_before").alias("_imo"),
        F.col("_last_slice"),
    )
    ships = _add(ships, target, SHIPS, period)

    own = state.filter(F.col("_slice") < END)
    if before is not None:
        own = own.join(before.select("mmsi", "_slice"), ["mmsi", "_slice"], "left_anti")
    labelled = stops.labelled(rows, order, own, depth).withColumn("h3_index_int", F.col(joins.cell_column(resolution)))
    parts = stops.event_parts(labelled)
    held = _table(spark, target, OPEN_EVENTS, period, only_last=True)
    if held is not None:
        follows = state.join(before.select("mmsi", "_slice", F.col("_n").alias("_pings_before")), ["mmsi", "_slice"])
        parts = parts.unionByName(_followed(held, follows.select("mmsi", "_unix_after", "_pings_before")).select(*parts.columns))
        parts = stops.merged_parts(parts)
    parts = _add(parts, target, "parts", period)
    open_ids = left.filter(is_open).select("mmsi", F.col("in_slice").alias("_ev_slice"), F.col("in_pos").alias("_ev_pos"))
    _add(parts.join(open_ids, stops.EVENT, "left_semi"), target, OPEN_EVENTS, period)
    _add(stops.event_facts(parts.join(open_ids, stops.EVENT, "left_anti")), target, EVENTS, period)


def _followed(parts: DataFrame, follows: DataFrame) -> DataFrame:
    """Parts of open events once their ship's last ping has a successor: that ping was not the last one after all."""
    rows = parts.join(follows, "mmsi", "left")
    known = F.col("_unix_after").isNotNull()
    # The ship's very first ping stays a first one.
    state = F.when(F.col("_pings_before") == 1, F.lit(1)).otherwise(F.lit(2))

    def mended(struct: str, fields: dict[str, Column]) -> Column:
        out = F.col(struct)
        for name, value in fields.items():
            out = out.withField(name, value)
        was_last = F.col(f"{struct}.{'state_final' if struct == '_last' else 'state_initial'}") == 3
        return F.when(known & was_last, out).otherwise(F.col(struct))

    return rows.withColumns(
        {
            "_last": mended("_last", {"state_final": state, "unix_escape": F.col("_unix_after")}),
            "_anchor": mended("_anchor", {"state_initial": state}),
        }
    )


def stop_events(spark: SparkSession, target: str, geometry: str = "tri-line", factor: float = 1.0) -> DataFrame:
    """All stop events so far in the 32 columns, as ``stops.stop_events`` gives them in one run over all periods."""
    found, held, ships = (_table(spark, target, name, only_last=name != EVENTS) for name in (EVENTS, OPEN_EVENTS, SHIPS))
    if found is None or held is None or ships is None:
        raise ValueError(f"no stop events at {target}")
    facts = found.unionByName(stops.event_facts(held)).drop("_ship_pings", "_ship_type")
    known = ships.select("mmsi", F.col("_n").alias("_ship_pings"), F.col("_type").alias("_ship_type"))
    _, ship_min = labels.observation_thresholds("_ship_type")
    return stops.finished(facts.join(known, "mmsi").filter(F.col("_ship_pings") > ship_min), geometry, factor)


# ---- durations -------------------------------------------------------------------

DURATIONS = "durations"


def add_durations(sketches: DataFrame, target: str, period: str) -> None:
    """Add a period's sketches (``reports.visit_sketches`` or ``stop_sketches``)."""
    _add(sketches, target, DURATIONS, period)


def durations(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Mean and median over all periods by any of the stored keys, merged from the sketches alone."""
    found = _table(spark, target, DURATIONS)
    if found is None:
        raise ValueError(f"no durations at {target}")
    return reports.merged_durations(found, keys)
