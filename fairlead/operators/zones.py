"""Zone membership, zone edges and travel time between zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions import labels
from fairlead.operators import joins, sequence


def tag_zone(pings: DataFrame, zone_cells: DataFrame, flag: str, cell: str = "H3_int_index_8") -> DataFrame:
    """Boolean ``flag``: the ping's cell belongs to the zone (cells made distinct)."""
    joins.require(pings, cell)
    cells = zone_cells.select(zone_cells.columns[0]).distinct().toDF(cell).withColumn(flag, F.lit(True))
    return pings.join(joins.sized(cells), cell, "left").withColumn(flag, labels.or_false(flag))


def tag_zone_runs(pings: DataFrame, runs: DataFrame, flag: str, resolution: int = 8, cell: str | None = None) -> DataFrame:
    """The same for a zone given as runs of cells (``areas.zone_runs``), which is never expanded into cells."""
    return joins.tag_runs(pings, runs, flag, resolution, cell)


def first_last_in_zone(tagged: DataFrame, flag: str, keys: Sequence[str] = ("mmsi",)) -> DataFrame:
    return tagged.filter(F.col(flag)).groupBy(*keys).agg(
        F.min("dt_pos_utc").alias("first_detected_hormuz"), F.max("dt_pos_utc").alias("last_detected_hormuz")
    )


def ever_in_zone(tagged: DataFrame, flag: str, name: str = "is_through_hormuz") -> DataFrame:
    return tagged.groupBy("mmsi").agg(F.bool_or(flag).alias(name))


def zone_history(tagged: DataFrame, flag: str) -> DataFrame:
    """Per ship: ever in the zone, first and last time there - one aggregate."""
    seen = F.when(F.col(flag), F.col("dt_pos_utc"))
    return tagged.groupBy("mmsi").agg(
        F.bool_or(flag).alias("is_through_hormuz"),
        F.min(seen).alias("first_detected_hormuz"),
        F.max(seen).alias("last_detected_hormuz"),
    )


def flag_activity(activity: DataFrame, history: DataFrame) -> DataFrame:
    """Attach zone history to visit rows; ships without pings in it count as false."""
    return activity.join(history, "mmsi", "left").withColumn(
        "is_through_hormuz", labels.or_false("is_through_hormuz")
    )


def zone_edges(
    tagged: DataFrame,
    leave: str,
    enter: str,
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Pings where the ship has just left zone ``leave`` or just entered zone ``enter``."""
    order = ["dt_pos_utc", *tiebreak]
    left = labels.or_false(F.col("_left") & ~F.col(leave))
    entered = labels.or_false(~F.col("_entered") & F.col(enter))
    seen = sequence.neighbours(
        tagged.select("mmsi", *order, leave, enter),
        order,
        back={"_left": (leave, 1), "_entered": (enter, 1)},
        slice_seconds=slice_seconds,
        keep=left | entered,
    )
    return seen.withColumns({"exit": left, "entry": entered}).drop("_left", "_entered")


def transit_times(
    edges: DataFrame, slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS
) -> DataFrame:
    """First entry per ship, last exit before it, and the hours between.

    Edges are first reduced per (ship, slice) to the slice's first entry and its last
    exit before that entry; only those few rows meet per ship, so neither the edges
    of a busy ship nor its pings gather in one task and nothing is joined to itself.
    """
    sliced = edges.withColumn("_slice", sequence.time_slice("dt_pos_utc", sequence.plain(slice_seconds)))
    in_slice = Window.partitionBy("mmsi", "_slice")
    entry_time = F.when(F.col("entry"), F.col("dt_pos_utc"))
    per_slice = (
        sliced.withColumn("_entry", F.min(entry_time).over(in_slice))
        .withColumn(
            "_before",
            F.when(F.col("exit") & (F.col("_entry").isNull() | (F.col("dt_pos_utc") < F.col("_entry"))), F.col("dt_pos_utc")),
        )
        .groupBy("mmsi", "_slice")
        .agg(F.min("_entry").alias("_entry"), F.max("_before").alias("_before"))
    )
    # Exits of slices after the first entry are cut by comparing with it again.
    return (
        per_slice.withColumn("t_indo", F.min("_entry").over(Window.partitionBy("mmsi")))
        .filter(F.col("_before") < F.col("t_indo"))
        .groupBy("mmsi", "t_indo")
        .agg(F.max("_before").alias("t_hormuz"))
        .withColumn("travel_time_hours", labels.hours_between("t_indo", "t_hormuz"))
        .select("mmsi", "t_hormuz", "t_indo", "travel_time_hours")
    )


def with_ship_facts(
    result: DataFrame, pings: DataFrame, facts: Sequence[str], order: Sequence[str] = ("dt_pos_utc",)
) -> DataFrame:
    """Join one row of ship facts, taken from the ship's earliest ping."""
    first = sequence.earliest_per_key(
        pings.select("mmsi", *dict.fromkeys([*facts, *order])), ["mmsi"], list(order)
    ).select("mmsi", *facts)
    return first.join(result, "mmsi", "inner").select("mmsi", *facts, *[c for c in result.columns if c != "mmsi"])
