"""Origin-destination legs between ports, and the traffic counts built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions import grid, labels
from fairlead.operators import joins, sequence


def union_ports(home_ports: DataFrame, foreign_ports: DataFrame) -> DataFrame:
    """Port cells of both lists, matched by column name."""
    wanted = ["Port", "Country", "boundary_h3", "Port_Country"]
    return home_ports.select(*wanted).unionByName(foreign_ports.select(*wanted))


def with_centres(ports: DataFrame, cell: str = "boundary_h3", resolution: int | None = None) -> DataFrame:
    return ports.withColumns(
        {"lat": grid.centre_latitude(cell, resolution), "lon": grid.centre_longitude(cell, resolution)}
    )


def port_calls(
    pings: DataFrame,
    ports: DataFrame,
    cell: str = "H3_int_index_8",
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Pings in ports, keeping the first ping of each stay at one port."""
    order = ["dt_pos_utc", *tiebreak, "Port_Country"]
    return sequence.first_of_runs(in_port_pings(pings, ports, cell, tiebreak), "Port_Country", order, slice_seconds=slice_seconds)


def in_port_pings(pings: DataFrame, ports: DataFrame, cell: str = "H3_int_index_8", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Narrow pings in ports, with the port and its centre."""
    wanted = ["mmsi", "dt_pos_utc", "vessel_type", cell, *tiebreak]
    inside = joins.pings_in_ports(pings.select(*wanted), ports.select("boundary_h3", "Port_Country", "lat", "lon"), cell)
    return inside.drop("boundary_h3")


def legs(
    calls: DataFrame, tiebreak: Sequence[str] = (), slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS
) -> DataFrame:
    """One row per leg from a call to the ship's next call. Ships with a single call
    have no next call and so disappear without a separate count."""
    order = ["dt_pos_utc", *tiebreak, "Port_Country"]
    following = sequence.neighbours(
        calls,
        order,
        ahead={
            "Port_Country_Destination": ("Port_Country", 1),
            "lat_destination": ("lat", 1),
            "lon_destination": ("lon", 1),
        },
        slice_seconds=sequence.plain(slice_seconds),
    )
    return (
        following.filter(F.col("Port_Country_Destination").isNotNull())
        .withColumnsRenamed({"Port_Country": "Port_Country_Origin", "lat": "lat_origin", "lon": "lon_origin"})
        .withColumns(
            {
                "Country_Origin": labels.country_of("Port_Country_Origin"),
                "Country_Destination": labels.country_of("Port_Country_Destination"),
            }
        )
    )


def cell_lists(ports: DataFrame) -> DataFrame:
    """One row per cell of ports placed by :func:`with_centres`: its ports in order (``_ports``) and its centre."""
    some = F.sort_array(F.collect_set("Port_Country"))
    unnamed = F.array(F.lit(None).cast("string"))
    listed = F.when(F.max(F.col("Port_Country").isNull()), F.concat(unnamed, some)).otherwise(some)
    cells = ports.groupBy("boundary_h3").agg(listed.alias("_ports"), F.first("lat").alias("lat"), F.first("lon").alias("lon"))
    return cells.filter(F.col("boundary_h3").isNotNull())


def international_legs(
    pings: DataFrame,
    ports: DataFrame,
    cell: str = "H3_int_index_8",
    tiebreak: Sequence[str] = (),
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
    home: str = labels.HOME_COUNTRY,
) -> DataFrame:
    """``international(legs(port_calls(...)))``, without a row for every port of every ping.

    A ping in a cell of many ports calls at each of them in order, so the legs within the ping are those between
    neighbours in the cell's list: their international ones are found once a cell. Legs between pings need the ends
    of two lists only. A run of one port that goes on from ping to ping begins at the first of them. Pings of one ship, time and
    tiebreak in several places mix their ports and are expanded.
    """
    lists = cell_lists(ports)
    steps = F.transform(
        F.sequence(F.lit(1), F.size("_ports") - 1),
        lambda i: F.struct(i.alias("n"), F.get("_ports", i - 1).alias("origin"), F.get("_ports", i).alias("to")),
    )
    abroad = lists.filter(F.size("_ports") > 1).select("boundary_h3", F.inline(steps))
    abroad = international(
        abroad.withColumns({"Country_Origin": labels.country_of("origin"), "Country_Destination": labels.country_of("to")}), home
    )
    abroad = abroad.groupBy(F.col("boundary_h3").alias("_abroad")).agg(F.collect_list(F.struct("n", "origin", "to")).alias("_steps"))
    size = F.size("_ports")
    ends = lists.select(
        "boundary_h3", "lat", "lon", F.get("_ports", F.lit(0)).alias("Port_Country"), F.get("_ports", F.lit(1)).alias("_second"),
        F.get("_ports", size - 1).alias("_last"), size.alias("_size"),
    )
    moment = ["mmsi", "dt_pos_utc", *tiebreak]
    joins.require(pings, cell)
    placed = pings.select(*dict.fromkeys(["mmsi", "dt_pos_utc", "vessel_type", cell, *tiebreak]))
    placed = placed.join(joins.sized(ends), placed[cell] == F.col("boundary_h3"), "inner").drop("boundary_h3")
    # Rows that repeat each other make no call of their own; others of one moment have their ports in one order.
    placed = placed.repartition(*moment).dropDuplicates()
    mixed = F.count(F.lit(1)).over(Window.partitionBy(*moment)) > 1
    placed = placed.withColumn("_mixed", F.when(mixed, F.col(cell)))
    spread = joins.sized(lists.select(F.col("boundary_h3").alias("_of"), F.col("_ports").alias("_each")))
    placed = placed.join(spread, F.col("_mixed") == F.col("_of"), "left")
    nothing = F.lit(None).cast("string")
    each = F.transform("_each", lambda p: F.struct(p.alias("Port_Country"), nothing.alias("_second"), p.alias("_last"), F.lit(1).alias("_size")))
    own = F.struct("Port_Country", "_second", "_last", "_size")
    placed = placed.withColumn("_units", F.when(F.col("_mixed").isNull(), F.array(own)).otherwise(each))
    units = placed.drop("Port_Country", "_second", "_last", "_size", "_mixed", "_of", "_each")
    units = units.select("*", F.inline("_units")).drop("_units")
    order = ["dt_pos_utc", *tiebreak, "Port_Country"]
    goes_on = F.coalesce(F.col("Port_Country") == F.col("_before"), F.lit(False))
    calls = sequence.neighbours(
        units, order, back={"_before": ("_last", 1)}, slice_seconds=slice_seconds, keep=~(goes_on & (F.col("_size") == 1))
    )
    calls = calls.withColumn("_goes_on", goes_on).drop("_before")
    to = F.when(F.col("_goes_on"), F.col("_second")).otherwise(F.col("Port_Country"))
    following = sequence.neighbours(
        calls.withColumn("_to", to), order, ahead={"_next": ("_to", 1), "_next_lat": ("lat", 1), "_next_lon": ("lon", 1)},
        slice_seconds=sequence.plain(slice_seconds),
    )
    # a port on its own in a mixed moment has no steps of its cell: they are rows
    key = F.when(F.col("_size") > 1, F.col(cell))
    following = following.join(joins.sized(abroad), key == F.col("_abroad"), "left")
    within = F.transform(
        F.filter("_steps", lambda p: ~F.col("_goes_on") | (p["n"] > 1)),
        lambda p: F.struct(
            p["origin"].alias("Port_Country_Origin"), p["to"].alias("Port_Country_Destination"),
            F.col("lat").alias("lat_destination"), F.col("lon").alias("lon_destination"),
        ),
    )
    onward = F.struct(
        F.col("_last").alias("Port_Country_Origin"), F.col("_next").alias("Port_Country_Destination"),
        F.col("_next_lat").alias("lat_destination"), F.col("_next_lon").alias("lon_destination"),
    )
    found = F.when(F.col("_steps").isNull(), F.array(onward)).otherwise(F.concat(F.array(onward), within))
    legs_df = following.withColumn("_legs", found).select(
        *dict.fromkeys([*moment, "vessel_type", cell]), F.col("lat").alias("lat_origin"), F.col("lon").alias("lon_origin"), F.inline("_legs")
    )
    legs_df = legs_df.filter(F.col("Port_Country_Destination").isNotNull()).withColumns(
        {
            "Country_Origin": labels.country_of("Port_Country_Origin"),
            "Country_Destination": labels.country_of("Port_Country_Destination"),
        }
    )
    return international(legs_df, home)


def ships_with_several_calls(calls: DataFrame) -> DataFrame:
    """Calls of ships that called more than once."""
    counts = calls.groupBy("mmsi").agg(F.count(F.lit(1)).alias("_calls")).filter("_calls > 1")
    return calls.join(counts.select("mmsi"), "mmsi", "left_semi")


def international(legs_df: DataFrame, home: str = labels.HOME_COUNTRY) -> DataFrame:
    here, there = F.col("Country_Origin"), F.col("Country_Destination")
    return legs_df.filter((here != there) & ((here == home) | (there == home)))


def inbound(legs_df: DataFrame, home: str = labels.HOME_COUNTRY) -> DataFrame:
    return legs_df.filter((F.col("Country_Origin") != home) & (F.col("Country_Destination") == home))


def outbound(legs_df: DataFrame, home: str = labels.HOME_COUNTRY) -> DataFrame:
    return legs_df.filter((F.col("Country_Origin") == home) & (F.col("Country_Destination") != home))


ROUTE = ["Port_Country_Origin", "Port_Country_Destination"]
ROUTE_POINTS = ["lat_origin", "lon_origin", "lat_destination", "lon_destination"]


def _count_routes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The date of a leg is the date of its origin call.
    return df.groupBy(*keys, "vessel_type", F.to_date("dt_pos_utc").alias("date")).agg(
        F.count(F.lit(1)).alias("count")
    )


def traffic_all(legs_df: DataFrame, home: str = labels.HOME_COUNTRY) -> DataFrame:
    return _count_routes(international(legs_df, home), ROUTE + ROUTE_POINTS)


def traffic_inbound(legs_df: DataFrame, home: str = labels.HOME_COUNTRY) -> DataFrame:
    """Counts of each ship's first leg into the home country."""
    return _count_routes(sequence.first_by_rank(inbound(legs_df, home), "mmsi", "dt_pos_utc"), ROUTE)


def traffic_outbound(legs_df: DataFrame, home: str = labels.HOME_COUNTRY) -> DataFrame:
    return _count_routes(sequence.first_by_rank(outbound(legs_df, home), "mmsi", "dt_pos_utc"), ROUTE)
