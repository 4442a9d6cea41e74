"""Scans: ping tables, registers, areas, and scans by region or by ship."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.functions import grid
from fairlead.operators import areas, columns, joins


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def read_csv_complete(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV rows without any null."""
    return columns.drop_incomplete(read_csv(spark, path, schema))


def read_register(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return read_csv(spark, path, schema)


def read_areas(spark: SparkSession, path: str, method: str, wkt_field: str = "wkt") -> DataFrame:
    """Areas of one method from a table of WKT outlines."""
    return areas.load_wkt(areas.select_method(spark.read.parquet(path), method), wkt_field)


def in_period(pings: DataFrame, start: date | str, end: date | str, time: str = "dt_pos_utc") -> DataFrame:
    """Pings from ``start`` to the end of day ``end``; compares the bare column, so
    the bounds reach the scan."""
    first = F.lit(str(start)).cast(pings.schema[time].dataType)
    after = (F.lit(str(end)).cast("date") + F.expr("INTERVAL 1 DAY")).cast(pings.schema[time].dataType)
    return pings.filter((F.col(time) >= first) & (F.col(time) < after))


def pings_in_cells(pings: DataFrame, cells: DataFrame, cell: str) -> DataFrame:
    """Semi join with the first column of ``cells``."""
    wanted = cells.select(F.col(cells.columns[0]).alias(cell)).distinct()
    return pings.join(joins.sized(wanted), cell, "left_semi")


def pings_in_runs(pings: DataFrame, runs: DataFrame, cell: str, resolution: int) -> DataFrame:
    """Pings in a region given as runs of cells, see ``areas.zone_runs``."""
    return joins.keep_in_runs(pings, runs, resolution, cell)


def pings_of_ships(pings: DataFrame, ships: DataFrame) -> DataFrame:
    """Semi join on the ship number; adaptive execution broadcasts the list if its bytes allow."""
    return pings.join(ships.select("mmsi").distinct(), "mmsi", "left_semi")


def distinct_ships(pings: DataFrame) -> DataFrame:
    return pings.select("mmsi").distinct()


def pings_of_ships_seen_in(
    pings: DataFrame, cells: DataFrame, cell: str, start: date | str, end: date | str
) -> DataFrame:
    """All pings, anywhere, of ships seen at least once in the region and period."""
    current = in_period(pings, start, end)
    seen = distinct_ships(pings_in_cells(current, cells, cell))
    return pings_of_ships(current, seen)


def pings_of_ships_seen_in_runs(
    pings: DataFrame, runs: DataFrame, resolution: int, start: date | str, end: date | str, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """The same for a region given as runs of cells; the cell is always made from the position."""
    current = in_period(pings, start, end)
    placed = current.select("mmsi", grid.cell_at(lat, lon, resolution).alias("_cell"))
    return pings_of_ships(current, distinct_ships(pings_in_runs(placed, runs, "_cell", resolution)))
