"""A table of pings laid out for scans by region and by ship.

Files hold one day each and neighbouring places, so the statistics of their row groups let a scan with
bounds on latitude and longitude skip most of them. A small table beside them says which ships a
file holds, so a scan by ships opens only files with one of them.
"""

from __future__ import annotations

import math
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.functions import grid
from fairlead.operators import areas, joins
from fairlead.sources import readers, writers

DAY = "ping_day"
PINGS, SHIPS = "pings", "ships_of_files"
#: Bits of each coordinate on the curve.
CURVE_BITS = 16
#: Boxes that are pushed to a scan; outlines of more areas share one box.
BOXES = 32


def _spread_bits(c: Column) -> Column:
    """The low CURVE_BITS of a number, a gap after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = (c.bitwiseOR(F.shiftleft(c, shift))).bitwiseAND(F.lit(mask).cast("bigint"))
    return c


def place_on_curve(lat: Column | str = "latitude", lon: Column | str = "longitude") -> Column:
    """A number that neighbouring places share in its high bits (Z-order); null without a position."""
    side = float(1 << CURVE_BITS)

    def scaled(c: Column | str, low: float, high: float) -> Column:
        x = F.floor((c if isinstance(c, Column) else F.col(c)) * F.lit(side / (high - low)) - F.lit(low * side / (high - low)))
        return F.least(F.greatest(x, F.lit(0)), F.lit(int(side) - 1)).cast("bigint")

    return _spread_bits(scaled(lon, -180.0, 180.0)).bitwiseOR(F.shiftleft(_spread_bits(scaled(lat, -90.0, 90.0)), 1))


def write_clustered(pings: DataFrame, target: str, files: int) -> None:
    """Pings in about that many files, by day and place, and the ships of each file."""
    spark = pings.sparkSession
    placed = pings.withColumn(DAY, F.to_date("dt_pos_utc")).withColumn("_place", place_on_curve())
    by_place = placed.repartitionByRange(files, DAY, "_place").sortWithinPartitions(DAY, "_place").drop("_place")
    path = writers.write_parquet(by_place, f"{target.rstrip('/')}/{PINGS}", (DAY,))
    ships = spark.read.parquet(path).select("mmsi", F.input_file_name().alias("file")).distinct()
    writers.write_parquet(ships, f"{target.rstrip('/')}/{SHIPS}")


def read_clustered(spark: SparkSession, target: str, start: date | str, end: date | str, files: list[str] | None = None) -> DataFrame:
    """The pings of a period, from these files if any are named; other days' folders are not listed."""
    path = f"{target.rstrip('/')}/{PINGS}"
    read = spark.read.option("basePath", path)
    df = spark.read.parquet(path) if files is None else read.schema(spark.read.parquet(path).schema).parquet(*files)
    days = F.col(DAY).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return readers.in_period(df.filter(days), start, end).drop(DAY)


def within_boxes(pings: DataFrame, outlines: DataFrame, margin: float = 0.0) -> DataFrame:
    """Pings within the bounding boxes of areas (with a parsed ``geom``), as plain bounds that reach the scan.

    The boxes are fetched: BOXES at most, else one around all. Areas across 180 degrees bound latitudes only.
    """
    edges = areas.polygon_edges(areas.identified(outlines), [areas.AREA])
    bounds = [f("x1").alias(n) for f, n in ((F.min, "west"), (F.max, "east"))] + [f("y1").alias(n) for f, n in ((F.min, "south"), (F.max, "north"))]
    boxes = edges.groupBy(areas.AREA).agg(*bounds).drop(areas.AREA).limit(BOXES + 1).collect()
    if len(boxes) > BOXES:
        boxes = edges.agg(*bounds).collect()
    rule = F.lit(False)
    for b in boxes:
        lat = F.col("latitude").between(b.south - margin, b.north + margin)
        crosses = b.west - margin < -180 or b.east + margin > 180
        rule = rule | (lat if crosses else lat & F.col("longitude").between(b.west - margin, b.east + margin))
    return pings.filter(rule)


def files_with_ships(spark: SparkSession, target: str, ships: DataFrame) -> list[str]:
    """Files that hold a ping of one of the ships: as many names at most as the table has files."""
    index = spark.read.parquet(f"{target.rstrip('/')}/{SHIPS}")
    return sorted(r.file for r in index.join(ships.select("mmsi").distinct(), "mmsi", "left_semi").select("file").distinct().collect())


def pings_of_ships_seen_in(
    spark: SparkSession, target: str, outlines: DataFrame, resolution: int, start: date | str, end: date | str, folder: str
) -> DataFrame:
    """All pings of the period, anywhere, of ships seen at least once in the areas.

    The first scan skips what lies outside the areas' boxes; the second opens only files with one of the ships
    found, which are stored below ``folder``.
    """
    # A cell counts by its centre, so its pings may lie outside the outline by its radius.
    margin = math.degrees(grid.edge_length(resolution) / grid.EARTH_M)
    near = within_boxes(read_clustered(spark, target, start, end).select("mmsi", "dt_pos_utc", "latitude", "longitude"), outlines, margin)
    placed = near.select("mmsi", grid.cell_at("latitude", "longitude", resolution).alias("_cell"))
    inside = joins.keep_in_runs(placed, areas.zone_runs(outlines, resolution), resolution, "_cell")
    ships = writers.write_cells(inside.select("mmsi").distinct(), f"{folder.rstrip('/')}/ships-{uuid.uuid4().hex}")
    files = files_with_ships(spark, target, ships)
    if not files:
        return read_clustered(spark, target, start, end).limit(0)
    found = read_clustered(spark, target, start, end, files)
    return readers.pings_of_ships(found, ships).select(*found.columns)
