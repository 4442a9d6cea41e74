"""Aggregates of the stop-event summary that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions import geo


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_mean(c: Column | str) -> Column:
    """Mean that skips null and NaN."""
    c = _col(c)
    return F.avg(F.when(~F.isnan(c), c))


def clean_deviation(c: Column | str) -> Column:
    """Sample standard deviation that skips NaN; 0 for a single row, NaN when more
    rows but fewer than two usable values remain."""
    c = _col(c)
    sd = F.stddev_samp(F.when(~F.isnan(c), c))
    return F.when(F.count(F.lit(1)) > 1, F.coalesce(sd, F.lit(float("nan")))).otherwise(F.lit(0.0))


def mode_per_key(
    df: DataFrame, keys: Sequence[str], value: str, order: Column | str, which: int | str = 1
) -> DataFrame:
    """Most frequent value per key and its frequency.

    Ties follow first appearance: 1 takes the value that appeared last, 0 the one that
    appeared first, "all" keeps them all. Values are counted first, so a key is
    reduced to its distinct values before any ranking.
    """
    if which not in (0, 1, "all"):
        raise ValueError("which must be 1, 0 or 'all'")
    counts = df.groupBy(*keys, F.col(value).alias("mode")).agg(
        F.count(F.lit(1)).alias("frequency"), F.min(_col(order)).alias("_seen")
    )
    w = Window.partitionBy(*keys)
    if which == "all":
        top = counts.withColumn("_top", F.max("frequency").over(w)).filter(F.col("frequency") == F.col("_top"))
        return top.select(*keys, "mode", "frequency")
    seen = F.col("_seen").desc() if which == 1 else F.col("_seen").asc()
    ranked = counts.withColumn("_rn", F.row_number().over(w.orderBy(F.col("frequency").desc(), seen)))
    return ranked.filter("_rn = 1").select(*keys, "mode", "frequency")


def spread_metres(lat, lng, sd_lat, sd_lng) -> tuple[Column, Column]:
    """(x, y) metres between a mean position and the same moved one deviation
    towards zero along each axis."""
    lat, lng, sd_lat, sd_lng = map(_col, (lat, lng, sd_lat, sd_lng))
    near_lat = F.when(lat > 0, lat - sd_lat).otherwise(lat + sd_lat)
    near_lng = F.when(lng > 0, lng - sd_lng).otherwise(lng + sd_lng)
    return geo.haversine_m(lat, lng, lat, near_lng), geo.haversine_m(lat, lng, near_lat, lng)


def group_spread(
    df: DataFrame, keys: Sequence[str], lat: str, lng: str, min_length: int
) -> DataFrame:
    """Mean, deviation and spread in metres per key; spread 0 below ``min_length`` rows."""
    base = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("obs_count"),
        clean_mean(lat).alias("avg_lat"),
        clean_mean(lng).alias("avg_lng"),
        clean_deviation(lat).alias("sd_lat"),
        clean_deviation(lng).alias("sd_lng"),
    )
    x, y = spread_metres("avg_lat", "avg_lng", "sd_lat", "sd_lng")
    enough = F.col("obs_count") >= min_length
    return base.withColumns(
        {"delta_x": F.when(enough, x).otherwise(F.lit(0.0)), "delta_y": F.when(enough, y).otherwise(F.lit(0.0))}
    )
