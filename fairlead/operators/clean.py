"""Cleaning of raw pings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.operators import columns, joins
from fairlead.schemas import PING_COLUMNS, VESSEL_TYPE_FIXES


def active_ships_only(
    df: DataFrame, min_pings: int = 10, speed: float = 3.0, min_fast_pings: int = 20, key: str = "mmsi"
) -> DataFrame:
    """Drop ships with fewer than ``min_pings`` pings, and ships with at least one but
    fewer than ``min_fast_pings`` pings faster than ``speed``. Ships with no fast ping
    stay. One partial aggregate feeds one anti join; both rules are per ship, so
    applying them together equals applying them in turn."""
    counts = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("pings"), F.count(F.when(F.col("sog") > speed, 1)).alias("fast")
    )
    poor = counts.filter((F.col("pings") < min_pings) | F.col("fast").between(1, min_fast_pings - 1))
    return df.join(poor.select(key), key, "left_anti")


def enough_pings(df: DataFrame, min_pings: int = 10, key: str = "mmsi") -> DataFrame:
    few = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < min_pings)
    return df.join(few.select(key), key, "left_anti")


def preprocess(
    raw: DataFrame,
    register: DataFrame,
    register_key: str,
    register_imo: str | None = None,
    register_name: str | None = None,
    fixes: Sequence[tuple[str, str | None, str | None]] = VESSEL_TYPE_FIXES,
    select: Sequence[str] = tuple(PING_COLUMNS),
) -> DataFrame:
    """Dedup, register match, type fixes, activity filters, final projection."""
    pings = raw.distinct()
    matched = joins.match_register(
        pings, joins.prefix_conflicts(register, pings), register_key, register_imo, register_name, identities=raw
    )
    typed = columns.override_types(columns.matched_only(matched), fixes)
    return active_ships_only(typed).select(*select)
