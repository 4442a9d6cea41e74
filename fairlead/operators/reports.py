"""Recaps, ship lists and time-in-port summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions import labels, ports
from fairlead.operators import columns, joins, sequence, visits


def _movements(
    activity: DataFrame,
    kind: str,
    port_code: str | None,
    month_obs: int | None,
    year_obs: int | None,
    port_time_limit: int,
    slice_seconds: int,
) -> DataFrame:
    rows = visits.movements(activity, kind, port_time_limit, slice_seconds=slice_seconds)
    rows = columns.report_period(rows, "dt_pos_utc", port=port_code, month=month_obs, year=year_obs)
    return rows.withColumns(
        {
            "date": labels.date_text("dt_pos_utc"),
            "status_country_domicile": labels.home_or_foreign("GroupBeneficialOwnerCountryofDomicile"),
        }
    )


def recap_visits(
    activity: DataFrame,
    kind: str = "arrival",
    port_code: str | None = None,
    month_obs: int | None = None,
    year_obs: int | None = None,
    port_time_limit: int = 0,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    rows = _movements(activity, kind, port_code, month_obs, year_obs, port_time_limit, slice_seconds)
    keys = ["date", "Port", "status_country_domicile", "vessel_type", "fc_vessel"]
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).withColumn("nama_pelabuhan", ports.port_name("Port"))
    )


ZONE_COLUMNS = ("is_through_hormuz", "first_detected_hormuz", "last_detected_hormuz")


def recap_visits_with_zone(
    activity: DataFrame,
    kind: str = "arrival",
    port_code: str | None = None,
    month_obs: int | None = None,
    year_obs: int | None = None,
    port_time_limit: int = 0,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
) -> DataFrame:
    """Wider recap; the zone columns become keys when the table has them."""
    rows = _movements(activity, kind, port_code, month_obs, year_obs, port_time_limit, slice_seconds)
    keys = [
        "date", "Port", "status_country_domicile", "vessel_type", "vessel_type_main", "vessel_type_sub", "fc_vessel",
        "GroupBeneficialOwnerCountryofDomicile", "GroupBeneficialOwnerCountryOfRegistration",
        "RegisteredOwnerCountryofDomicile", "ns_vessel",
    ]
    keys += [c for c in ZONE_COLUMNS if c in rows.columns]
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).withColumn("nama_pelabuhan", ports.port_name("Port"))
    )


def vessel_list(
    activity: DataFrame,
    through_zone: bool,
    kind: str = "arrival",
    port_code: str | None = None,
    month_obs: int | None = None,
    year_obs: int | None = None,
    port_time_limit: int = 0,
    slice_seconds: int | sequence.Slicing = sequence.DEFAULT_SLICE_SECONDS,
    cell: str = "H3_int_index_8",
) -> DataFrame:
    """One row per (ship, port, date) for ships that were / were not in the zone: the
    earliest movement of the day, ties by port."""
    joins.require(activity, "is_through_hormuz")
    rows = _movements(activity, kind, port_code, month_obs, year_obs, port_time_limit, slice_seconds)
    rows = rows.filter(F.col("is_through_hormuz") == through_zone)
    keep = [
        "mmsi", "vessel_name", "vessel_type", "vessel_type_main", "vessel_type_sub", "fc_vessel",
        "GroupBeneficialOwnerCountryofDomicile", "GroupBeneficialOwnerCountryOfRegistration",
        "status_country_domicile", "Port", "date", "draught", "ns_vessel", "sog", "latitude", "longitude", cell,
    ] + [c for c in ZONE_COLUMNS if c in rows.columns]
    order = ["dt_pos_utc", "latitude", "longitude", "sog", "ns_vessel"]
    one = sequence.earliest_per_key(rows.select(*dict.fromkeys([*keep, *order])), ["mmsi", "Port", "date"], order)
    return one.select(*keep).withColumn("nama_pelabuhan", ports.port_name("Port"))


def with_latest_attributes(
    listed: DataFrame, pings: DataFrame, attributes: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Left join of each ship's most recent attributes."""
    latest = sequence.latest_per_ship(pings, attributes, ["dt_pos_utc", *tiebreak])
    return listed.join(latest, "mmsi", "left")


def ship_facts(tagged: DataFrame, flag: str, attributes: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Per ship its zone history (as ``zones.zone_history``) and its most recent attributes (as
    ``sequence.latest_per_ship``), in one aggregate over its pings."""
    order = ["dt_pos_utc", *tiebreak]
    picked = tagged.select("mmsi", *dict.fromkeys([*attributes, *order]), flag)
    newest = F.struct(*sequence.total_order(picked.drop(flag), order))
    seen = F.when(F.col(flag), F.col("dt_pos_utc"))
    return (
        picked.groupBy("mmsi")
        .agg(
            F.bool_or(flag).alias("is_through_hormuz"),
            F.min(seen).alias("first_detected_hormuz"),
            F.max(seen).alias("last_detected_hormuz"),
            F.max_by(F.struct(*attributes), newest).alias("_latest"),
        )
        .select("mmsi", *ZONE_COLUMNS, "_latest.*")
    )


def with_ship_attributes(listed: DataFrame, attributes: DataFrame) -> DataFrame:
    """Left join of attributes known per ship."""
    return listed.join(attributes, "mmsi", "left")


def counted_stops(stops: DataFrame, cell: str = "h3_index_int") -> DataFrame:
    """All that :func:`recap_stops` looks at: one row per anchor cell, day, and first and last state, and how many events (``events``).

    These rows, not the events, then meet the ports that share a cell, so the pairs do not grow with the events.
    They are few and each may meet many ports, hence dealt out evenly.
    """
    keys = [cell, "obs_time", "state_initial", "state_final"]
    by_day = columns.as_timestamp(stops, "obs_time").withColumn("obs_time", F.to_date("obs_time"))
    counted = by_day.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))
    return counted.repartition(int(stops.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def recap_stops(
    stops: DataFrame,
    kind: str,
    port_code: str | None = None,
    date_obs: int | None = None,
    month_obs: int | None = None,
    year_obs: int | None = None,
    events: str | None = None,
) -> DataFrame:
    """Arrivals (began under way) or departures (ended under way) per port and day. ``events`` names the
    column that says how many events a row stands for (:func:`counted_stops`); without it, each is one."""
    first, last = F.col("state_initial"), F.col("state_final")
    rules = {
        "arrival": ((first == 2) & last.isin(2, 3), "kedatangan"),
        "departed": ((last == 2) & first.isin(1, 2), "keberangkatan"),
    }
    if kind not in rules:
        raise ValueError("activity must be 'arrival' or 'departed'")
    rule, name = rules[kind]
    rows = columns.report_period(
        columns.as_timestamp(stops, "obs_time"), "obs_time", port_code, "Kode", date_obs, month_obs, year_obs
    )
    return (
        rows.filter(rule)
        .groupBy("Kode", F.to_date("obs_time").alias("tanggal"))
        .agg((F.coalesce(F.sum(events), F.lit(0)) if events else F.count(F.lit(1))).alias(name))
        .withColumn("nama_pelabuhan", ports.port_name("Kode"))
    )


def _with_calendar(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    derived = {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time), "date": F.to_date(time)}
    return df.withColumns({k: v for k, v in derived.items() if k in keys})


def summarize_stay_hours(stops: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and approximate median of the lower stay estimate."""
    return _with_calendar(stops, keys, "obs_time").groupBy(*keys).agg(
        F.avg("time_lower").alias("rata_rata_durasi"),
        F.percentile_approx("time_lower", 0.5, 100).alias("median_durasi"),
    )


def summarize_time_in_port(df: DataFrame, keys: Sequence[str], method: str) -> DataFrame:
    """Mean and approximate median hours in port for visits or stop events."""
    mean, median = "Rata-rata (Jam)", "Median (Jam)"
    if method == "stationary":
        joins.require(df, "time_lower")
        return _with_calendar(df, keys, "obs_time").groupBy(*keys).agg(
            F.avg("time_lower").alias(mean), F.percentile_approx("time_lower", 0.5, 100).alias(median)
        )
    if method != "boundary":
        raise ValueError("method must be 'boundary' or 'stationary'")
    joins.require(df, "time")
    hours = F.col("time") / F.lit(3600.0)
    return (
        _with_calendar(visits.arrivals(df), keys, "dt_pos_utc")
        .groupBy(*keys)
        .agg(F.avg(hours).alias(mean), F.percentile_approx(hours, 0.5, 120).alias(median))
        .filter(F.col(mean).isNotNull() & F.col(median).isNotNull())
    )


#: Size of a stored quantile sketch. Its rank error is about 2.3 / size ** 0.97, here 0.35 % of the rows, at 99 % confidence;
#: groups of at most as many rows are exact.
SKETCH = 800


def duration_sketches(df: DataFrame, hours: Column | str, keys: Sequence[str], size: int = SKETCH) -> DataFrame:
    """(keys, n, total, sketch): what mean and median of ``hours`` need, in a form that adds up over any rows.

    A sketch holds some kilobytes whatever the number of rows; null hours are left out.
    """
    value = (F.col(hours) if isinstance(hours, str) else hours).cast("double")
    return df.withColumn("_hours", value).filter(F.col("_hours").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_hours").alias("total"), F.kll_sketch_agg_double("_hours", size).alias("sketch")
    )


def merged_durations(sketches: DataFrame, keys: Sequence[str], mean: str = "rata_rata_durasi", median: str = "median_durasi") -> DataFrame:
    """Mean and median by ``keys``, any of the sketches' own; the rows behind them are not read again."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("_n"), F.sum("total").alias("_total"), F.kll_merge_agg_double("sketch").alias("_sketch")
    )
    return merged.select(
        *keys, (F.col("_total") / F.col("_n")).alias(mean), F.kll_sketch_get_quantile_double("_sketch", F.lit(0.5)).alias(median)
    )


def visit_sketches(activity: DataFrame, keys: Sequence[str], size: int = SKETCH) -> DataFrame:
    """Sketches of hours in port of arrivals, as ``summarize_time_in_port`` looks at them."""
    joins.require(activity, "time")
    return duration_sketches(_with_calendar(visits.arrivals(activity), keys, "dt_pos_utc"), F.col("time") / F.lit(3600.0), keys, size)


def stop_sketches(stops: DataFrame, keys: Sequence[str], size: int = SKETCH) -> DataFrame:
    """Sketches of the lower stay estimate of stop events, as ``summarize_stay_hours`` looks at them."""
    joins.require(stops, "time_lower")
    return duration_sketches(_with_calendar(stops, keys, "obs_time"), "time_lower", keys, size)
