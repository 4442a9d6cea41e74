"""Small label, text and time expressions used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOME_COUNTRY = "Indonesia"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_of(port_country: Column | str) -> Column:
    """Country part of "port - country"; the whole text when it holds no dash."""
    c = _col(port_country)
    return F.when(c.contains("-"), F.element_at(F.split(c, " - "), -1)).otherwise(c)


def home_or_foreign(country: Column | str, home: str = HOME_COUNTRY) -> Column:
    return F.when(_col(country) == home, "Domestic").otherwise("Foreign")


def in_or_out(port_cell: Column | str) -> Column:
    return F.when(_col(port_cell).isNull(), "out").otherwise("in")


def or_false(flag: Column | str) -> Column:
    return F.coalesce(_col(flag).cast("boolean"), F.lit(False))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds; each side is floored first."""
    return F.unix_timestamp(_col(later)) - F.unix_timestamp(_col(earlier))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier) / F.lit(3600.0)


def stay_estimates(prior, trigger, last, escape, time_factor: int = 1) -> tuple[Column, Column]:
    """(lower, upper) whole hours from four unix times, halves rounded to even."""
    if time_factor not in (1, -1):
        raise ValueError("time_factor must be 1 or -1")
    def hours(late, early):
        span = F.lit(time_factor) * (_col(late) - _col(early))
        return F.bround(span / F.lit(3600.0)).cast("int")
    return hours(last, trigger), hours(escape, prior)


def date_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def observation_thresholds(vessel_type: Column | str) -> tuple[Column, Column]:
    """(pings an event needs, pings a ship needs) by type; unknown type counts as other."""
    passenger = F.coalesce(F.lower(_col(vessel_type)) == "passenger", F.lit(False))
    return F.when(passenger, 2).otherwise(10), F.when(passenger, 2).otherwise(20)
